"""The registered queries: those with SQL equal it, the others fit the tables they read."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import SF

from __spark_entry__ import oracle_sql, queries
from tabulon.llm.queries import QUERIES
from tabulon.llm.statements import STATEMENTS
from tools.check_oracle import rows_of


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(STATEMENTS) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_equals_sql(spark, name):
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.sql(STATEMENTS[name])
    assert got == rows_of(result.columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STATEMENTS)))
def test_whole_table(spark, name):
    table, key = {"op8_url_filter": ("pages", "page_id"), "op9_embedding_dedup": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    keys = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    got = {r[key] for r in QUERIES[name](spark, SF).collect()}
    assert got <= keys if name == "op4_decontamination" else got == keys
