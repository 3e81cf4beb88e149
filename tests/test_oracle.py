"""Every named query runs, and those with SQL give the same rows on DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import SF

from __spark_entry__ import entry, oracle_sql, queries
from tabulon.plans.catalog import QUERIES
from tools.check_oracle import rows_of

SLOW = {
    "gbt_fit_score", "linear_svc_fit_score", "mlp_fit_score", "logreg_fit_score", "rf_fit_score", "search", "experiment",
    "cross_validate", "cross_validate_mean", "permutation_importance", "forest_importance", "stream_predict", "batch_predict", "batch_report",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_registries_fit_together():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 1500


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracle_sql():
        assert got[1]
        return
    result = duck.sql(oracle_sql()[name])
    assert got == rows_of(result.columns, result.fetchall())
