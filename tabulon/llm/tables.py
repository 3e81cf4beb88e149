"""Stored intermediate tables, row ids, and broadcasts whose size is measured first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.session import store_parquet

BROADCAST_BYTES = 48_000_000
ROW_BITS = 33  # monotonically_increasing_id keeps the row number inside a partition in these bits


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def store(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: a lost executor costs no lineage."""
    return store_parquet(df, "llm", compression="zstd")


def store_bucketed(df: DataFrame, by: list[str]) -> DataFrame:
    """Like ``store``, dealt over as many buckets as a shuffle has partitions, so that joins on ``by`` need not move it."""
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return store_parquet(df.repartition(buckets, *by), "llm", by, buckets, compression="zstd")


def text_key(text: str | Column = "text") -> list[Column]:
    """128 bits that name a text; null is as empty."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit(7), text).alias("_t2")]


def unused(name: str, taken: list[str]) -> str:
    """``name``, made longer until no column has it (in any case, as Spark compares them)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def if_small(stored: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``stored``, marked for broadcast if its rows, at ``row_bytes`` each, are measured to take at most
    ``limit`` bytes; otherwise Catalyst and adaptive execution choose, which means a shuffled join with
    skewed parts split."""
    size = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    measured = stored.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(stored) if measured <= limit else stored
