"""The observation table, derived from the order tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MISSING = -9999.0
_BANDS = {"u": "l_extendedprice", "g": "l_quantity", "i": "l_discount", "z": "l_tax"}
COLUMNS = ("obj_id", "field_id", "run_id", "mjd", "class", "u", "g", "r", "i", "z", "redshift")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def observations(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per order. Only the tables behind the asked columns are joined.

    The joins carry no hint: Catalyst broadcasts customers while they are small and shuffles
    them beyond that, and line items are pre-aggregated per order before their shuffle.
    """
    wanted = list(columns or COLUMNS)
    rows = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("obj_id"),
        F.col("o_custkey").alias("field_id"),
        # Modified Julian Date: whole days since 1858-11-17
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1858-11-17").cast("date")).cast("long").alias("mjd"),
        F.col("o_orderstatus").alias("class"),
        F.col("o_totalprice").alias("r"),
    )
    bands = [c for c in _BANDS if c in wanted]
    if bands:
        per_order = (
            load(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("obj_id"))
            .agg(*[F.max(_BANDS[b]).alias(b) for b in bands])
        )
        rows = rows.join(per_order, "obj_id", "left").fillna(MISSING, subset=bands)
    if {"run_id", "redshift"} & set(wanted):
        customers = load(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("field_id"),
            F.col("c_nationkey").alias("run_id"),
            F.col("c_acctbal").alias("redshift"),
        )
        rows = rows.join(customers, "field_id", "left")
    return rows.select(*wanted)
