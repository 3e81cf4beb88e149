"""Positions and running totals over a global order, without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in these bits


def global_position(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the total order given by ``order``.

    The rows are range-partitioned and sorted once. The only single-partition window runs over
    one row per shuffle partition. ``order`` should end in a unique key, which also keeps rows
    of one frequent value apart.
    """
    ranged = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    in_part = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ranged.join(F.broadcast(starts), "_part")  # one row per shuffle partition
        .withColumn(name, F.col("_start") + in_part)
        .drop("_part", "_slot", "_start")
    )


def running_totals(table: DataFrame, by: list[str], order: str, sums: list[str]) -> DataFrame:
    """Add ``<s>_before`` for each column of ``sums``: its total over smaller ``order`` values
    of the same ``by``. ``table`` holds one row per (by, order), i.e. it is aggregated already.
    """
    ranged = materialize(table.repartitionByRange(*by, order).withColumn("_part", F.spark_partition_id()))
    across = Window.partitionBy(*by, F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*by, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*by, "_part")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .select(*by, "_part", *[F.coalesce(F.sum(s).over(across), F.lit(0)).alias(f"_start_{s}") for s in sums])
    )
    local = ranged.select("*", *[F.coalesce(F.sum(s).over(within), F.lit(0)).alias(f"_local_{s}") for s in sums])
    # one row per shuffle partition and ``by`` value that occurs in it
    joined = local.join(F.broadcast(starts), [*by, "_part"])
    return joined.select(
        *table.columns, *[(F.col(f"_start_{s}") + F.col(f"_local_{s}")).alias(f"{s}_before") for s in sums]
    )


def average_ranks(counts: DataFrame, by: list[str], value: str, n: str) -> DataFrame:
    """Average rank (1-based, ties share the mean) of each distinct value, from its count."""
    totals = running_totals(counts, by, value, [n])
    return totals.withColumn("avg_rank", F.col(f"{n}_before") + (F.col(n) + 1) / F.lit(2.0)).drop(f"{n}_before")
