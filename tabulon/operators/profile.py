"""Counts and summary statistics of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.joins import attach
from tabulon.functions.hashing import hash_cutoff, order_hash
from tabulon.functions.quantiles import exact_quantiles, narrow
from tabulon.functions.ranks import global_position
from tabulon.operators.cleaning import require_columns
from tabulon.sources.tables import literal_rows

QUARTILES = [0.25, 0.5, 0.75]


def nunique(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row per column with its number of distinct non-null values."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    wide = df.agg(*[count(c).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "n_distinct")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value; callers that show it order by count."""
    total = df.agg(F.count(column)).scalar()
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / total)


def top_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The k most frequent values, ties by value."""
    return value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(k)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Number of distinct keys that occur more than once."""
    repeated = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.count("*").alias("n_duplicate_keys"))


def label_consistency(df: DataFrame, key: str, label: str) -> DataFrame:
    """Of the repeated keys: how many carry one label, two labels, ..."""
    # counting (key, label) first keeps a hot key's rows from meeting in one task
    pairs = df.groupBy(key, label).agg(F.count("*").alias("n"))
    per_key = pairs.groupBy(key).agg(F.sum("n").alias("n"), F.count(label).alias("n_labels"))
    return per_key.where("n > 1").groupBy("n_labels").agg(F.count("*").alias("n_keys"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column; nulls left out.

    The columns are stored once; one pass gives what needs no order and the first brackets of the quartiles.
    """
    columns = list(columns)
    require_columns(df, columns)
    df = narrow(df, columns)
    stats = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("std"),
                F.min(c).alias("low"),
                F.max(c).alias("high"),
            ).alias(c)
            for c in columns
        ]
    ).first()
    sizes = [stats[c][x] for c in columns for x in ("n", "low", "high")]
    quartiles = exact_quantiles(df, columns, QUARTILES, sizes)
    rows = []
    for c in columns:
        s = stats[c]
        low, high = (None if s[x] is None else float(s[x]) for x in ("low", "high"))
        rows.append((c, s["n"], s["mean"], s["std"], low, *quartiles[c], high))
    names = {"column_name": "string", "n": "long"}
    names |= {k: "double" for k in ("mean", "std", "min", "q25", "q50", "q75", "max")}
    return literal_rows(df.sparkSession, names, rows)


def sentinel_counts(df: DataFrame, columns: Sequence[str], sentinel: float) -> DataFrame:
    """Occurrences of the missing-value marker and of null per column, in one pass."""
    pairs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c) == sentinel).alias("n_sentinel"),
            F.count_if(F.col(c).isNull()).alias("n_null"),
        ).alias(f"c{k}")
        for k, c in enumerate(columns)
    ]
    wide = df.agg(*pairs)
    return wide.select(F.inline(F.array(*wide.columns)))


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population skewness and excess kurtosis, nulls left out."""
    parts = [
        F.struct(
            F.lit(c).alias("column_name"), F.skewness(c).alias("skewness"), F.kurtosis(c).alias("kurtosis")
        ).alias(f"c{k}")
        for k, c in enumerate(columns)
    ]
    wide = df.agg(*parts)
    return wide.select(F.inline(F.array(*wide.columns)))


def table_info(df: DataFrame) -> DataFrame:
    """Row count, type and non-null count of each column, in one pass."""
    parts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(t).alias("data_type"),
            F.count(c).alias("n_non_null"),
            F.count("*").alias("n_rows"),
            F.lit(len(df.columns)).cast("long").alias("n_columns"),
        ).alias(f"c{k}")
        for k, (c, t) in enumerate(df.dtypes)
    ]
    wide = df.agg(*parts)
    return wide.select(F.inline(F.array(*wide.columns)))


def duplicated_rows(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once.

    Keys are counted with a map-side combine and joined back by their measured size; the rows
    of hot keys are spread over tasks.
    """
    repeated = df.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key, "_n", F.lit(True).alias("_repeated"))
    rows = df.select(*dict.fromkeys([*columns, key]))
    return attach(rows, repeated, [key], size_col="_n").where("_repeated").select(*columns)


def ordered(df: DataFrame, *order: str | Column) -> DataFrame:
    return df.orderBy(*order)


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int = 1) -> DataFrame:
    """First rows of an order; only n rows per task are kept."""
    return df.orderBy(*order).limit(n)


def with_position(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    return global_position(df, list(order))


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones for the same seed on any partitioning."""
    if n < 0:
        raise ValueError("a sample cannot have a negative size")
    hashed = df.withColumn("_hash", order_hash(seed, key))
    cutoff = hash_cutoff(hashed.select("_hash"), "_hash", n)
    return df.where(order_hash(seed, key) <= F.lit(cutoff))
