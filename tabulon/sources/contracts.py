"""What a table must look like before it is used."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.config import Contract


def check_columns(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """The set of names must match exactly; order is free. Runs no job."""
    expected = sorted(expected)
    if sorted(df.columns) != expected:
        missing = sorted(set(expected) - set(df.columns))
        extra = sorted(set(df.columns) - set(expected))
        raise ValueError(f"columns differ from the contract: missing {missing}, unexpected {extra}")
    return df


def row_count_report(df: DataFrame, expected: int) -> DataFrame:
    """(expected, actual, ok) in one row."""
    return df.agg(F.count("*").alias("actual")).select(
        F.lit(expected).cast("long").alias("expected"), "actual", (F.col("actual") == expected).alias("ok")
    )


def check_rows(df: DataFrame, expected: int) -> DataFrame:
    actual = df.count()
    if actual != expected:
        raise ValueError(f"expected {expected} rows, found {actual}")
    return df


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    return check_rows(check_columns(df, contract.columns), contract.rows)


def has_min_rows(df: DataFrame, min_rows: int = 1) -> bool:
    """Reads only as many rows as asked for."""
    return df.limit(min_rows).count() >= min_rows


def is_usable(spark: SparkSession, path: str, min_rows: int = 1, fmt: str = "csv") -> bool:
    """True if the table exists and its first ``min_rows`` rows can be read; any error is False."""
    try:
        return has_min_rows(spark.read.option("header", True).format(fmt).load(path), min_rows)
    except Exception:
        return False


def min_rows_report(df: DataFrame, min_rows: int) -> DataFrame:
    """(min_rows, found, ok): ``found`` stops at ``min_rows``."""
    return (
        df.limit(min_rows)
        .agg(F.count("*").alias("found"))
        .select(F.lit(min_rows).cast("long").alias("min_rows"), "found", (F.col("found") >= min_rows).alias("ok"))
    )
