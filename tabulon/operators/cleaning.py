"""Row-wise cleaning and projections: every function here stays in one narrow stage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.config import Cleaning
from tabulon.sources.contracts import check_columns


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def sentinel_to_null(df: DataFrame, sentinels: Sequence[float]) -> DataFrame:
    """Listed values become null in every numeric column; text is left alone."""
    numeric = numeric_columns(df)
    return df.withColumns({c: F.when(~F.col(c).isin(*sentinels), F.col(c)) for c in numeric}) if numeric else df


def add_differences(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``a_b = a - b`` for each pair; null if either side is."""
    require_columns(df, [c for pair in pairs for c in pair])
    return df.withColumns({f"{a}_{b}": F.col(a) - F.col(b) for a, b in pairs})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unlike ``drop``, refuses names that do not exist."""
    require_columns(df, columns)
    return df.drop(*columns)


def clean(df: DataFrame, settings: Cleaning) -> DataFrame:
    """Sentinels, then differences, then the column drop."""
    return (
        df.transform(sentinel_to_null, settings.sentinels)
        .transform(add_differences, settings.pairs)
        .transform(drop_columns, settings.drop)
    )


def features_and_target(df: DataFrame, target: str, group: str) -> DataFrame:
    """Features, target and group in one table, the latter two renamed ``label`` and ``group_id``.

    Keeping them together makes alignment by position unnecessary.
    """
    require_columns(df, [target, group])
    features = [c for c in df.columns if c not in (target, group)]
    if not features:
        raise ValueError("no feature column is left")
    result = df.select(*features, F.col(target).alias("label"), F.col(group).alias("group_id"))
    if result.select("label").isEmpty():
        raise ValueError("the table has no rows")
    return result


def filter_rows(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.where(condition)


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    require_columns(df, subset)
    return df.dropna(subset=list(subset))


def replace_value(df: DataFrame, old: float, new: float) -> DataFrame:
    """Replace a number wherever it occurs in a numeric column."""
    return df.withColumns(
        {c: F.when(F.col(c) == old, F.lit(new).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in numeric_columns(df)}
    )


def binary_flag(df: DataFrame, column: str, value: str, name: str) -> DataFrame:
    """1 where the column has the value, else 0, null included."""
    return df.withColumn(name, F.coalesce((F.col(column) == value).cast("int"), F.lit(0)))


def inference_input(df: DataFrame, expected: Iterable[str], target: str, group: str) -> DataFrame:
    """Without target and group, exactly the expected columns must remain."""
    return check_columns(df.drop(target, group), expected)


def table_preflight(df: DataFrame, target: str, group: str, folds: int) -> DataFrame:
    """All counts needed by the guards, in one job."""
    require_columns(df, [target, group])
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(target).alias("n_classes"),
        F.count_distinct(group).alias("n_groups"),
    ).withColumn(
        "ok", (F.col("n_rows") > 0) & (F.col("n_classes") >= 2) & (F.col("n_groups") >= F.greatest(F.lit(2), F.lit(folds)))
    )


def check_preflight(df: DataFrame, target: str, group: str, folds: int) -> None:
    if folds < 2:
        raise ValueError(f"at least 2 folds are needed, not {folds}")
    if not df.where(F.col(group).isNull()).isEmpty():
        raise ValueError(f"rows without a value in {group!r} belong to no fold")
    found = table_preflight(df, target, group, folds).first()
    if found.n_rows == 0:
        raise ValueError("the table has no rows")
    if found.n_classes < 2:
        raise ValueError("the target has fewer than 2 classes")
    if found.n_groups < 2:
        raise ValueError("there are fewer than 2 groups")
    if found.n_groups < folds:
        raise ValueError(f"{found.n_groups} groups cannot fill {folds} folds")
