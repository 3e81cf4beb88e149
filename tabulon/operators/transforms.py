"""Transforms that are fitted on training rows and applied anywhere as a narrow projection.

Spark ML's own imputer and scalers use approximate medians, sample deviations and other values
for constant columns, so the statistics are computed here, exactly and for all columns at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.quantiles import exact_quantiles, filled_quantiles
from tabulon.operators.cleaning import require_columns


@dataclass(frozen=True)
class MedianImputer:
    medians: dict[str, float]
    dropped: tuple[str, ...] = ()

    def transform(self, df: DataFrame) -> DataFrame:
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in self.medians.items()}
        return df.drop(*self.dropped).withColumns(filled)


def fit_median_imputer(df: DataFrame, columns: Sequence[str]) -> MedianImputer:
    """Exact medians; a column without any value is dropped."""
    require_columns(df, columns)
    medians = {c: q[0] for c, q in exact_quantiles(df, list(columns), [0.5]).items()}
    dropped = tuple(c for c, m in medians.items() if m is None)
    return MedianImputer({c: m for c, m in medians.items() if m is not None}, dropped)


@dataclass(frozen=True)
class Scaler:
    """(x - centre) / scale per column."""

    name: str
    centre: dict[str, float]
    scale: dict[str, float]

    def column(self, c: str) -> Column:
        return (F.col(c) - F.lit(self.centre[c])) / F.lit(self.scale[c])

    def transform(self, df: DataFrame) -> DataFrame:
        """Scaled columns first, then the others unchanged."""
        require_columns(df, self.centre)
        rest = [c for c in df.columns if c not in self.centre]
        return df.select(*[self.column(c).alias(c) for c in self.centre], *rest)


def _fit_standard(df: DataFrame, columns: list[str]) -> tuple[list, list]:
    row = df.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    return list(row[: len(columns)]), list(row[len(columns) :])


def _fit_robust(df: DataFrame, columns: list[str]) -> tuple[list, list]:
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    return [q[c][1] for c in columns], [None if q[c][0] is None else q[c][2] - q[c][0] for c in columns]


def _fit_minmax(df: DataFrame, columns: list[str]) -> tuple[list, list]:
    row = df.agg(*[F.min(c) for c in columns], *[F.max(c) for c in columns]).first()
    low, high = row[: len(columns)], row[len(columns) :]
    return list(low), [None if a is None else b - a for a, b in zip(low, high)]


SCALERS = {"standard": _fit_standard, "robust": _fit_robust, "minmax": _fit_minmax}


def fit_scaler(df: DataFrame, columns: Sequence[str], name: str = "standard") -> Scaler:
    """Population deviation, quartile range or range; a constant column is divided by 1."""
    chosen = SCALERS.get(name.lower())
    if chosen is None:
        raise ValueError(f"unknown scaler {name!r}; choose from {sorted(SCALERS)}")
    columns = list(columns)
    require_columns(df, columns)
    centre, scale = chosen(df, columns)
    empty = [c for c, m in zip(columns, centre) if m is None]
    if empty:
        raise ValueError(f"columns without values cannot be scaled: {empty}")
    return Scaler(
        name.lower(),
        {c: float(m) for c, m in zip(columns, centre)},
        {c: float(s) if s else 1.0 for c, s in zip(columns, scale)},
    )


def fit_imputer_and_scaler(
    df: DataFrame, columns: Sequence[str], scaled: Sequence[str], name: str
) -> tuple[MedianImputer, Scaler]:
    """The imputer of ``columns`` and the scaler of those ``scaled`` columns that it keeps, fitted on the rows it has filled.

    Quartiles of filled rows are values of the rows as they are, since the filled ones all stand in the middle; so medians and
    quartiles are found in the same passes.
    """
    if name.lower() != "robust":
        imputer = fit_median_imputer(df, columns)
        return imputer, fit_scaler(imputer.transform(df), [c for c in scaled if c not in imputer.dropped], name)
    require_columns(df, [*columns, *scaled])
    medians, quartiles = filled_quantiles(df, list(columns), [0.25, 0.5, 0.75])
    dropped = tuple(c for c, m in medians.items() if m is None)
    imputer = MedianImputer({c: m for c, m in medians.items() if m is not None}, dropped)
    kept = [c for c in scaled if c not in dropped]
    if set(kept) - set(columns):
        return imputer, fit_scaler(imputer.transform(df), kept, name)
    q = {c: quartiles[c] for c in kept}
    return imputer, Scaler("robust", {c: q[c][1] for c in kept}, {c: (q[c][2] - q[c][0]) or 1.0 for c in kept})


@dataclass(frozen=True)
class LabelCodes:
    """Sorted labels; the code of a label is its place."""

    labels: tuple

    def encode(self, df: DataFrame, column: str, name: str = "label_code") -> DataFrame:
        """Fails on a label that was not seen in fitting, and on a missing one."""
        code = F.array_position(F.array(*[F.lit(v) for v in self.labels]), F.col(column)) - 1
        bad = F.raise_error(F.concat(F.lit("label not seen in training: "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))
        return df.withColumn(name, F.when(code >= 0, code).otherwise(bad.cast("long")).cast("int"))

    def decode(self, df: DataFrame, code: str, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.decoded(F.col(code)))

    def decoded(self, code: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in self.labels]), code.cast("int") + 1)


def fit_labels(df: DataFrame, column: str) -> LabelCodes:
    """The label list is part of the model; it must fit the driver, as in any classifier."""
    limit = 10_000
    labels = [r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()]
    if len(labels) > limit:
        raise ValueError(f"{column} has more than {limit} classes")
    return LabelCodes(tuple(sorted(labels)))


def argmax(probabilities: Column) -> Column:
    """0-based place of the first largest element of an array."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def pca_variance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of variance per principal component of the standardised columns, nulls dropped."""
    columns = list(columns)
    complete = df.select(*columns).dropna()
    scaled = fit_scaler(complete, columns, "standard").transform(complete)
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(scaled)
    model = PCA(k=len(columns), inputCol="v", outputCol="p").fit(vectors)
    shares = F.array(*[F.lit(float(s)) for s in model.explainedVariance])
    return df.sparkSession.range(1).select(F.posexplode(shares).alias("component", "variance_share"))
