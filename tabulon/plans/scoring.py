"""Scoring of tables."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tabulon.config import Cleaning
from tabulon.operators.cleaning import clean, inference_input
from tabulon.operators.evaluation import classification_report
from tabulon.plans.training import TrainedModel
from tabulon.sources.tables import read_csv, read_parquet, write_table


@dataclass(frozen=True)
class Predictor:
    """Contract check, cleaning, model and label decoding for raw rows."""

    model: TrainedModel
    expected: tuple[str, ...]
    cleaning: Cleaning
    target: str = "class"
    group: str = "field_ID"

    def predict(self, df: DataFrame) -> DataFrame:
        """All input columns and ``prediction``; no row is added or lost, nothing is shuffled."""
        inference_input(df, self.expected, self.target, self.group)
        present = set(df.columns) - {self.target, self.group}
        drop = tuple(c for c in self.cleaning.drop if c in present)
        # the record travels in a struct, which cleaning leaves alone
        carried = df.withColumn("_record", F.struct(*[F.col(c) for c in df.columns]))
        scored = self.model.predict(clean(carried, replace(self.cleaning, drop=drop)))
        return scored.select("_record.*", "prediction")

    def predict_one(self, df: DataFrame) -> dict[str, Any]:
        """A single record with its latency; more or fewer rows are refused."""
        if len(df.take(2)) != 1:
            raise ValueError("exactly one row is expected")
        started = time.perf_counter()
        row: Row = self.predict(df).first()
        known = row.asDict()
        return {
            "prediction": row.prediction,
            "latency_seconds": time.perf_counter() - started,
            "true_class": known.get(self.target),
        }


def batch_predict(
    spark: SparkSession,
    predictor: Predictor,
    path: str,
    out: str | None = None,
    fmt: str = "parquet",
    schema=None,
) -> tuple[DataFrame, DataFrame | None]:
    """Score a stored table; with labels a classification report comes back beside the rows."""
    rows = read_csv(spark, path, schema) if fmt == "csv" else read_parquet(spark, path)
    return score_table(predictor, rows, out)


def score_table(predictor: Predictor, rows: DataFrame, out: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    scored = predictor.predict(rows)
    # one time for the whole batch: current_timestamp is fixed per query
    scored = scored.withColumn("prediction_timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    if out is not None:
        write_table(scored, out)
        scored = rows.sparkSession.read.parquet(out)
    labelled = predictor.target in rows.columns
    return scored, classification_report(scored, predictor.target, "prediction") if labelled else None


def expected_inputs(columns: Iterable[str], target: str, group: str) -> tuple[str, ...]:
    return tuple(c for c in columns if c not in (target, group))
