"""From the source table to training and production tables."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.config import Cleaning, Contract, Holdout
from tabulon.operators.cleaning import clean
from tabulon.operators.splits import PROD, TRAIN, batch_slices, fit_time_cut, split_metadata
from tabulon.sources.artifacts import log_run
from tabulon.sources.contracts import check_contract
from tabulon.sources.fingerprints import table_fingerprint
from tabulon.sources.tables import write_batches, write_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class DatasetPaths:
    training: str
    production: str
    batches: str
    processed: str
    metadata: str
    runs: str


def build_dataset(
    source: DataFrame, contract: Contract, holdout: Holdout, cleaning: Cleaning, paths: DatasetPaths
) -> None:
    """Check, cut by time, write both sides, the daily batches, the metadata and the cleaned
    training rows. Production rows stay raw: they are cleaned when they are scored."""
    spark = source.sparkSession
    for phase, step in (
        ("contract", lambda: check_contract(source, contract)),
        ("split", lambda: _split(source, holdout, paths)),
        ("clean", lambda: write_table(clean(spark.read.parquet(paths.training), cleaning), paths.processed)),
        ("log", lambda: _log(spark, paths)),
    ):
        try:
            step()
        except Exception as e:
            log.exception("phase %r failed", phase)
            raise RuntimeError(f"phase {phase!r} failed: {e}") from e


def _split(source: DataFrame, holdout: Holdout, paths: DatasetPaths) -> None:
    cut = fit_time_cut(source, holdout.time_col, holdout.key, holdout.fraction)
    sided = source.withColumn("side", cut.side())
    write_table(sided.where(F.col("side") == TRAIN).drop("side"), paths.training)
    prod = sided.where(F.col("side") == PROD).drop("side")
    write_table(prod, paths.production)
    write_batches(batch_slices(prod, holdout.time_col, holdout.key, holdout.batch_size), paths.batches)
    metadata = split_metadata(sided, holdout.time_col, "side", holdout.fraction)
    located = metadata.withColumns({"training_path": F.lit(paths.training), "production_path": F.lit(paths.production)})
    write_table(located.coalesce(1), paths.metadata, "json")


def _log(spark: SparkSession, paths: DatasetPaths) -> None:
    processed = spark.read.parquet(paths.processed)
    found = table_fingerprint(processed, processed.columns).first().asDict()
    log_run(spark, paths.runs, "dataset", data={k: int(v) for k, v in found.items()})
