"""Scoring of batch directories as a stream, replay draws and isolation of bad records."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.hashing import hash_number
from tabulon.functions.ranks import global_position, running_totals
from tabulon.plans.scoring import Predictor
from tabulon.session import materialize, scratch_path
from tabulon.sources.tables import literal_rows

MOST_BATCHES = 32  # micro-batches for the files that wait when a stream begins


def read_batches(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1) -> DataFrame:
    """Files of ``batch=N`` directories as they arrive; ``batch`` is read from the path."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return stream.parquet(path)


def files_at_once(waiting: DataFrame, least: int = 8, most_batches: int = MOST_BATCHES) -> int:
    """Files of a micro-batch, so that those waiting are worked off in at most ``most_batches``. A micro-batch costs some
    two seconds of planning and logging, however few rows it has; a larger one is spread over more tasks."""
    return max(least, -(-len(waiting.inputFiles()) // most_batches))


class _Enough(Exception):
    """Ends a stream before its next micro-batch is committed."""


def stream_predict(
    stream: DataFrame,
    predictor: Predictor,
    out: str,
    quarantine: str,
    valid: Column | None = None,
    checkpoint: str | None = None,
    max_records: int | None = None,
    batch_columns: Sequence[str] = ("batch",),
) -> int:
    """Score each micro-batch with the batch predictor until the present files are used up.

    Output goes to ``batch_id=N`` directories that are overwritten when Spark repeats a
    micro-batch after a failure, so that no row is written twice. Rows that fail ``valid`` go
    to ``quarantine`` and the stream goes on. Where the rows have the predictor's target, the hits of each micro-batch are
    written beside its rows, in the same way (see ``read_accuracy``). With ``max_records`` exactly that many rows are scored, if
    there are so many: the last micro-batch is cut and the next one is not begun. Returns the number of scored rows.
    """
    spark = stream.sparkSession
    scored = 0

    def handle(batch: DataFrame, batch_id: int) -> None:
        nonlocal scored
        if max_records is not None and scored >= max_records:
            raise _Enough
        started = time.perf_counter()
        good, bad = (batch, None) if valid is None else split_valid(batch, valid)
        if max_records is not None:
            good = good.limit(max_records - scored)
        target = f"{out}/rows/batch_id={batch_id}"
        _predict_beside(predictor, good, batch_columns).write.mode("overwrite").parquet(target)
        rows = spark.read.parquet(target).count()  # from the footers of the files just written
        scored += rows
        latency = (time.perf_counter() - started) / max(rows, 1)
        timing = literal_rows(spark, {"n_rows": "long", "latency_seconds": "double"}, [(rows, latency)])
        timing.coalesce(1).write.mode("overwrite").parquet(f"{out}/timing/batch_id={batch_id}")
        if predictor.target in good.columns:
            written = spark.read.parquet(target)
            hits = written.agg(F.count("*").alias("n"), F.count_if(F.col(predictor.target) == F.col("prediction")).alias("hits"))
            hits.write.mode("overwrite").parquet(f"{out}/accuracy/batch_id={batch_id}")
        if bad is not None:
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream"))
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if max_records is None or scored < max_records:
            raise
    return scored


def _predict_beside(predictor: Predictor, rows: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The predictor's contract is about the record; stream columns travel beside it."""
    return replace(predictor, expected=(*predictor.expected, *carried)).predict(rows)


def read_predictions(spark: SparkSession, out: str) -> DataFrame:
    """Scored rows with ``batch_id`` and the mean ``latency_seconds`` of a row of that micro-batch."""
    rows = spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows/batch_id=*")
    timing = spark.read.parquet(f"{out}/timing").groupBy("batch_id").agg(F.max("latency_seconds").alias("latency_seconds"))
    return rows.join(timing, "batch_id", "left")  # one row per micro-batch, sized by Catalyst


def read_accuracy(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, n, accuracy, n_so_far, running_accuracy) of each micro-batch that has been scored; a row without a true
    label is no hit. Empty micro-batches have no accuracy of their own."""
    batches = spark.read.parquet(f"{out}/accuracy").select(F.col("batch_id").cast("long").alias("batch_id"), "n", "hits")
    totals = running_totals(batches, [], "batch_id", ["n", "hits"])
    n, hits = F.col("n") + F.col("n_before"), F.col("hits") + F.col("hits_before")
    return totals.select(
        "batch_id",
        "n",
        F.try_divide(F.col("hits").cast("double"), F.col("n")).alias("accuracy"),
        n.alias("n_so_far"),
        F.try_divide(hits.cast("double"), n).alias("running_accuracy"),
    )


def flag_valid(rows: DataFrame, valid: Column) -> DataFrame:
    """Adds ``status``: ok, or quarantined (a null verdict counts as bad). One pass over the rows."""
    return rows.withColumn("status", F.when(valid, F.lit("ok")).otherwise(F.lit("quarantined")))


def split_valid(rows: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the predicate, and the rest. For two sinks of one stored table."""
    verdict = F.coalesce(valid, F.lit(False))
    return rows.where(verdict), rows.where(~verdict)


def parse_records(rows: DataFrame, doubles: Sequence[str]) -> DataFrame:
    """Text fields to numbers; ``bad_fields`` counts those that hold text but no number."""
    parsed = {c: F.expr(f"try_cast(`{c}` as double)") for c in doubles}
    bad: Callable[[str], Column] = lambda c: (F.col(c).isNotNull() & parsed[c].isNull()).cast("int")
    total = sum((bad(c) for c in doubles), F.lit(0))
    return rows.select(*[c for c in rows.columns if c not in doubles], *[parsed[c].alias(c) for c in doubles], total.alias("bad_fields"))


def replay(rows: DataFrame, key: str, draws: int, seed: int) -> DataFrame:
    """``draws`` random rows with replacement: (draw, columns...), the same for the same seed.

    Rows are numbered by key; each draw looks up one number, so the load spreads evenly.
    """
    return _drawn(rows.sparkSession.range(draws).withColumnRenamed("id", "draw"), _numbered(rows, key), seed)


def _numbered(rows: DataFrame, key: str) -> tuple[DataFrame, int]:
    placed = materialize(global_position(rows, [key], "_at"))
    n = placed.count()
    if n == 0:
        raise ValueError("there is nothing to replay")
    return placed, n


def _drawn(draws: DataFrame, numbered: tuple[DataFrame, int], seed: int) -> DataFrame:
    placed, n = numbered
    return draws.withColumn("_at", F.pmod(hash_number(seed, "draw"), F.lit(n))).join(placed, "_at").drop("_at")


def replay_stream(
    rows: DataFrame, key: str, draws: int, seed: int, out: str, checkpoint: str | None = None, rows_per_second: int = 1_000,
    most_batches: int | None = None,
) -> DataFrame:
    """The draws of ``replay``, one after the other at a pace, as a stream into ``out``; (draw, columns...) so far.

    A rate source counts the draws and paces them; each micro-batch of them is joined with the stored, numbered table. It writes
    a directory of its own, which is overwritten when Spark repeats it, and the source goes on behind the last committed draw
    when the stream is started again with its ``checkpoint``, so no draw is lost or repeated. The stream ends by itself after the last draw,
    or after ``most_batches`` micro-batches.
    """
    spark = rows.sparkSession
    numbered = _numbered(rows, key)
    ended = threading.Event()
    handled = 0

    def handle(batch: DataFrame, batch_id: int) -> None:
        nonlocal handled
        target = f"{out}/batch_id={batch_id}"
        # the source counts on behind the last draw; such a batch is empty
        drawn = _drawn(batch.where(F.col("value") < draws).select(F.col("value").alias("draw")), numbered, seed)
        drawn.write.mode("overwrite").parquet(target)
        handled += 1
        last = batch.agg(F.max("value")).first()[0]
        if (last is not None and last >= draws - 1) or handled == most_batches:
            ended.set()

    source = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    query = source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint or scratch_path(spark, "replay")).start()
    while query.isActive and not ended.wait(0.1):
        pass
    query.stop()  # a batch that is not committed yet is repeated into its directory on the next start
    if query.exception():
        raise query.exception()
    schema = T.StructType([T.StructField("draw", T.LongType()), *rows.schema.fields])
    return spark.read.schema(schema).option("basePath", out).parquet(f"{out}/batch_id=*").select("draw", *rows.columns)
