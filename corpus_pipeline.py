"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on every document its predecessor kept and returns a DataFrame
that is written as Parquet and read again for the next. All but the last return the columns of documents; columns
beside doc_id and text are passed on, whatever their names, and ``n_chars`` follows the text. Repeated rows are documents of their
own until the near-duplicate stage, which keeps one document of each group. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.decontamination import find_leaks
from tabulon.llm.language import UNKNOWN, fit_language_model, held_out
from tabulon.llm.line_windows import drop_repeated_windows
from tabulon.llm.packing import pack_documents
from tabulon.llm.queries import tokenizer_path
from tabulon.llm.shingle_join import similar_groups
from tabulon.llm.tables import documents, if_small, store
from tabulon.session import scratch_tables

LEAST_SCORE = 0.3  # of the calibrated probability; below it no language is told from the others


def _rest(docs: DataFrame) -> Column:
    """All columns but the text, out of the way of names that operators use."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")


def _restored(docs: DataFrame, work: DataFrame, changed: bool = False) -> DataFrame:
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars" and changed:
            columns.append(F.length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("rest")[c].alias(c))
    return work.select(*columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null or without letters, and those of which no language is likely."""
    model = fit_language_model(docs, ~held_out("doc_id"))
    judged = model.predict(docs.select(_rest(docs), "text"))
    if not model.labels:  # nothing to judge by
        return _restored(docs, judged)
    return _restored(docs, judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the lines of later occurrences of repeated three-line windows, and documents of which nothing is left."""
    cleaned = drop_repeated_windows(docs.select(_rest(docs), "doc_id", "text"))
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"\S")
    return _restored(docs, cleaned.where(left), changed=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents the one of least doc_id; texts without words all stay."""
    with scratch_tables(spark) as scratch:
        numbered = store(docs.select(_rest(docs), "doc_id", "text", F.monotonically_increasing_id().alias("id")))
        groups = store(similar_groups(numbered, row_id="id").select("id", "doc_id", "group"))
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "id")
        first = groups.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(order).alias("first"))
        kept = store(first.select("first.id").unionByName(groups.where(F.col("group").isNull()).select("id")))
        scratch.keep(numbered, kept)
    return _restored(docs, numbered.join(if_small(kept, 16), "id", "left_semi"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_leaks(docs.select(_rest(docs), "text"), items)
    return _restored(docs, found.where(F.size("leaks") == 0))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their places in sequences of 2048 tokens."""
    return pack_documents(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("language_id", known_language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # a fitted model, alignment and branch and bound are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    with scratch_tables(spark) as scratch:
        for k, (_, stage) in enumerate(STAGES[:-1]):
            before = docs
            with scratch_tables(spark) as own:  # a stage's tables go when its output is written
                docs = store(stage(spark, before, sf_dir))
                own.keep(docs)
            if k:
                scratch.drop(before)
        scratch.keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
