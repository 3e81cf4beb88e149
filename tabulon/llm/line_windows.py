"""Removal of repeated passages found as windows of three consecutive lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.tables import store
from tabulon.session import scratch_tables

WINDOW = 3


def _lines(text: str | Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; in a lambda a plain expression would be computed for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _windows(text: Column, width: int) -> Column:
    """Per window over the lines that are not blank: its first line's index, its lines, its hashes."""
    numbered = F.transform(_lines(text), lambda x, i: F.struct(x.alias("line"), i.alias("i")))
    filled = F.filter(numbered, lambda x: x["line"].rlike(r"\S"))

    def window(full: Column, k: Column) -> Column:
        at = [F.element_at(full, k + j) for j in range(width)]
        text = [x["line"] for x in at]
        return F.struct(
            at[0]["i"].alias("at"),
            F.array(*[x["i"] for x in at]).alias("lines"),
            F.xxhash64(*text).alias("h1"),
            F.xxhash64(F.lit(7), *text).alias("h2"),
        )

    def windows(full: Column) -> Column:
        places = F.when(F.size(full) >= width, F.sequence(F.lit(1), F.size(full) - width + 1))
        return F.transform(places, lambda k: window(full, k))

    return _let(filled, windows)


def drop_repeated_windows(docs: DataFrame, text: str = "text", order: str = "doc_id", width: int = WINDOW) -> DataFrame:
    """The documents with ``text`` less its repeated lines, and ``n_lines`` and ``n_removed``.

    Lines end at a line feed and are compared unchanged. Windows are the runs of ``width`` lines that
    are not blank; blank lines between them count as absent and always stay. Of all windows with the same
    lines the first stays, by ``order`` (null first), then by place in the input, then by line;
    each line that any later one covers goes. A line stays only where no later window covers it, so of
    a line repeated within one document the first is left.

    A null text stays null and counts no lines; an empty text has one line; a text of fewer lines
    than a window stays as it is. Equal rows are told apart by their place. Columns named ``n_lines`` or ``n_removed`` are
    replaced. Only 128-bit hashes are compared and shuffled, with copies counted before the shuffle.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    body = F.col("doc")[text]
    with scratch_tables(docs.sparkSession) as scratch:
        stored = store(
            docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.monotonically_increasing_id().alias("id"))
        )
        found = store(
            stored.select("id", F.col("doc")[order].alias("order"), F.explode(_windows(body, width)).alias("w")).select(
                "id", "order", "w.*"
            )
        )
        place = F.struct("order", "id", "at")
        firsts = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
        firsts = store(firsts)  # adaptive execution splits a hot window only between plain exchanges
        later = store(
            found.join(firsts, ["h1", "h2"])
            .where((F.col("id") != F.col("first.id")) | (F.col("at") != F.col("first.at")))
            .groupBy("id")
            .agg(F.flatten(F.collect_list("lines")).alias("gone"))  # of one document
            .select("id", F.array_distinct("gone").alias("gone"))
        )
        scratch.keep(stored, later)

    def joined(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(left, lambda k: F.element_at(lines, k + 1)), "\n")

    cleaned = F.when(F.col("gone").isNull(), body).otherwise(_let(_lines(body), joined))
    columns = [cleaned.alias(text) if c == text else F.col("doc")[c].alias(c) for c in kept]
    return stored.join(later, "id", "left").select(
        *columns,
        F.when(body.isNull(), 0).otherwise(F.size(_lines(body))).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
