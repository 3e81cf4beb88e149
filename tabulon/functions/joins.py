"""Joins to lookup tables whose size is measured before anything is broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.session import materialize_sized

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64_000_000
FEW_ROWS = 1_000
HEAVY_KEYS = 1_000
SALTS = 9_973


def few_or_stored(table: DataFrame) -> tuple[DataFrame, int]:
    """A small lookup and how long it is: as a local table if it has at most ``FEW_ROWS`` rows, which needs no
    files and no measuring, else stored. Meant for tables that are likely to be small, of classes or cells."""
    rows = table.limit(FEW_ROWS + 1).toArrow()
    if rows.num_rows <= FEW_ROWS:
        return table.sparkSession.createDataFrame(rows, table.schema), rows.num_rows
    return materialize_sized(table)


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    size_col: str | None = None,
    limit: int | None = None,
    stored_rows: int | None = None,
) -> DataFrame:
    """Left-join the columns of ``lookup`` (one row per key) to ``rows``.

    A lookup of few rows and bytes is broadcast. A large one is shuffled; if ``size_col`` says how many
    rows carry each key, the keys above a 1/1000 share (at most 1000 of them) are broadcast all
    the same and their rows spread, so that no shuffle partition receives a hot key. Rows should
    differ from each other, as they do with a row key or after counting equal rows. ``size_col``
    is not returned.
    ``stored_rows`` says that the lookup is read from a stored table and how long it is; without
    it the lookup is stored and measured here.
    """
    limit = BROADCAST_ROWS if limit is None else limit
    if stored_rows is None:
        lookup, stored_rows = materialize_sized(lookup)
    payload = lookup.drop(size_col) if size_col else lookup
    if stored_rows <= min(limit, FEW_ROWS) or stored_rows <= limit and _text_bytes(payload) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(payload), on, "left")
    if size_col is None:
        return rows.join(payload, on, "left")

    # heavy keys take their values from a broadcast and only pass through the shuffle, spread by a
    # salt that matches nothing there; every other key meets its lookup row under salt 0
    values = F.struct(*[c for c in payload.columns if c not in on])
    total = lookup.agg(F.sum(size_col)).scalar()
    is_heavy = F.col(size_col) * HEAVY_KEYS > total
    heavy = lookup.where(is_heavy).select(*on, values.alias("_hot"))
    light = lookup.where(~is_heavy).select(*on, F.lit(0).cast("long").alias("_salt"), values.alias("_cold"))
    tagged = rows.join(F.broadcast(heavy), on, "left")
    spread = 1 + F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    # a null key matches nothing either
    apart = reduce(lambda a, b: a | b, [F.col("_hot").isNotNull(), *[F.col(c).isNull() for c in on]])
    tagged = tagged.withColumn("_salt", F.when(apart, spread).otherwise(F.lit(0)))
    joined = tagged.join(light, [*on, "_salt"], "left").withColumn("_value", F.coalesce("_hot", "_cold"))
    return joined.select(*rows.columns, "_value.*")


def _text_bytes(stored: DataFrame) -> int:
    """Size of a stored table of few rows, as text."""
    return stored.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
