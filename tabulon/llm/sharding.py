"""Contiguous shards of nearly equal bytes, from prefix sums over per-partition totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.tables import ROW_BITS, store

BLOCK_BITS = 12  # a partition's rows are summed in blocks of 4096, so that no window sees more


def text_size(text: str = "text", overhead: int = 16) -> Column:
    """UTF-8 bytes of a text plus a constant; null has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")


def shard_contiguous(rows: DataFrame, size: Column, shards: int) -> DataFrame:
    """The rows with ``size``, ``shard`` and ``slot`` (place in the shard, gapless from 0).

    The order is that of the input: partition after partition, each in its own order. Totals per
    partition and block are added up, each row starts where the rows before it end, and a row belongs to
    the shard in whose equal part of all bytes its middle lies. So a shard differs from the mean by
    less than its two border rows, shards are contiguous, and those may be empty that one huge row spans.
    Input columns named like the added ones are replaced. An empty input gives an empty result; rows
    alike are told apart by their place.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    added = ("size", "shard", "slot")
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in added]).alias("row")
    placed = store(rows.select(row, size.alias("size"), F.monotonically_increasing_id().alias("id"))).select(
        "*",
        F.shiftright("id", ROW_BITS).alias("part"),
        F.shiftright(F.col("id").bitwiseAND((1 << ROW_BITS) - 1), BLOCK_BITS).alias("block"),
    )
    blocks = placed.groupBy("part", "block").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    parts = blocks.groupBy("part").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    total = max(parts.agg(F.sum("bytes")).first()[0] or 0, 1)

    def before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    over_parts = Window.partitionBy(F.lit(0)).orderBy("part")  # one row per partition of the input
    over_blocks = Window.partitionBy("part").orderBy("block")
    part_starts = parts.select("part", before("bytes", over_parts).alias("b"), before("n", over_parts).alias("r"))
    starts = blocks.join(F.broadcast(part_starts), "part").select(
        "part",
        "block",
        (F.col("b") + before("bytes", over_blocks)).alias("b"),
        (F.col("r") + before("n", over_blocks)).alias("r"),
    )
    in_block = Window.partitionBy("part", "block").orderBy("id")
    located = placed.join(starts, ["part", "block"]).select(
        "row",
        "size",
        (F.col("b") + before("size", in_block)).alias("start"),
        (F.col("r") + F.row_number().over(in_block) - 1).alias("place"),
    )
    middle = (2 * F.col("start") + F.col("size")) * shards
    located = located.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle / (2 * total)).cast("int")))
    firsts = located.groupBy("shard").agg(F.min("place").alias("first"))  # a row per shard at most
    return located.join(F.broadcast(firsts), "shard").select(
        "row.*", "size", "shard", (F.col("place") - F.col("first")).alias("slot")
    )
