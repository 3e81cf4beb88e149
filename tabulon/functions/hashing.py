"""Seeded shuffling by hash: a row's place depends on the seed and its key only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.joins import few_or_stored
from tabulon.session import materialize

DIGITS = 3  # hex digits per round: at most 4096 counters per group
FINAL_HASHES = 4_096
FEW_GROUPS = 100_000
_ALL = "g"  # sorts after every hex digit


def order_hash(seed: int | str, *keys: str | Column) -> Column:
    """Hash that orders rows pseudo-randomly, the same on any partitioning."""
    return F.md5(F.concat_ws(",", F.lit(str(seed)), *keys))


def hash_number(seed: int | str, *keys: str | Column) -> Column:
    """Integer in [0, 2^32) from the same kind of hash."""
    return F.conv(F.substring(order_hash(seed, *keys), 1, 8), 16, 10).cast("long")


def hash_cutoff(df: DataFrame, hash_col: str, take: int) -> str:
    """The hash up to which exactly ``take`` rows lie; callers keep the rows whose hash is not above it.

    Counts rows by leading hex digits and goes on inside the one bucket that holds the border, so taking n
    shuffled rows needs no sort, and at most 4096 counters come to the driver at once.
    """
    prefix, wanted = "", take
    if wanted <= 0:
        return ""
    while True:
        width = len(prefix) + DIGITS
        inside = df.where(F.col(hash_col).startswith(prefix))
        for start, n in sorted(map(tuple, inside.groupBy(F.substring(hash_col, 1, width)).agg(F.count("*")).collect())):
            if n >= wanted:
                break
            wanted -= n
        else:
            return _ALL
        if n == wanted:
            return start + _ALL
        if n <= FINAL_HASHES:
            few = sorted(r[0] for r in df.where(F.col(hash_col).startswith(start)).select(hash_col).collect())
            if few[wanted] == few[wanted - 1]:
                raise ValueError("the key is not unique: rows share a hash at the border")
            return few[wanted - 1]
        if width >= 32:
            raise ValueError("the key is not unique: rows share a hash at the border")
        prefix = start


def hash_cutoffs(df: DataFrame, hash_col: str, by: str, take: Column) -> tuple[DataFrame, int]:
    """(by, cutoff) per ``by`` value of ``df``, and their number: what ``hash_cutoff`` gives, for all groups at once.

    The open borders are a table, and so is the result. Each round leaves about one in 4096 rows of a group, and
    its plan is the same for one group and for a million. ``take`` is an expression over columns of ``df`` that are
    equal within a group. ``df`` is read three times.
    """
    rows = df.select(F.col(by).alias("_by"), F.col(hash_col).alias("_h"), take.cast("long").alias("_take"))
    cutoff = F.when(F.max("_take") <= 0, F.lit("")).when(F.max("_take") >= F.count("*"), F.lit(_ALL))
    groups, _ = few_or_stored(rows.groupBy("_by").agg(F.max("_take").alias("_wanted"), F.count("*").alias("_n"), cutoff.alias("_cutoff")))
    found = [groups.where("_cutoff is not null").select("_by", "_cutoff")]
    open_groups = groups.where("_cutoff is null").select("_by", F.lit("").alias("_prefix"), "_wanted", "_n")
    rows, width = rows.select("_by", "_h"), 0
    while not open_groups.isEmpty():
        found.append(_last_hashes(rows, open_groups.where(F.col("_n") <= FINAL_HASHES), width))
        open_groups = open_groups.where(F.col("_n") > FINAL_HASHES)
        if open_groups.isEmpty():
            break
        if width >= 32:
            raise ValueError("the key is not unique: rows share a hash at the border")
        inside = rows.join(_sized(open_groups.drop("_n")), "_by").where(F.substring("_h", 1, width) == F.col("_prefix"))
        counted = inside.groupBy("_by", "_wanted", F.substring("_h", 1, width + DIGITS).alias("_p")).agg(F.count("*").alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy("_by").orderBy("_p"))  # at most 4096 rows a group
        border = counted.withColumn("_upto", upto).where("_upto >= _wanted and _upto - _n < _wanted")
        border, _ = few_or_stored(border.select("_by", "_p", (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_wanted"), "_n"))
        found.append(border.where("_wanted = _n").select("_by", F.concat("_p", F.lit(_ALL)).alias("_cutoff")))
        open_groups = border.where("_wanted < _n").select("_by", F.col("_p").alias("_prefix"), "_wanted", "_n")
        width += DIGITS
        if open_groups.where(F.col("_n") > FINAL_HASHES).isEmpty():
            continue  # what is left is read once more
        kept = rows.join(_sized(open_groups.select("_by", F.col("_prefix").alias("_p"))), "_by")
        rows = materialize(kept.where(F.substring("_h", 1, width) == F.col("_p")).select("_by", "_h"))
    table = reduce(DataFrame.unionByName, found)
    return few_or_stored(table.select(F.col("_by").alias(by), F.col("_cutoff").alias("cutoff")))


def _last_hashes(rows: DataFrame, groups: DataFrame, width: int) -> DataFrame:
    """The hash of the wanted place among the few rows that share a group's prefix."""
    few = rows.join(_sized(groups.drop("_n")), "_by").where(F.substring("_h", 1, width) == F.col("_prefix"))
    order = Window.partitionBy("_by").orderBy("_h")
    placed = few.withColumns({"_at": F.row_number().over(order), "_next": F.lead("_h").over(order)}).where("_at = _wanted")
    shared = F.raise_error(F.lit("the key is not unique: rows share a hash at the border"))
    return placed.select("_by", F.when(F.col("_next") == F.col("_h"), shared.cast("string")).otherwise(F.col("_h")).alias("_cutoff"))


def _sized(groups: DataFrame) -> DataFrame:
    """For broadcast if there are few groups; else rows and groups are shuffled, and adaptive execution splits hot groups."""
    return F.broadcast(groups) if groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS else groups
