"""Train/test, fold, time and batch splits.

Sides are decided by comparing each row with a cutoff (a time value, or a hash of the group),
so that rows are labelled in a narrow stage: nothing is sorted or joined to split a table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.hashing import hash_cutoff, order_hash
from tabulon.functions.joins import attach
from tabulon.functions.quantiles import order_statistics
from tabulon.functions.ranks import global_position
from tabulon.operators.cleaning import require_columns
from tabulon.session import materialize

TRAIN, TEST, PROD = "train", "test", "prod"


@dataclass(frozen=True)
class TimeCut:
    """Rows after ``time``, and among equal times those after ``key``, are production rows."""

    time_col: str
    key: str
    time: object
    after_key: object | None
    n_train: int
    n_prod: int

    def is_prod(self) -> Column:
        later = F.col(self.time_col) > F.lit(self.time)
        same = F.col(self.time_col) == F.lit(self.time)
        if self.after_key is None:
            return later | same
        return later | (same & (F.col(self.key) > F.lit(self.after_key)))

    def side(self) -> Column:
        return F.when(self.is_prod(), F.lit(PROD)).otherwise(F.lit(TRAIN))


def fit_time_cut(df: DataFrame, time_col: str, key: str, fraction: float) -> TimeCut:
    """The newest ``int(fraction · n)`` rows go to production, ties in time by key.

    The border time is an exact order statistic; only the rows of that one time are ever
    looked at by key.
    """
    require_columns(df, [time_col, key])
    if not 0 < fraction < 1:
        raise ValueError("the holdout fraction must lie between 0 and 1")
    slim = df.select(time_col, key)
    n = slim.count()
    n_prod = int(fraction * n)
    if n_prod < 1:
        raise ValueError("the production side would have no rows")
    border = order_statistics(slim, {time_col: [n - n_prod]})[time_col][n - n_prod]
    later, same = slim.agg(
        F.count_if(F.col(time_col) > F.lit(border)), F.count_if(F.col(time_col) == F.lit(border))
    ).first()
    from_ties = n_prod - later
    if from_ties == same:
        after_key = None
    else:
        ties = slim.where(F.col(time_col) == F.lit(border)).select(key)
        after_key = _kth_key(ties, key, same - from_ties - 1)
    return TimeCut(time_col, key, border, after_key, n - n_prod, n_prod)


def _kth_key(df: DataFrame, key: str, rank: int):
    if isinstance(df.schema[key].dataType, T.NumericType):
        return order_statistics(df, {key: [rank]})[key][rank]
    return global_position(df, [key]).where(F.col("position") == rank).first()[key]


def temporal_holdout(df: DataFrame, time_col: str, key: str, fraction: float) -> DataFrame:
    """Adds ``side`` (train / prod)."""
    return df.withColumn("side", fit_time_cut(df, time_col, key, fraction).side())


def split_metadata(df: DataFrame, time_col: str, side_col: str, fraction: float) -> DataFrame:
    """One row: sizes and truncated time ranges of both sides, ratio and method."""
    t, name = F.col(time_col), time_col.lower()
    train, prod = F.col(side_col) == TRAIN, F.col(side_col) == PROD
    return df.agg(
        F.lit(float(fraction)).alias("split_prod_ratio"),
        F.count_if(train).alias("n_train"),
        F.count_if(prod).alias("n_prod"),
        F.min(F.when(train, t)).cast("long").alias(f"train_{name}_min"),
        F.max(F.when(train, t)).cast("long").alias(f"train_{name}_max"),
        F.min(F.when(prod, t)).cast("long").alias(f"prod_{name}_min"),
        F.max(F.when(prod, t)).cast("long").alias(f"prod_{name}_max"),
        F.lit(f"time_based_{time_col}").alias("split_method"),
    )


def batch_slices(df: DataFrame, time_col: str, key: str, batch_size: int) -> DataFrame:
    """Adds the 1-based ``batch`` of ``batch_size`` rows each in time order, the last one short."""
    if batch_size < 1:
        raise ValueError("a batch needs at least one row")
    placed = global_position(df, [time_col, key], "_position")
    batch = F.floor(F.col("_position") / batch_size).cast("long") + 1
    return placed.withColumn("batch", batch).drop("_position")


@dataclass(frozen=True)
class GroupCut:
    """Groups whose seeded hash is not above ``cutoff`` are training groups."""

    group: str
    seed: int
    cutoff: str
    n_train_groups: int
    n_test_groups: int

    def side(self) -> Column:
        in_train = order_hash(self.seed, self.group) <= F.lit(self.cutoff)
        return F.when(in_train, F.lit(TRAIN)).otherwise(F.lit(TEST))


def fit_group_cut(df: DataFrame, group: str, train_share: float, seed: int) -> GroupCut:
    """``floor(share · groups)`` groups go to training; the share is of groups, not of rows."""
    require_columns(df, [group])
    if not 0 < train_share < 1:
        raise ValueError("the training share must lie between 0 and 1")
    groups = df.where(F.col(group).isNotNull()).groupBy(group).agg(order_hash(seed, group).alias("h"))
    groups = materialize(groups.select("h"))
    n = groups.count()
    n_train = math.floor(train_share * n)
    if n_train < 1 or n_train == n:
        raise ValueError(f"{n} groups cannot be split into two sides at {train_share}")
    return GroupCut(group, seed, hash_cutoff(groups, "h", n_train), n_train, n - n_train)


def group_shuffle_split(df: DataFrame, group: str, train_share: float, seed: int) -> DataFrame:
    """Adds ``side`` (train / test); no group is on both sides."""
    return df.withColumn("side", fit_group_cut(df, group, train_share, seed).side())


def stratified_group_folds(df: DataFrame, target: str, group: str, folds: int, seed: int) -> DataFrame:
    """(group, fold): whole groups dealt into folds with class shares close to each other.

    Groups are put in order of their majority class (smallest name among ties), then size,
    then seeded hash, and dealt to and fro over the folds. Neighbours in that order are alike,
    so every fold gets the same mix, and as long as there are enough groups none stays empty.
    """
    if folds < 2:
        raise ValueError(f"at least 2 folds are needed, not {folds}")
    sizes = df.groupBy(group, target).agg(F.count("*").alias("_n"))
    groups = sizes.groupBy(group).agg(
        F.min(F.struct((-F.col("_n")).alias("_less"), F.col(target).alias("_class")))["_class"].alias("_majority"),
        F.sum("_n").alias("group_rows"),
    )
    order = [F.col("_majority"), F.col("group_rows").desc(), F.col("_hash")]
    placed = global_position(groups.withColumn("_hash", order_hash(seed, group)), order, "_position")
    lap, step = F.floor(F.col("_position") / folds), F.col("_position") % folds
    fold = F.when(lap % 2 == 0, step).otherwise(folds - 1 - step).cast("int")
    return placed.select(group, "group_rows", fold.alias("fold"))


def with_folds(df: DataFrame, target: str, group: str, folds: int, seed: int) -> DataFrame:
    """Adds ``fold``; the fold table is joined by its measured size, hot groups apart."""
    table = stratified_group_folds(df, target, group, folds, seed)
    return attach(df, table, [group], size_col="group_rows")


def row_split(df: DataFrame, key: str, test_share: float, seed: int) -> DataFrame:
    """Adds ``side``: rows in seeded hash order, the last ``int(share · n)`` of them are test rows.

    Needs a unique key. The side is a comparison with one hash; the rows are not sorted.
    """
    if not 0 < test_share < 1:
        raise ValueError("the test share must lie between 0 and 1")
    hashed = df.select(order_hash(seed, key).alias("h"))
    n = hashed.count()
    cutoff = hash_cutoff(hashed, "h", n - int(test_share * n))
    in_train = order_hash(seed, key) <= F.lit(cutoff)
    return df.withColumn("side", F.when(in_train, F.lit(TRAIN)).otherwise(F.lit(TEST)))


def shared_groups(train: DataFrame, test: DataFrame, group: str) -> DataFrame:
    """Groups present on both sides; empty for a split without leak."""
    return train.select(group).intersect(test.select(group))


def unseen_labels(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Labels of the test side that training never saw."""
    return test.select(label).distinct().join(train.select(label).distinct(), label, "left_anti")


def check_labels_seen(train: DataFrame, test: DataFrame, label: str) -> None:
    unseen = unseen_labels(train, test, label)
    n = unseen.count()
    if n:
        some = [r[0] for r in unseen.limit(20).collect()]
        raise ValueError(f"{n} labels of the test side that training never saw, among them {some}")
