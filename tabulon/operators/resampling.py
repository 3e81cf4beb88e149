"""Class balancing. Used on training rows only, after scaling and before the model."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.hashing import hash_cutoffs, hash_number, order_hash
from tabulon.functions.joins import attach, few_or_stored
from tabulon.functions.neighbours import nearest_neighbours
from tabulon.operators.cleaning import require_columns
from tabulon.session import materialize

NEIGHBOURS = 5
COPIES_PER_TASK_ROW = 1_000
MOST_CLASSES = 10_000


def _counted(df: DataFrame, target: str) -> tuple[DataFrame, int]:
    """(class, n), and the number of classes. A row without class belongs to none: it is refused here for weights, resampling and models alike."""
    require_columns(df, [target])
    counts, classes = few_or_stored(df.groupBy(target).agg(F.count("*").alias("n")))
    lost = counts.where(F.col(target).isNull()).select("n").first()
    if lost:
        raise ValueError(f"{lost[0]} rows have no value of {target!r}")
    return counts, classes


def class_counts(df: DataFrame, target: str) -> dict:
    """Rows per class, of at most 10,000 classes: the labels of a model, which the driver holds anyway."""
    counts, classes = _counted(df, target)
    if classes > MOST_CLASSES:
        raise ValueError(f"{target!r} has more than {MOST_CLASSES} classes")
    return {r[0]: r[1] for r in counts.collect()}


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """(class, n, weight) with weight n_rows / (n_classes · n). Rows without class are refused."""
    counts, classes = _counted(df, target)
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.withColumn("weight", F.lit(total) / (F.lit(classes) * F.col("n")))


def undersample(df: DataFrame, target: str, key: str, seed: int) -> DataFrame:
    """Every class down to the smallest one, without replacement: the rows of lowest hash.

    Rows without class are refused. Classes and their cutoffs are tables, so their number is not bounded.
    """
    require_columns(df, [target, key])
    counts, classes = _counted(df, target)
    smallest = counts.agg(F.min("n")).first()[0]
    larger = counts.where(F.col("n") > smallest)
    if smallest is None or larger.isEmpty():
        return df
    hashed = df.select(target, order_hash(seed, key).alias("_h"))
    hashed = attach(hashed, larger.withColumn("_n", F.col("n")), [target], size_col="_n", stored_rows=classes).where("n is not null")
    cutoffs, found = hash_cutoffs(hashed, "_h", target, F.lit(smallest))
    sized = cutoffs.join(larger, target).withColumnRenamed("cutoff", "_cutoff")
    marked = attach(df, sized, [target], size_col="n", stored_rows=found)
    kept = F.col("_cutoff").isNull() | (order_hash(seed, key) <= F.col("_cutoff"))
    return marked.where(kept).select(*df.columns)


def smote(df: DataFrame, target: str, key: str, features: Sequence[str], seed: int, k: int = NEIGHBOURS) -> DataFrame:
    """Every class up to the largest one by points between a row and one of its k neighbours.

    Returns target, features and ``synthetic``. Each row of a class serves as a base equally
    often (the remainder goes to the rows of lowest hash); neighbour and place on the line
    follow from the seed, the key and the copy number. Rows without class are refused. All classes are
    treated in the same jobs, whatever their number.
    """
    features = list(features)
    require_columns(df, [target, key, *features])
    df = materialize(df.select(key, target, *features))  # read by every step below
    incomplete = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in features])
    if not df.where(incomplete).isEmpty():
        raise ValueError("rows with missing features cannot be interpolated; impute first")
    counts, classes = _counted(df, target)
    originals = df.select(target, *[F.col(c).cast("double").alias(c) for c in features], F.lit(False).alias("synthetic"))
    largest = counts.agg(F.max("n")).first()[0]
    short_classes = counts.where(F.col("n") < largest) if largest else counts
    if short_classes.isEmpty():
        return originals
    small = [r[0] for r in short_classes.where(F.col("n") <= k).limit(20).collect()]
    if small:
        raise ValueError(f"classes with too few rows for {k} neighbours, among them {small}")

    lacking = F.lit(largest) - F.col("n")
    need = short_classes.select(
        target, F.call_function("div", lacking, F.col("n")).alias("_whole"), (lacking % F.col("n")).alias("_extra"), F.col("n").alias("_n")
    )
    values = df.select(F.col(key).alias("_key"), target, *[F.col(c).cast("double").alias(c) for c in features])
    short = attach(values, need, [target], size_col="_n", stored_rows=classes).where("_whole is not null")
    short = short.withColumn("_hash", order_hash(seed, "_key"))
    cutoffs, found = hash_cutoffs(short, "_hash", target, F.col("_extra"))
    marked = attach(short, cutoffs.join(need.select(target, "_n"), target), [target], size_col="_n", stored_rows=found)
    copies = F.col("_whole") + (F.col("_hash") <= F.col("cutoff")).cast("int")
    bases = marked.withColumn("_copies", copies.cast("long")).where("_copies > 0").drop("_hash", "_whole", "_extra", "cutoff")
    short = short.select("_key", target, *features)

    near = nearest_neighbours(short, bases, target, features, k)
    based = attach(bases, near, [target, *features], size_col="copies")
    # a row that must serve very often is first split over tasks, then expanded
    chunks = F.floor((F.col("_copies") - 1) / COPIES_PER_TASK_ROW)
    based = based.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks)))
    based = based.repartition("_key", "_chunk")
    first = F.col("_chunk") * COPIES_PER_TASK_ROW
    last = F.least(first + COPIES_PER_TASK_ROW, F.col("_copies")) - 1
    drawn = based.withColumn("_copy", F.explode(F.sequence(first, last)))
    pick = F.element_at("neighbours", (F.pmod(hash_number(f"{seed}n", "_key", "_copy"), F.lit(k)) + 1).cast("int"))
    drawn = drawn.select(
        target, *features, pick.alias("_near"), (hash_number(f"{seed}u", "_key", "_copy") / F.lit(2.0**32)).alias("_u")
    )
    created = drawn.select(
        target,
        *[(F.col(c) + F.col("_u") * (F.get("_near", F.lit(d)) - F.col(c))).alias(c) for d, c in enumerate(features)],
        F.lit(True).alias("synthetic"),
    )
    return originals.unionByName(created)


def _weights_only(df: DataFrame, target: str, key: str, features: Sequence[str], seed: int) -> DataFrame:
    return df


def _undersampled(df: DataFrame, target: str, key: str, features: Sequence[str], seed: int) -> DataFrame:
    return undersample(df, target, key, seed)


RESAMPLERS: dict[str, Callable[..., DataFrame]] = {
    "smote": smote,
    "undersampling": _undersampled,
    "class_weight": _weights_only,
}


def resample(df: DataFrame, strategy: str | None, target: str, key: str, features: Sequence[str], seed: int) -> DataFrame:
    """By name; None leaves the rows alone, as does ``class_weight``, which acts in the model."""
    if strategy is None:
        return df
    if strategy not in RESAMPLERS:
        raise ValueError(f"unknown resampling {strategy!r}; choose from {sorted(RESAMPLERS)}")
    return RESAMPLERS[strategy](df, target, key, features, seed)
