"""Cross-validation and permutation importance."""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.config import SEED, Features
from tabulon.functions.hashing import hash_number, order_hash
from tabulon.functions.ranks import global_position
from tabulon.operators.cleaning import check_preflight
from tabulon.operators.splits import with_folds
from tabulon.operators.transforms import fit_labels
from tabulon.plans.training import Prepared, TrainedModel, prepare_training, score, train, train_prepared
from tabulon.session import materialize
from tabulon.sources.tables import literal_rows

METRICS = ("log_loss", "accuracy", "f1", "precision", "recall", "roc_auc")


def fold_table(df: DataFrame, features: Features, target: str, group: str, key: str, folds: int, seed: int) -> DataFrame:
    """The rows with their fold, written once and read by every fit of a search."""
    check_preflight(df, target, group, folds)
    slim = df.select(*dict.fromkeys([key, target, group, *features.columns]))
    return materialize(with_folds(slim, target, group, folds, seed).drop(group))


class SharedPreparations:
    """Fitted steps and stored inputs of each fold, made once for all trials of a search that prepare rows alike."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._locks: dict[tuple, threading.Lock] = {}
        self._made: dict[tuple, Prepared] = {}

    def get(self, key: tuple, make: Callable[[], Prepared]) -> Prepared:
        with self._lock:
            own = self._locks.setdefault(key, threading.Lock())
        with own:
            if key not in self._made:
                self._made[key] = make()
            return self._made[key]


def validate_folds(
    folded: DataFrame,
    features: Features,
    target: str,
    key: str,
    folds: int,
    model: str,
    params: dict | None = None,
    seed: int = SEED,
    parallel: int = 2,
    fit: Callable[..., TrainedModel] = train,
    shared: SharedPreparations | None = None,
) -> list[dict[str, float]]:
    """Metrics of each fold, trained on the others by ``fit``; the fits run as concurrent Spark jobs. With ``shared``, for one
    folded table and seed, steps that other models have had fitted alike are taken from there."""
    labels = fit_labels(folded, target)

    def one(fold: int) -> dict[str, float]:
        rows = folded.where(F.col("fold") != fold)
        if shared is None:
            fitted = fit(rows, features, target, key, model, params, seed, labels)
        else:
            ready = shared.get((fold, features), lambda: prepare_training(rows, features, target, key, seed, labels))
            fitted = train_prepared(ready, model, params, seed)
        return score(fitted, folded.where(F.col("fold") == fold), target)

    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(one, range(folds)))


def cross_validate(
    df: DataFrame,
    features: Features,
    target: str,
    group: str,
    key: str,
    model: str,
    params: dict | None = None,
    folds: int = 3,
    seed: int = SEED,
    parallel: int = 2,
    fit: Callable[..., TrainedModel] = train,
) -> DataFrame:
    """(fold, metrics...): no group is trained on and scored in the same fold."""
    folded = fold_table(df, features, target, group, key, folds, seed)
    found = validate_folds(folded, features, target, key, folds, model, params, seed, parallel, fit)
    return fold_metrics(df, found)


def fold_metrics(df: DataFrame, found: list[dict[str, float]]) -> DataFrame:
    rows = [(fold, *[metrics.get(m) for m in METRICS]) for fold, metrics in enumerate(found)]
    return literal_rows(df.sparkSession, {"fold": "int"} | {m: "double" for m in METRICS}, rows)


def mean_over_folds(metrics: DataFrame) -> DataFrame:
    """Unweighted mean of each metric."""
    return metrics.agg(*[F.avg(m).alias(m) for m in metrics.columns if m != "fold"])


def permutation_importance(
    model: TrainedModel, df: DataFrame, target: str, key: str, repeats: int = 10, seed: int = SEED
) -> DataFrame:
    """(feature, importance, deviation): loss of accuracy when one column is exchanged between rows.

    The rows are put in a seeded random order once. In each repeat every row takes values from
    the row a random distance further round that circle, so one equi-join on the place serves
    all repeats and features, and all exchanged tables are scored in one pass.
    """
    features = list(model.classifier.features)
    slim = model.prepare(df).select(F.col(key).alias("_key"), target, *features)
    placed = materialize(global_position(slim.withColumn("_h", order_hash(seed, "_key")), ["_h", "_key"], "_at").drop("_h"))
    n = placed.count()
    if n < 2:
        raise ValueError("exchanging values needs at least 2 rows")
    donors = placed.select("_at", *[F.col(f).alias(f"_new_{f}") for f in features])
    shift = F.pmod(hash_number(f"{seed}shift", "_repeat"), F.lit(n - 1)) + 1
    asked = placed.withColumn("_repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    asked = asked.withColumn("_from", F.pmod(F.col("_at") + shift, F.lit(n)))
    paired = asked.drop("_at").join(donors.withColumnRenamed("_at", "_from"), "_from")
    variants = F.explode(F.array(*[F.lit(f) for f in features])).alias("_feature")
    exchanged = paired.select("*", variants)
    exchanged = exchanged.withColumns(
        {f: F.when(F.col("_feature") == f, F.col(f"_new_{f}")).otherwise(F.col(f)) for f in features}
    )
    hit = F.avg((F.col("prediction") == F.col(target)).cast("double"))
    base = model.classifier.predict(placed).agg(hit).scalar()
    scored = model.classifier.predict(exchanged.select("_repeat", "_feature", target, *features))
    per_repeat = scored.groupBy("_feature", "_repeat").agg(hit.alias("_accuracy"))
    return per_repeat.groupBy(F.col("_feature").alias("feature")).agg(
        (base - F.avg("_accuracy")).alias("importance"), F.stddev_pop("_accuracy").alias("deviation")
    )
