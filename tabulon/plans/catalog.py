"""Named queries over a data directory, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.config import BAND_PAIRS, SEED, SENTINELS, Cleaning, Features, GroupSplit, SearchSettings
from tabulon.functions.hashing import hash_number
from tabulon.functions.ranks import average_ranks
from tabulon.operators import cleaning, density, dependence, drift, evaluation, profile, resampling, splits, transforms
from tabulon.plans.observations import COLUMNS, MISSING, load, observations
from tabulon.plans.scoring import Predictor, expected_inputs, score_table
from tabulon.plans.search import run_experiment, run_search, trial_table
from tabulon.plans.training import TrainedModel, train, train_and_evaluate
from tabulon.plans.validation import cross_validate, mean_over_folds, permutation_importance
from tabulon.session import materialize, scratch_path
from tabulon.sources import artifacts, contracts, fingerprints, tables
from tabulon.streaming import scoring as streams

BANDS = ("u", "g", "r", "i", "z")
FEATURES = Features()
CLASSES = ("F", "O", "P")
KEYED = Cleaning(SENTINELS, BAND_PAIRS, ("run_id", "mjd", "u", "g", "i", "z"))
SCORED = Cleaning(SENTINELS, BAND_PAIRS, ("obj_id", "run_id", "mjd", "u", "g", "i", "z"))


@dataclass(frozen=True)
class ThresholdRule:
    """A fixed rule in the place of a fitted classifier, so that what is done with predictions can be told from them."""

    features: tuple[str, ...] = ("r", "redshift")
    labels: tuple[str, ...] = CLASSES
    has_probabilities: bool = False

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.when(F.col("r") > 150_000, "F").when(F.col("redshift") < 3_000, "O").otherwise("P"))


RULE = TrainedModel(transforms.MedianImputer({}), transforms.Scaler("standard", {}, {}), ThresholdRule())

# forest settings that train in seconds on the test tables; callers choose their own
QUICK_FOREST = {"n_estimators": 20, "max_depth": 6, "min_samples_leaf": 10, "criterion": "entropy"}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, for comparison with other engines."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """obj_id, field_id, class and the six model inputs."""
    return cleaning.clean(observations(spark, sf), KEYED)


def magnitudes(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return cleaning.sentinel_to_null(observations(spark, sf, *BANDS, "redshift", *more), SENTINELS)


def predictions(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """A scored table derived from the keys: three probabilities that lean to the true class."""
    rows = observations(spark, sf, "obj_id", "class", *more)
    weights = [
        1 + F.pmod(hash_number(f"w{c}", "obj_id"), F.lit(1000)) + F.when(F.col("class") == c, 300).otherwise(0)
        for c in CLASSES
    ]
    total = sum(weights[1:], weights[0])
    rows = rows.withColumn("probability", F.array(*[w.cast("double") / total for w in weights]))
    best = transforms.LabelCodes(CLASSES).decoded(transforms.argmax(F.col("probability")))
    return rows.withColumn("prediction", best)


# --- sources and sinks


def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    rows = observations(spark, sf)
    path = scratch_path(spark, "csv")
    tables.write_table(rows, path, "csv")
    return tables.read_csv(spark, path, rows.schema)


def row_count_contract(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.row_count_report(load(spark, sf, "orders"), 15_000)


def min_rows_check(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.min_rows_report(load(spark, sf, "orders"), 1_000)


def dataset_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    rows = observations(spark, sf)
    return fingerprints.table_fingerprint(rows, rows.columns)


def file_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.file_fingerprint(spark, sf, "*.parquet")


# --- projections and filters


def sentinel_to_null(spark: SparkSession, sf: str) -> DataFrame:
    return magnitudes(spark, sf, "obj_id", "class")


def color_indices(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.add_differences(observations(spark, sf, "obj_id", *BANDS), BAND_PAIRS)
    return rounded(cleaning.drop_columns(rows, BANDS))


def clean_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaned(spark, sf))


def feature_target(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.features_and_target(cleaned(spark, sf), "class", "field_id"))


def filter_sentinel_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.filter_rows(observations(spark, sf), F.col("u") == MISSING)


def drop_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_null_rows(magnitudes(spark, sf, "obj_id"), BANDS)


def replace_value(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.replace_value(observations(spark, sf, "obj_id", "run_id", "g", "class"), 22, 1)


def binary_flag(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.binary_flag(observations(spark, sf, "obj_id", "class"), "class", "O", "is_open")


def inference_input(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.inference_input(
        observations(spark, sf), expected_inputs(COLUMNS, "class", "field_id"), "class", "field_id"
    )


def preflight(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.table_preflight(observations(spark, sf, "class", "field_id"), "class", "field_id", 3)


# --- joins


def unseen_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of the production side that the training side never saw."""
    sided = splits.temporal_holdout(observations(spark, sf, "obj_id", "field_id", "mjd"), "mjd", "obj_id", 0.2)
    return splits.unseen_labels(
        sided.where(F.col("side") == splits.TRAIN), sided.where(F.col("side") == splits.PROD), "field_id"
    )


def decode_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = predictions(spark, sf).withColumn("code", transforms.argmax(F.col("probability")))
    return transforms.LabelCodes(CLASSES).decode(rows.select("obj_id", "code"), "code")


def group_side_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = observations(spark, sf, "obj_id", "field_id", "class")
    return splits.with_folds(rows, "class", "field_id", 3, SEED)


def horizontal_concat(spark: SparkSession, sf: str) -> DataFrame:
    """Features and target kept apart, put side by side again by their row key."""
    rows = observations(spark, sf, "obj_id", "r", "redshift", "class")
    return rows.drop("class").join(rows.select("obj_id", "class"), "obj_id")


# --- aggregations


def nunique(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["obj_id", "field_id", "run_id", "class", "mjd"]
    return profile.nunique(observations(spark, sf, *columns), columns)


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.value_counts(observations(spark, sf, "class"), "class"))


def value_counts_summary(spark: SparkSession, sf: str) -> DataFrame:
    counts = profile.value_counts(observations(spark, sf, "field_id"), "field_id")
    return rounded(profile.describe(counts, ["n"]))


def duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return profile.duplicate_keys(load(spark, sf, "lineitem"), "l_orderkey")


def label_consistency(spark: SparkSession, sf: str) -> DataFrame:
    return profile.label_consistency(load(spark, sf, "lineitem"), "l_orderkey", "l_returnflag")


def describe(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.describe(magnitudes(spark, sf, "mjd"), [*BANDS, "redshift", "mjd"]))


def sentinel_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.sentinel_counts(observations(spark, sf, *BANDS), BANDS, MISSING)


def moments(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.moments(magnitudes(spark, sf), [*BANDS, "redshift"]))


def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(density.histogram(observations(spark, sf, "r"), "r", 50))


def _curve(df: DataFrame) -> DataFrame:
    """Places are in the thousands, densities below 0.01: each gets the digits that sums can hold."""
    return df.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


def kde(spark: SparkSession, sf: str) -> DataFrame:
    return _curve(density.kde(observations(spark, sf, "redshift", "class"), "redshift", "class"))


def kde_common_norm(spark: SparkSession, sf: str) -> DataFrame:
    return _curve(density.kde(observations(spark, sf, "mjd", "class"), "mjd", "class", common_norm=True))


def crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return dependence.crosstab(observations(spark, sf, "run_id", "class"), "run_id", "class", CLASSES)


def chi_square(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dependence.chi_square(observations(spark, sf, "field_id", "class"), "field_id", "class"))


def chi_square_2x2(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "labels")
    return rounded(dependence.chi_square(rows, "quality", "toxic"))


def pearson(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dependence.pearson(magnitudes(spark, sf), [*BANDS, "redshift"]))


def spearman(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dependence.spearman(cleaned(spark, sf), FEATURES.columns))


def split_metadata(spark: SparkSession, sf: str) -> DataFrame:
    sided = splits.temporal_holdout(observations(spark, sf, "obj_id", "mjd"), "mjd", "obj_id", 0.2)
    return splits.split_metadata(sided, "mjd", "side", 0.2)


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(resampling.class_weights(load(spark, sf, "labels"), "quality"))


def ks_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The model's six inputs, production rows against training rows."""
    cut = splits.fit_time_cut(observations(spark, sf, "obj_id", "mjd"), "mjd", "obj_id", 0.2)
    rows = cleaning.add_differences(magnitudes(spark, sf, "obj_id", "mjd"), BAND_PAIRS)
    return rounded(drift.ks_drift(rows, cut.is_prod(), FEATURES.columns))


def share_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Class shares of each production batch against the stored ones of the training rows."""
    train_rows, prod = _production(spark, sf, "obj_id", "mjd", "class")
    path = scratch_path(spark, "shares")
    tables.write_table(drift.reference_shares(train_rows, "class"), path)
    batches = splits.batch_slices(prod, "mjd", "obj_id", 2_000).withColumn("batch", F.col("batch").cast("long"))
    return rounded(drift.share_drift(batches, "batch", "class", spark.read.parquet(path)))


def table_info(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_info(magnitudes(spark, sf, "obj_id", "class"))


# --- windows, order, samples, sets


def duplicated_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "lineitem")
    return profile.duplicated_rows(rows, "l_orderkey", ["l_orderkey", "l_partkey", "l_returnflag"])


def average_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Average-tie rank of each distinct redshift."""
    counts = observations(spark, sf, "redshift").groupBy("redshift").agg(F.count("*").alias("n"))
    return average_ranks(counts, [], "redshift", "n")


def top_groups(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.top_values(observations(spark, sf, "field_id"), "field_id", 5))


def latest_row(spark: SparkSession, sf: str) -> DataFrame:
    return profile.first_rows(observations(spark, sf), [F.desc("mjd"), F.desc("obj_id")])


def sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return profile.sample_rows(observations(spark, sf, "obj_id", "class", "r"), "obj_id", 1_000, SEED)


def group_leak_check(spark: SparkSession, sf: str) -> DataFrame:
    sided = splits.group_shuffle_split(observations(spark, sf, "field_id"), "field_id", 0.85, SEED)
    train_rows, test_rows = sided.where(F.col("side") == "train"), sided.where(F.col("side") == "test")
    return splits.shared_groups(train_rows, test_rows, "field_id").agg(F.count("*").alias("n_shared"))


# --- splits


def group_shuffle_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.group_shuffle_split(observations(spark, sf, "obj_id", "field_id"), "field_id", 0.85, SEED)


def strat_group_kfold(spark: SparkSession, sf: str) -> DataFrame:
    return splits.stratified_group_folds(observations(spark, sf, "field_id", "class"), "class", "field_id", 3, SEED)


def temporal_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return splits.temporal_holdout(observations(spark, sf, "obj_id", "mjd"), "mjd", "obj_id", 0.2)


def _production(spark: SparkSession, sf: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    rows = observations(spark, sf, *columns)
    cut = splits.fit_time_cut(observations(spark, sf, "obj_id", "mjd"), "mjd", "obj_id", 0.2)
    return rows.where(~cut.is_prod()), rows.where(cut.is_prod())


def daily_batches(spark: SparkSession, sf: str) -> DataFrame:
    _, prod = _production(spark, sf, "obj_id", "mjd")
    path = scratch_path(spark, "batches")
    tables.write_batches(splits.batch_slices(prod, "mjd", "obj_id", 2_000), path)
    return spark.read.parquet(path).withColumn("batch", F.col("batch").cast("long"))


def time_order(spark: SparkSession, sf: str) -> DataFrame:
    return profile.with_position(observations(spark, sf, "obj_id", "mjd"), ["mjd", "obj_id"])


def append_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Class counts of both sides of the time split in one frame."""
    sided = splits.temporal_holdout(observations(spark, sf, "obj_id", "mjd", "class"), "mjd", "obj_id", 0.2)
    sides = [
        rounded(profile.value_counts(sided.where(F.col("side") == side), "class")).withColumn("side", F.lit(side))
        for side in (splits.TRAIN, splits.PROD)
    ]
    return sides[0].unionByName(sides[1])


def row_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.row_split(observations(spark, sf, "obj_id"), "obj_id", 0.15, SEED)


# --- fitted transforms and resampling


def _imputed(spark: SparkSession, sf: str) -> DataFrame:
    rows = materialize(cleaned(spark, sf).drop("field_id", "class"))  # read by each fit
    return transforms.fit_median_imputer(rows, FEATURES.columns).transform(rows)


def _scaled(spark: SparkSession, sf: str, name: str) -> DataFrame:
    rows = _imputed(spark, sf)
    return rounded(transforms.fit_scaler(rows, FEATURES.scaled, name).transform(rows))


def median_impute(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_imputed(spark, sf))


def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, "standard")


def robust_scale(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, "robust")


def minmax_scale(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, "minmax")


def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    rows = observations(spark, sf, "obj_id", "class")
    return transforms.fit_labels(rows, "class").encode(rows, "class")


def pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(transforms.pca_variance(materialize(magnitudes(spark, sf)), BANDS))


def pca_moments(spark: SparkSession, sf: str) -> DataFrame:
    """Sum of the shares and of their squares, which the correlations alone determine."""
    shares = transforms.pca_variance(materialize(magnitudes(spark, sf)), BANDS)
    share = F.col("variance_share")
    return rounded(shares.agg(F.sum(share).alias("total"), F.sum(share * share).alias("squares")))


def undersample(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.undersample(load(spark, sf, "labels"), "toxic", "doc_id", SEED)


def smote_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Class sizes after interpolating labelled documents by length and number of lines."""
    texts = load(spark, sf, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("chars"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"),
    )
    rows = load(spark, sf, "labels").join(texts, "doc_id")
    balanced = resampling.smote(rows, "toxic", "doc_id", ["chars", "lines"], SEED)
    return balanced.groupBy("toxic").agg(F.count("*").alias("n"), F.count_if("synthetic").alias("n_synthetic"))


def smote_points(spark: SparkSession, sf: str) -> DataFrame:
    """The interpolated observations themselves, on range-scaled features."""
    rows = materialize(cleaned(spark, sf).drop("field_id"))
    rows = transforms.fit_median_imputer(rows, FEATURES.columns).transform(rows)
    rows = transforms.fit_scaler(rows, FEATURES.scaled, "minmax").transform(rows)
    balanced = resampling.smote(rows, "class", "obj_id", FEATURES.columns, SEED)
    return rounded(balanced.where("synthetic").drop("synthetic"))


# --- evaluation


def log_loss(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.log_loss(predictions(spark, sf), CLASSES, "class", "probability"))


def prf_metrics(spark: SparkSession, sf: str) -> DataFrame:
    found = evaluation.label_metrics(predictions(spark, sf), "class", "prediction")
    return rounded(found, 4)


def auc_ovo(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.auc_one_vs_one(predictions(spark, sf), CLASSES, "class", "probability"))


def auc_binary(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.binary_flag(observations(spark, sf, "class", "redshift"), "class", "O", "is_open")
    return rounded(evaluation.auc_binary(rows, "is_open", "redshift"))


def class_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.classification_report(predictions(spark, sf), "class", "prediction"))


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.confusion(predictions(spark, sf), CLASSES, "class", "prediction")


def argmax_label(spark: SparkSession, sf: str) -> DataFrame:
    return predictions(spark, sf).select("obj_id", transforms.argmax(F.col("probability")).alias("code"), "prediction")


# --- models


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Cleaned rows, 85 % of the groups for training, written once for the fits."""
    sided = splits.group_shuffle_split(cleaned(spark, sf), "field_id", 0.85, SEED)
    path = scratch_path(spark, "sides")
    tables.write_table(sided, path)
    sided = spark.read.parquet(path)
    return sided.where(F.col("side") == "train"), sided.where(F.col("side") == "test")


def _metrics(spark: SparkSession, found: dict[str, float]) -> DataFrame:
    return tables.literal_rows(spark, {"metric": "string", "value": "double"}, sorted(found.items()))


def _fit_score(spark: SparkSession, sf: str, model: str, params: dict, features: Features = FEATURES) -> DataFrame:
    train_rows, test_rows = _sides(spark, sf)
    _, found = train_and_evaluate(train_rows, test_rows, features, "class", "obj_id", model, params)
    return _metrics(spark, found)


def rf_fit_score(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_score(spark, sf, "random_forest", QUICK_FOREST)


def gbt_fit_score(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_score(spark, sf, "gradient_boosting", {"n_estimators": 5, "max_depth": 3})


def linear_svc_fit_score(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_score(spark, sf, "linear_svc", {"C": 1.0})


def _vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, Features]:
    """The labelled vectors, one column per dimension, split by row."""
    rows = load(spark, sf, "embeddings")
    size = rows.select(F.max(F.size("embedding"))).first()[0]
    names = tuple(f"x{k}" for k in range(size))
    wide = rows.select("vec_id", "label", *[F.col("embedding")[k].cast("double").alias(n) for k, n in enumerate(names)])
    sided = splits.row_split(wide, "vec_id", 0.2, SEED)
    features = Features(scaled=names)
    return sided.where(F.col("side") == "train"), sided.where(F.col("side") == "test"), features


def logreg_fit_score(spark: SparkSession, sf: str) -> DataFrame:
    train_rows, test_rows, features = _vectors(spark, sf)
    params = {"C": 1.0, "l1_ratio": 0.0}
    _, found = train_and_evaluate(train_rows, test_rows, features, "label", "vec_id", "logreg", params)
    return _metrics(spark, found)


def mlp_fit_score(spark: SparkSession, sf: str) -> DataFrame:
    train_rows, test_rows, features = _vectors(spark, sf)
    params = {"num_layer": 2, "num_perceptron": 32}
    _, found = train_and_evaluate(train_rows, test_rows, features, "label", "vec_id", "dense_nn", params)
    return _metrics(spark, found)


def _forest(spark: SparkSession, sf: str) -> tuple[TrainedModel, DataFrame]:
    train_rows, test_rows = _sides(spark, sf)
    return train(train_rows, FEATURES, "class", "obj_id", "random_forest", QUICK_FOREST), test_rows


def forest_importance(spark: SparkSession, sf: str) -> DataFrame:
    return _forest(spark, sf)[0].classifier.importance()


def column_importance(spark: SparkSession, sf: str) -> DataFrame:
    model, test_rows = _forest(spark, sf)
    return permutation_importance(model, test_rows, "class", "obj_id")


def rule_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Permutation importance of a fixed rule."""
    return rounded(permutation_importance(RULE, observations(spark, sf, "obj_id", "class", "r", "redshift"), "class", "obj_id"))


def rule_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-validation of a fixed rule."""
    rows = observations(spark, sf, "obj_id", "field_id", "class", "r", "redshift")
    inputs = Features(scaled=RULE.classifier.features)
    return cross_validate(rows, inputs, "class", "field_id", "obj_id", "rule", parallel=3, fit=lambda *_: RULE)


def rule_folds_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(mean_over_folds(rule_folds(spark, sf)))


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """What a dataset build logs of its rows, read back from the run table."""
    path = scratch_path(spark, "runs")
    rows = observations(spark, sf, "obj_id", "field_id", "class")
    found = fingerprints.table_fingerprint(rows, rows.columns).first().asDict()
    classes = {f"class_{r[0]}": r[1] for r in profile.value_counts(rows, "class").select("class", "n").collect()}
    artifacts.log_run(spark, path, "build", data={k: int(v) for k, v in found.items()}, metrics=classes)
    artifacts.log_run(spark, path, "again", params={"seed": SEED, "scaler": "robust"})
    return artifacts.read_log(spark, path).drop("ts")


def cross_validation(spark: SparkSession, sf: str) -> DataFrame:
    return cross_validate(
        cleaned(spark, sf), FEATURES, "class", "field_id", "obj_id", "random_forest", QUICK_FOREST, parallel=3
    )


def search(spark: SparkSession, sf: str) -> DataFrame:
    small = {
        "random_forest": {
            "n_estimators": {"type": "int", "low": 5, "high": 20},
            "max_depth": {"type": "int", "low": 2, "high": 6},
            "criterion": {"type": "categorical", "choices": ["gini", "entropy"]},
        },
        "logreg": {
            "C": {"type": "float", "low": 0.001, "high": 100, "log": True},
            "l1_ratio": {"type": "float", "low": 0.0, "high": 1.0},
            "max_iter": {"type": "fixed", "value": 20},
        },
    }
    settings = SearchSettings(models=("random_forest", "logreg"), trials=2, spaces=small)
    rows = cleaned(spark, sf)
    return trial_table(rows, run_search(rows, FEATURES, "class", "field_id", "obj_id", settings))


def experiment(spark: SparkSession, sf: str) -> DataFrame:
    """Search in the shipped space of one model, final fit, reports and log: the metrics of the best trial's model on
    the test side, and the runs that were logged."""
    out = scratch_path(spark, "experiment")
    settings = SearchSettings(models=("logreg",), scalers=("robust",), resamplings=("class_weight",))
    run_experiment(cleaned(spark, sf), FEATURES, GroupSplit("field_id", "class"), "obj_id", settings, out)
    logged = artifacts.read_log(spark, f"{out}/runs").where("kind != 'state'")
    return logged.select(F.when(F.col("run_id").startswith("trial"), F.col("run_id")).otherwise("final").alias("run"), "kind", "key", "value")


# --- scoring


def _predictor(spark: SparkSession, sf: str) -> tuple[Predictor, DataFrame]:
    train_rows, prod = _production(spark, sf)
    rows = cleaning.clean(train_rows, KEYED)
    path = scratch_path(spark, "train")
    tables.write_table(rows, path)
    model = train(spark.read.parquet(path), FEATURES, "class", "obj_id", "random_forest", QUICK_FOREST)
    expected = expected_inputs(COLUMNS, "class", "field_id")
    return Predictor(model, expected, SCORED, "class", "field_id"), prod


def batch_predict(spark: SparkSession, sf: str) -> DataFrame:
    predictor, prod = _predictor(spark, sf)
    return score_table(predictor, prod, scratch_path(spark, "scored"))[0]


def stream_predict(spark: SparkSession, sf: str) -> DataFrame:
    predictor, prod = _predictor(spark, sf)
    source, out = scratch_path(spark, "incoming"), scratch_path(spark, "stream-out")
    tables.write_batches(splits.batch_slices(prod, "mjd", "obj_id", 2_000), source)
    waiting = spark.read.parquet(source)
    stream = streams.read_batches(spark, source, waiting.schema, files_per_trigger=streams.files_at_once(waiting))
    streams.stream_predict(stream, predictor, out, scratch_path(spark, "stream-bad"), F.col("u") != MISSING)
    return streams.read_predictions(spark, out)


def stream_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy per batch of what a stream has scored, beside the running one that it wrote itself."""
    _, prod = _production(spark, sf)
    predictor = Predictor(RULE, expected_inputs(COLUMNS, "class", "field_id"), SCORED, "class", "field_id")
    source, out = scratch_path(spark, "incoming"), scratch_path(spark, "stream-out")
    tables.write_batches(splits.batch_slices(prod, "mjd", "obj_id", 2_000), source)
    waiting = spark.read.parquet(source)
    stream = streams.read_batches(spark, source, waiting.schema, files_per_trigger=streams.files_at_once(waiting))
    streams.stream_predict(stream, predictor, out, scratch_path(spark, "stream-bad"), F.col("u") != MISSING)
    rows = streams.read_predictions(spark, out).withColumn("batch", F.col("batch").cast("long"))
    final = streams.read_accuracy(spark, out).agg(F.max_by(F.struct("n_so_far", "running_accuracy"), "batch_id")).scalar()
    per_batch = evaluation.batch_accuracy(rows, "batch", "class", "prediction").withColumn("final", final)
    return rounded(per_batch.select("batch", "n", "accuracy", "final.n_so_far", "final.running_accuracy"))


def batch_report(spark: SparkSession, sf: str) -> DataFrame:
    predictor, prod = _predictor(spark, sf)
    return rounded(score_table(predictor, prod, scratch_path(spark, "scored"))[1])


def batch_predict_intact(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows carry every input value, none is lost or repeated."""
    return fingerprints.table_fingerprint(batch_predict(spark, sf), list(COLUMNS))


def stream_predict_intact(spark: SparkSession, sf: str) -> DataFrame:
    """The valid rows come out of the stream once each, with every input value."""
    return fingerprints.table_fingerprint(stream_predict(spark, sf), list(COLUMNS))


def replay_draws(spark: SparkSession, sf: str) -> DataFrame:
    _, prod = _production(spark, sf, "obj_id", "mjd", "class")
    return streams.replay(prod, "obj_id", prod.count(), SEED)  # as many draws as rows


def replay_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same draws, counted out by a rate source."""
    _, prod = _production(spark, sf, "obj_id", "mjd", "class")
    draws = prod.count()
    return streams.replay_stream(prod, "obj_id", draws, SEED, scratch_path(spark, "replayed"), rows_per_second=max(1_000, draws // 2))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Observations as text records, in which a missing band is written as n/a."""
    text: Callable[[str], Column] = lambda c: F.when(F.col(c) == MISSING, "n/a").otherwise(F.col(c).cast("string"))
    return observations(spark, sf, "obj_id", *BANDS).select("obj_id", *[text(c).alias(c) for c in BANDS])


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    parsed = streams.parse_records(_records(spark, sf), BANDS)
    return streams.flag_valid(parsed, F.col("bad_fields") == 0)


def batch_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    rows = splits.batch_slices(predictions(spark, sf, "mjd"), "mjd", "obj_id", 2_000)
    return rounded(evaluation.batch_accuracy(rows, "batch", "class", "prediction"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        scan_csv, row_count_contract, min_rows_check, dataset_fingerprint, file_fingerprint,
        sentinel_to_null, color_indices, clean_features, feature_target, filter_sentinel_rows, drop_null_rows,
        replace_value, binary_flag, inference_input, preflight,
        unseen_labels, decode_labels, group_side_join, horizontal_concat,
        nunique, value_counts, value_counts_summary, duplicate_ids, label_consistency, describe, sentinel_counts,
        moments, histogram, kde, kde_common_norm, crosstab, chi_square, chi_square_2x2, pearson, spearman,
        split_metadata, class_weights, ks_drift, share_drift, table_info,
        duplicated_rows, average_rank, top_groups, latest_row, sample_n, group_leak_check,
        group_shuffle_split, strat_group_kfold, temporal_holdout, time_order, daily_batches, append_frames, row_split,
        median_impute, standard_scale, robust_scale, minmax_scale, label_encode, pca_variance,
        undersample, smote_counts, smote_points,
        log_loss, prf_metrics, auc_ovo, auc_binary, class_report, confusion, argmax_label,
        rf_fit_score, gbt_fit_score, logreg_fit_score, linear_svc_fit_score, mlp_fit_score, forest_importance,
        search, experiment, batch_predict, batch_report, batch_predict_intact, stream_predict, stream_predict_intact, stream_accuracy, pca_moments, replay_draws, replay_stream, quarantine, batch_accuracy, rule_importance, rule_folds, rule_folds_mean, run_log,
    )
}
QUERIES["permutation_importance"] = column_importance
QUERIES["cross_validate"] = cross_validation
QUERIES["cross_validate_mean"] = lambda spark, sf: mean_over_folds(cross_validation(spark, sf))
