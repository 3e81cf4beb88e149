"""Classifiers trained by Spark ML behind one contract: fit, predict, save, load."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators.cleaning import require_columns
from tabulon.operators.resampling import class_counts
from tabulon.operators.transforms import LabelCodes, argmax
from tabulon.session import materialize
from tabulon.sources.tables import literal_rows, read_record, write_record

_INPUT = ["_features", "_label", "_weight"]
_ONE_VS_REST_THREADS = 4
_DEEPEST = 30  # Spark's trees
# parameters of other engines that do not change what is computed; the SVC never has probabilities
_IGNORED = {"n_jobs", "verbose", "thread_count", "verbose_cb", "probability"}
# weights are always balanced, so only that can be asked for
_BALANCED = {"class_weight", "auto_class_weights"}


def _depth(p: dict, default: int) -> int:
    depth = p.get("max_depth", default)
    if depth > _DEEPEST:
        raise ValueError(f"trees are at most {_DEEPEST} deep, not {depth}")
    return depth


def _random_forest(df: DataFrame, labels: int, total: float, p: dict) -> list:
    subsets = {"sqrt": "sqrt", "log2": "log2", None: "all"}
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="_label", weightCol="_weight",
        numTrees=p.get("n_estimators", 100),
        maxDepth=_depth(p, 10),
        minInstancesPerNode=p.get("min_samples_leaf", 1),
        featureSubsetStrategy=subsets[p.get("max_features", "sqrt")],
        impurity=p.get("criterion", "gini"),
        bootstrap=p.get("bootstrap", True),
        maxMemoryInMB=512,
        seed=p["seed"],
    )
    return [forest.fit(df)]


def _one_vs_rest(df: DataFrame, labels: int, estimator: Estimator, probabilities: bool) -> list:
    """One binary model per class, fitted as concurrent jobs, each with columns of its own.

    Spark's OneVsRest gives no probabilities, and its Python model scores through row UDFs.
    """

    def one(k: int):
        binary = estimator.copy().setRawPredictionCol(f"_raw{k}").setPredictionCol(f"_hit{k}")
        if probabilities:
            binary = binary.setProbabilityCol(f"_p{k}")
        flag = (F.col("_label") == k).cast("double").alias("_is_class", metadata=_nominal(["0", "1"]))
        return binary.fit(df.select("_features", "_weight", flag))

    with ThreadPoolExecutor(_ONE_VS_REST_THREADS) as pool:
        return list(pool.map(one, range(labels)))


def _gradient_boosting(df: DataFrame, labels: int, total: float, p: dict) -> list:
    booster = GBTClassifier(
        featuresCol="_features", labelCol="_is_class", weightCol="_weight",
        maxIter=p.get("n_estimators", 50),
        stepSize=p.get("learning_rate", 0.1),
        maxDepth=_depth(p, 5),
        subsamplingRate=p.get("subsample", 1.0),
        minInstancesPerNode=p.get("min_child", 1),
        maxMemoryInMB=512,
        seed=p["seed"],
    )
    return _one_vs_rest(df, labels, booster, True)


def _logistic(df: DataFrame, labels: int, total: float, p: dict) -> list:
    strength = p["alpha"] if "alpha" in p else 1.0 / (p.get("C", 1.0) * total)
    mix = {"l1": 1.0, "l2": 0.0}.get(p.get("penalty"), p.get("l1_ratio", 0.0))
    model = LogisticRegression(
        featuresCol="_features", labelCol="_label", weightCol="_weight", family="multinomial",
        regParam=strength, elasticNetParam=mix, maxIter=p.get("max_iter", 100), tol=p.get("tol", 1e-4),
        standardization=False,
    )
    return [model.fit(df)]


def _linear_svc(df: DataFrame, labels: int, total: float, p: dict) -> list:
    machine = LinearSVC(
        featuresCol="_features", labelCol="_is_class", weightCol="_weight",
        regParam=1.0 / (p.get("C", 1.0) * total), maxIter=p.get("max_iter", 100), tol=p.get("tol", 1e-3),
        standardization=False,
    )
    return _one_vs_rest(df, labels, machine, False)


def hidden_layers(num_layer: int, num_perceptron: int) -> list[int]:
    """Each hidden layer has half the units of the one before."""
    return [max(1, num_perceptron >> depth) for depth in range(num_layer)]


def _dense_network(df: DataFrame, labels: int, total: float, p: dict) -> list:
    """The network takes no weights, so rows are repeated in proportion to theirs, by expectation.

    Each row rounds by a draw of its own, equal ones too, and the rows are dealt out before they are repeated. Spark's
    default solver has no step size; asking for a learning rate chooses gradient descent.
    """
    share = F.col("_weight") / p["least_weight"]
    df = df.withColumn("_place", F.monotonically_increasing_id())
    chance = F.pmod(F.xxhash64("_place", F.lit(p["seed"])), F.lit(1 << 30)) / float(1 << 30)
    times = (F.floor(share) + (chance < share - F.floor(share)).cast("int")).cast("int")
    dealt = df.select("_features", "_label", "_place", times.alias("_times")).repartition("_place")
    df = materialize(dealt.select("_features", "_label", F.explode(F.sequence(F.lit(1), "_times"))).select("_features", "_label"))
    df = df.withColumn("_label", F.col("_label").alias("_label", metadata=p["nominal"]))
    solver = {"solver": "gd", "stepSize": p["learning_rate"]} if "learning_rate" in p else {}
    model = MultilayerPerceptronClassifier(
        featuresCol="_features", labelCol="_label",
        layers=[p["inputs"], *hidden_layers(p.get("num_layer", 2), p.get("num_perceptron", 128)), labels],
        maxIter=p.get("max_iter", 100), seed=p["seed"], **solver,
    )
    return [model.fit(df)]


@dataclass(frozen=True)
class Family:
    train: Callable[[DataFrame, int, float, dict], list]
    model_class: type
    params: tuple[str, ...]
    renamed: dict[str, str] = field(default_factory=dict)
    probabilities: bool = True
    per_class: bool = False


_GBT = Family(
    _gradient_boosting,
    GBTClassificationModel,
    ("n_estimators", "learning_rate", "max_depth", "subsample", "min_child"),
    {"iterations": "n_estimators", "depth": "max_depth", "min_child_weight": "min_child", "min_child_samples": "min_child"},
    per_class=True,
)
_LOGISTIC = Family(_logistic, LogisticRegressionModel, ("C", "alpha", "penalty", "l1_ratio", "max_iter", "tol"))
_SVC = Family(_linear_svc, LinearSVCModel, ("C", "max_iter", "tol"), probabilities=False, per_class=True)

FAMILIES: dict[str, Family] = {
    "random_forest": Family(
        _random_forest,
        RandomForestClassificationModel,
        ("n_estimators", "max_depth", "min_samples_leaf", "max_features", "criterion", "bootstrap"),
    ),
    "gradient_boosting": _GBT,
    "xgboost": _GBT,
    "lightgbm": _GBT,
    "catboost": _GBT,
    "logreg": _LOGISTIC,
    "sgd": _LOGISTIC,
    "linear_svc": _SVC,
    "svc": _SVC,
    "dense_nn": Family(
        _dense_network,
        MultilayerPerceptronClassificationModel,
        ("num_layer", "num_perceptron", "learning_rate", "max_iter"),
    ),
}


def family(name: str) -> Family:
    if name not in FAMILIES:
        raise ValueError(f"unknown model {name!r}; choose from {sorted(FAMILIES)}")
    return FAMILIES[name]


def _nominal(values: Sequence[str]) -> dict:
    """Class names as column metadata, so that no pass is needed to count the classes."""
    return {"ml_attr": {"type": "nominal", "vals": [str(v) for v in values], "name": "label"}}


@dataclass(frozen=True)
class Classifier:
    name: str
    labels: tuple
    features: tuple[str, ...]
    models: tuple

    @property
    def has_probabilities(self) -> bool:
        return family(self.name).probabilities

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` (label) and, if the model has them, ``probability`` (array)."""
        require_columns(df, self.features)
        scored = df.withColumn("_features", array_to_vector(F.array(*[F.col(c).cast("double") for c in self.features])))
        codes = LabelCodes(self.labels)
        if family(self.name).per_class:
            scored, spent = self._predict_per_class(scored)
        else:
            (model,) = self.models
            names = {model.predictionCol: "_code", model.rawPredictionCol: "_raw", model.probabilityCol: "_probability"}
            scored = model.copy(names).transform(scored)
            scored = scored.withColumn("probability", vector_to_array("_probability"))
            spent = ["_raw", "_probability"]
        scored = scored.withColumn("prediction", codes.decoded(F.col("_code")))
        return scored.drop("_features", "_code", *spent)

    def _predict_per_class(self, scored: DataFrame) -> tuple[DataFrame, list[str]]:
        """The class of the largest score; probabilities are the scores brought to sum 1."""
        places = range(len(self.models))
        for model in self.models:
            scored = model.transform(scored)
        source = "_p" if self.has_probabilities else "_raw"
        scores = F.array(*[F.get(vector_to_array(f"{source}{k}"), F.lit(1)) for k in places])
        scored = scored.withColumn("_scores", scores).withColumn("_code", argmax(F.col("_scores")))
        spent = ["_scores", *[f"_raw{k}" for k in places], *[f"_hit{k}" for k in places]]
        if self.has_probabilities:
            total = F.aggregate("_scores", F.lit(0.0), lambda a, x: a + x)
            scored = scored.withColumn("probability", F.transform("_scores", lambda x: x / total))
            spent += [f"_p{k}" for k in places]
        return scored, spent

    def importance(self) -> DataFrame:
        """(feature, importance) of a forest, largest first."""
        if not all(hasattr(m, "featureImportances") for m in self.models) or len(self.models) != 1:
            raise ValueError(f"{self.name} has no feature importances of its own; use permutation importance")
        (model,) = self.models
        weights = model.featureImportances.toArray()
        rows = sorted(zip(self.features, (float(w) for w in weights)), key=lambda fw: (-fw[1], fw[0]))
        return literal_rows(SparkSession.getActiveSession(), {"feature": "string", "importance": "double"}, rows)

    def save(self, spark: SparkSession, path: str) -> None:
        for k, model in enumerate(self.models):
            model.write().overwrite().save(f"{path}/stage-{k}")
        write_record(
            spark,
            {"name": self.name, "classes": list(self.labels), "features": list(self.features), "stages": len(self.models)},
            f"{path}/classifier",
        )

    @staticmethod
    def load(spark: SparkSession, path: str) -> Classifier:
        saved = read_record(spark, f"{path}/classifier")
        kind = family(saved["name"]).model_class
        models = tuple(kind.load(f"{path}/stage-{k}") for k in range(saved["stages"]))
        return Classifier(saved["name"], tuple(saved["classes"]), tuple(saved["features"]), models)


def clean_params(name: str, params: dict | None) -> dict:
    """Known parameters under their common names; a misspelt one is an error."""
    chosen = family(name)
    result = {}
    for key, value in (params or {}).items():
        key = chosen.renamed.get(key, key)
        if key in chosen.params:
            result[key] = value
        elif key == "random_state":
            result["seed"] = value
        elif key in _BALANCED:
            if str(value).lower() != "balanced":
                raise ValueError(f"classes are weighted evenly; {key}={value!r} is not supported")
        elif key not in _IGNORED:
            raise ValueError(f"{name} has no parameter {key!r}; known are {sorted(chosen.params)}")
    return result


@dataclass(frozen=True)
class TrainingInputs:
    """Stored features, label codes and weights, which any model may be fitted on."""

    rows: DataFrame
    features: tuple[str, ...]
    labels: tuple
    total: float
    least_weight: float


def training_inputs(df: DataFrame, features: Sequence[str], target: str, labels: LabelCodes) -> TrainingInputs:
    """Rows with balanced class weights n / (k · n_class)."""
    counts = class_counts(df, target)
    total = sum(counts.values())
    if len(counts) < 2:
        raise ValueError("training needs at least 2 classes")
    weights = [total / (len(counts) * counts[c]) if c in counts else 0.0 for c in labels.labels]
    code = F.col("_code").cast("double").alias("_label", metadata=_nominal(labels.labels))
    inputs = labels.encode(df, target, "_code").select(
        array_to_vector(F.array(*[F.col(c).cast("double") for c in features])).alias("_features"),
        code,
        F.get(F.array(*[F.lit(w) for w in weights]), F.col("_code")).alias("_weight"),
    )
    inputs = materialize(inputs)  # read once per iteration by the solvers
    inputs = inputs.withColumn("_label", F.col("_label").alias("_label", metadata=_nominal(labels.labels)))
    return TrainingInputs(inputs, tuple(features), tuple(labels.labels), float(total), min(w for w in weights if w > 0))


def fit_on(inputs: TrainingInputs, name: str, params: dict | None, seed: int) -> Classifier:
    """The same seed gives the same model on the same layout of the rows over partitions, which is
    what Spark ML seeds its sampling by."""
    chosen, known = family(name), clean_params(name, params)
    given = {"seed": seed, **known, "inputs": len(inputs.features), "nominal": _nominal(inputs.labels)}
    given["least_weight"] = inputs.least_weight
    models = chosen.train(inputs.rows, len(inputs.labels), inputs.total, given)
    return Classifier(name, inputs.labels, inputs.features, tuple(models))


def fit_classifier(
    df: DataFrame, name: str, features: Sequence[str], target: str, labels: LabelCodes, params: dict | None, seed: int
) -> Classifier:
    """Train on balanced class weights; see ``training_inputs`` and ``fit_on``."""
    family(name), clean_params(name, params)  # a wrong name is an error before any work
    return fit_on(training_inputs(df, features, target, labels), name, params, seed)
