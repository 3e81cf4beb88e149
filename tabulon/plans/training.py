"""Fit and evaluate: impute, scale, resample, train, score."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from tabulon.config import SEED, Features
from tabulon.operators.evaluation import evaluate
from tabulon.operators.models import Classifier, TrainingInputs, clean_params, fit_on, training_inputs
from tabulon.operators.resampling import RESAMPLERS, resample
from tabulon.operators.splits import check_labels_seen
from tabulon.operators.transforms import SCALERS, LabelCodes, MedianImputer, Scaler, fit_imputer_and_scaler, fit_labels
from tabulon.session import materialize
from tabulon.sources.artifacts import next_version_path, signature, version_path
from tabulon.sources.tables import read_record, write_record


@dataclass(frozen=True)
class TrainedModel:
    """Everything a scorer needs. Resampling is not part of it: scoring keeps every row."""

    imputer: MedianImputer
    scaler: Scaler
    classifier: Classifier

    def prepare(self, df: DataFrame) -> DataFrame:
        return self.scaler.transform(self.imputer.transform(df))

    def predict(self, df: DataFrame) -> DataFrame:
        """``prediction`` and ``probability`` beside the prepared columns, one narrow stage."""
        return self.classifier.predict(self.prepare(df))

    def predict_keeping(self, df: DataFrame) -> DataFrame:
        """The input columns as they came, with the model's outputs added."""
        outputs = ["prediction"] + (["probability"] if self.classifier.has_probabilities else [])
        copies = {f"_in_{c}": c for c in df.columns}
        scored = self.predict(df.withColumns({new: df[c] for new, c in copies.items()}))
        return scored.select(*[scored[new].alias(c) for new, c in copies.items()], *outputs)

    def save(self, spark: SparkSession, root: str, inputs: DataFrame | None = None) -> str:
        """A new version below ``root``; the manifest is written last and marks it complete."""
        path = next_version_path(spark, root)
        self.classifier.save(spark, path)
        steps = {"imputer": asdict(self.imputer), "scaler": asdict(self.scaler)}
        # values go as lists, since JSON objects with data-dependent keys have no fixed schema
        write_record(
            spark,
            {
                "imputed": list(steps["imputer"]["medians"]),
                "medians": list(steps["imputer"]["medians"].values()),
                "dropped": ",".join(self.imputer.dropped),
                "scaler": self.scaler.name,
                "scaled": list(self.scaler.centre),
                "centres": list(self.scaler.centre.values()),
                "scales": list(self.scaler.scale.values()),
            },
            f"{path}/steps",
        )
        described = signature(inputs, self.predict_keeping(inputs)) if inputs is not None else {"inputs": ""}
        write_record(spark, described, f"{path}/manifest")
        return path

    @staticmethod
    def load(spark: SparkSession, root: str, version: str | int = "latest") -> TrainedModel:
        path = version_path(spark, root, version)
        steps = read_record(spark, f"{path}/steps")
        dropped = tuple(c for c in steps["dropped"].split(",") if c)
        return TrainedModel(
            MedianImputer(dict(zip(steps["imputed"], steps["medians"])), dropped),
            Scaler(
                steps["scaler"],
                dict(zip(steps["scaled"], steps["centres"])),
                dict(zip(steps["scaled"], steps["scales"])),
            ),
            Classifier.load(spark, path),
        )


@dataclass(frozen=True)
class Prepared:
    """Fitted steps and stored inputs of one set of training rows, for any number of models."""

    imputer: MedianImputer
    scaler: Scaler
    inputs: TrainingInputs


def prepare_training(
    df: DataFrame, features: Features, target: str, key: str, seed: int = SEED, labels: LabelCodes | None = None
) -> Prepared:
    """Statistics come from ``df`` only; resampled rows reach nothing but the classifier."""
    if features.scaler.lower() not in SCALERS:
        raise ValueError(f"unknown scaler {features.scaler!r}; choose from {sorted(SCALERS)}")
    if features.resampling is not None and features.resampling not in RESAMPLERS:
        raise ValueError(f"unknown resampling {features.resampling!r}; choose from {sorted(RESAMPLERS)}")
    df = df.select(key, target, *features.columns)
    if df.isEmpty():
        raise ValueError("there are no training rows")
    labels = labels or fit_labels(df, target)
    imputer, scaler = fit_imputer_and_scaler(df, features.columns, features.scaled, features.scaler)
    inputs = [c for c in features.columns if c not in imputer.dropped]
    rows = resample(scaler.transform(imputer.transform(df)), features.resampling, target, key, inputs, seed)
    return Prepared(imputer, scaler, training_inputs(rows, inputs, target, labels))


def train_prepared(prepared: Prepared, model: str, params: dict | None = None, seed: int = SEED) -> TrainedModel:
    return TrainedModel(prepared.imputer, prepared.scaler, fit_on(prepared.inputs, model, params, seed))


def train(
    df: DataFrame,
    features: Features,
    target: str,
    key: str,
    model: str,
    params: dict | None = None,
    seed: int = SEED,
    labels: LabelCodes | None = None,
) -> TrainedModel:
    clean_params(model, params)  # a wrong name is an error before any work
    return train_prepared(prepare_training(df, features, target, key, seed, labels), model, params, seed)


def score(model: TrainedModel, df: DataFrame, target: str) -> dict[str, float]:
    """Metrics of the model on labelled rows; the predictions are computed once."""
    classifier = model.classifier
    outputs = [target, "prediction"] + (["probability"] if classifier.has_probabilities else [])
    scored = materialize(model.predict(df).select(*outputs))
    probability = "probability" if classifier.has_probabilities else None
    return evaluate(scored, classifier.labels, target, "prediction", probability)


def train_and_evaluate(
    train_rows: DataFrame,
    test_rows: DataFrame,
    features: Features,
    target: str,
    key: str,
    model: str,
    params: dict | None = None,
    seed: int = SEED,
) -> tuple[TrainedModel, dict[str, float]]:
    if test_rows.isEmpty():
        raise ValueError("there are no test rows")
    check_labels_seen(train_rows, test_rows, target)
    fitted = train(train_rows, features, target, key, model, params, seed)
    return fitted, score(fitted, test_rows, target)
