"""Settings of the jobs. The values below are the defaults of the observation data set."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Names and types of the source table, in file order.
SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("obj_ID", T.DoubleType()),
        T.StructField("alpha", T.DoubleType()),
        T.StructField("delta", T.DoubleType()),
        T.StructField("u", T.DoubleType()),
        T.StructField("g", T.DoubleType()),
        T.StructField("r", T.DoubleType()),
        T.StructField("i", T.DoubleType()),
        T.StructField("z", T.DoubleType()),
        T.StructField("run_ID", T.LongType()),
        T.StructField("rerun_ID", T.LongType()),
        T.StructField("cam_col", T.LongType()),
        T.StructField("field_ID", T.LongType()),
        T.StructField("spec_obj_ID", T.DoubleType()),
        T.StructField("class", T.StringType()),
        T.StructField("redshift", T.DoubleType()),
        T.StructField("plate", T.LongType()),
        T.StructField("MJD", T.LongType()),
        T.StructField("fiber_ID", T.LongType()),
    ]
)

# Expected row count, missing-value marker, band pairs and dropped columns.
SOURCE_ROWS = 100_000
SENTINELS = (-9999,)
BAND_PAIRS = (("u", "g"), ("g", "r"), ("r", "i"), ("i", "z"))
DROPPED = (
    "obj_ID", "alpha", "delta", "u", "g", "i", "z", "run_ID", "rerun_ID",
    "cam_col", "spec_obj_ID", "plate", "MJD", "fiber_ID",
)
SEED = 42


@dataclass(frozen=True)
class Contract:
    """What a source table must look like."""

    columns: tuple[str, ...] = tuple(SOURCE_SCHEMA.fieldNames())
    rows: int = SOURCE_ROWS


@dataclass(frozen=True)
class Holdout:
    """Newest share of the rows that is kept apart and sliced into daily batches."""

    time_col: str = "MJD"
    key: str = "obj_ID"
    fraction: float = 0.2
    batch_size: int = 2000


@dataclass(frozen=True)
class GroupSplit:
    """Share of the groups that goes to training."""

    group: str = "field_ID"
    target: str = "class"
    train_share: float = 0.85
    seed: int = SEED


@dataclass(frozen=True)
class Cleaning:
    """Sentinels to null, difference columns, dropped columns, in this order."""

    sentinels: tuple[float, ...] = SENTINELS
    pairs: tuple[tuple[str, str], ...] = BAND_PAIRS
    drop: tuple[str, ...] = DROPPED


@dataclass(frozen=True)
class Features:
    """Model inputs and the columns that are scaled."""

    scaled: tuple[str, ...] = ("r", "redshift", "u_g", "g_r", "r_i", "i_z")
    passed: tuple[str, ...] = ()
    scaler: str = "standard"
    resampling: str = "class_weight"

    @property
    def columns(self) -> tuple[str, ...]:
        return self.scaled + self.passed


@dataclass(frozen=True)
class SearchSettings:
    """Random search over models, their parameters, scaler and resampling."""

    models: tuple[str, ...] = (
        "dense_nn", "random_forest", "xgboost", "lightgbm", "catboost", "svc", "sgd", "logreg",
    )
    trials: int = 1
    folds: int = 3
    metric: str = "f1"
    direction: str = "maximize"
    seed: int = SEED
    scalers: tuple[str, ...] = ("standard", "robust", "minmax")
    resamplings: tuple[str, ...] = ("class_weight", "smote", "undersampling")
    parallel: int = 2
    spaces: dict = field(default_factory=dict)
