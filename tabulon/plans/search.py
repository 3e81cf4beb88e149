"""Random search, and the experiment that ends in a saved model."""

from __future__ import annotations

import logging
import random
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.config import Features, GroupSplit, SearchSettings
from tabulon.operators.dependence import spearman
from tabulon.operators.evaluation import classification_report, confusion
from tabulon.operators.profile import value_counts
from tabulon.operators.splits import TEST, TRAIN, group_shuffle_split
from tabulon.plans.spaces import SPACES, draw, with_fixed
from tabulon.plans.training import TrainedModel, train_and_evaluate
from tabulon.plans.validation import METRICS, SharedPreparations, fold_table, permutation_importance, validate_folds
from tabulon.session import materialize
from tabulon.sources.artifacts import log_run, save_labels
from tabulon.sources.fingerprints import table_fingerprint
from tabulon.sources.tables import literal_rows, write_record, write_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Trial:
    number: int
    model: str
    scaler: str
    resampling: str
    params: dict[str, Any]
    metrics: dict[str, float]
    state: str = "planned"
    error: Exception | None = None


def plan_trials(settings: SearchSettings) -> list[Trial]:
    """All candidates are drawn beforehand from the seed, so that they can run in any order."""
    rng = random.Random(settings.seed)
    spaces = {**SPACES, **settings.spaces}
    trials = []
    for number in range(settings.trials):
        model = rng.choice(settings.models)
        params = draw(rng, spaces[model])
        trials.append(Trial(number, model, rng.choice(settings.scalers), rng.choice(settings.resamplings), params, {}))
    return trials


def run_search(
    df: DataFrame,
    features: Features,
    target: str,
    group: str,
    key: str,
    settings: SearchSettings,
    log_path: str | None = None,
) -> list[Trial]:
    """Cross-validate every candidate on one fold table; a few run at a time as Spark jobs. Trials of the same scaler and
    resampling share the fitted steps and the stored inputs of each fold."""
    folded = fold_table(df, features, target, group, key, settings.folds, settings.seed)
    shared = SharedPreparations()

    def run(trial: Trial) -> Trial:
        chosen = replace(features, scaler=trial.scaler, resampling=trial.resampling)
        try:
            found = validate_folds(
                folded, chosen, target, key, settings.folds, trial.model, trial.params, settings.seed, parallel=1, shared=shared
            )
        except Exception as e:
            log.exception("trial %d (%s) failed", trial.number, trial.model)
            return replace(trial, state="failed", error=e)
        names = [m for m in METRICS if all(m in fold for fold in found)]
        return replace(trial, state="complete", metrics={m: sum(fold[m] for fold in found) / len(found) for m in names})

    done = []
    with ThreadPoolExecutor(settings.parallel) as pool:
        for trial in pool.map(run, plan_trials(settings)):
            done.append(trial)
            if log_path:
                _log_trial(df, log_path, trial)
    for trial in done:
        if trial.error is not None:
            raise trial.error
    return done


def _log_trial(df: DataFrame, path: str, trial: Trial) -> None:
    # named per model, so that one table can hold the parameters of all of them
    named = {f"{trial.model}_{k}": v for k, v in trial.params.items()}
    steps = {"model_name": trial.model, "scaler": trial.scaler, "resampling": trial.resampling}
    log_run(
        df.sparkSession, path, f"trial-{trial.number}",
        params={**steps, **named}, metrics=trial.metrics, state={"state": trial.state},
    )


def best_trial(trials: list[Trial], settings: SearchSettings) -> Trial:
    sign = 1 if settings.direction == "maximize" else -1
    best = max(trials, key=lambda t: (sign * t.metrics[settings.metric], -t.number))
    space = {**SPACES, **settings.spaces}[best.model]
    return replace(best, params=with_fixed(space, best.params))


def trial_table(df: DataFrame, trials: list[Trial]) -> DataFrame:
    """(trial, model, scaler, resampling, metrics...)."""
    names = {"trial": "int", "model": "string", "scaler": "string", "resampling": "string"}
    rows = [
        (t.number, t.model, t.scaler, t.resampling, *[t.metrics.get(m) for m in METRICS]) for t in trials
    ]
    return literal_rows(df.sparkSession, names | {m: "double" for m in METRICS}, rows)


def run_experiment(
    df: DataFrame,
    features: Features,
    split: GroupSplit,
    key: str,
    settings: SearchSettings,
    out: str,
) -> tuple[TrainedModel, dict[str, float]]:
    """Split, search, final fit on the training side, reports on the test side, saved model.

    Everything is written below ``out``. A failing phase is logged under its name and raised.
    """
    spark, run_id = df.sparkSession, uuid.uuid4().hex
    phase = "split"
    try:
        sided = materialize(group_shuffle_split(df, split.group, split.train_share, split.seed))
        train_rows, test_rows = sided.where(F.col("side") == TRAIN), sided.where(F.col("side") == TEST)

        phase = "search"
        trials = run_search(train_rows, features, split.target, split.group, key, settings, f"{out}/runs")
        best = best_trial(trials, settings)
        chosen = replace(features, scaler=best.scaler, resampling=best.resampling)

        phase = "final fit"
        fitted, metrics = train_and_evaluate(
            train_rows, test_rows, chosen, split.target, key, best.model, best.params, settings.seed
        )

        phase = "reports"
        scored = materialize(fitted.predict_keeping(test_rows))
        labels = fitted.classifier.labels
        write_table(classification_report(scored, split.target, "prediction"), f"{out}/reports/classes", "json")
        write_table(confusion(scored, labels, split.target, "prediction"), f"{out}/reports/confusion", "json")
        write_table(spearman(train_rows, chosen.columns), f"{out}/reports/rank_correlation", "json")
        importance = permutation_importance(fitted, test_rows, split.target, key, seed=settings.seed)
        write_table(importance, f"{out}/reports/importance", "json")
        for name, side in ((TRAIN, train_rows), (TEST, test_rows)):
            write_table(value_counts(side, split.target), f"{out}/reports/target_{name}", "json")

        phase = "log"
        write_record(spark, metrics, f"{out}/metrics")
        steps = {"model_name": best.model, "scaler_strategy": best.scaler, "resampling_strategy": best.resampling}
        write_record(spark, {k: v for k, v in {**steps, **best.params}.items() if v is not None}, f"{out}/best_params")
        save_labels(spark, list(labels), f"{out}/labels")
        fingerprint = table_fingerprint(df, df.columns).first().asDict()
        data = {k: int(v) for k, v in fingerprint.items()}
        log_run(spark, f"{out}/runs", run_id, data=data, metrics=metrics, params={**steps, **best.params})
        fitted.save(spark, f"{out}/model", train_rows)
        return fitted, metrics
    except Exception:
        log.exception("phase %r failed", phase)
        raise
