"""Search spaces of the models."""

from __future__ import annotations

import random
from typing import Any

_BOOSTING_COMMON = {
    "n_estimators": {"type": "int", "low": 50, "high": 800},
    "learning_rate": {"type": "float", "low": 0.001, "high": 0.3, "log": True},
    "max_depth": {"type": "int", "low": 1, "high": 30},
    "subsample": {"type": "float", "low": 0.5, "high": 1.0},
}

# Ranges searched per model, for the parameters Spark's learners have.
SPACES: dict[str, dict[str, dict[str, Any]]] = {
    "random_forest": {
        "n_estimators": {"type": "int", "low": 50, "high": 500},
        "max_depth": {"type": "int", "low": 1, "high": 30},
        "min_samples_leaf": {"type": "int", "low": 1, "high": 10},
        "max_features": {"type": "categorical", "choices": ["sqrt", "log2", None]},
        "criterion": {"type": "categorical", "choices": ["gini", "entropy"]},
        "bootstrap": {"type": "categorical", "choices": [True, False]},
        "class_weight": {"type": "fixed", "value": "balanced"},
    },
    "gradient_boosting": _BOOSTING_COMMON,
    "xgboost": {**_BOOSTING_COMMON, "min_child_weight": {"type": "int", "low": 1, "high": 5}},
    "lightgbm": {**_BOOSTING_COMMON, "min_child_samples": {"type": "int", "low": 5, "high": 100}},
    "catboost": {
        "iterations": {"type": "int", "low": 80, "high": 1000},
        "learning_rate": {"type": "float", "low": 0.001, "high": 0.3, "log": True},
        "depth": {"type": "int", "low": 1, "high": 10},
    },
    "logreg": {
        "C": {"type": "float", "low": 0.001, "high": 100, "log": True},
        "l1_ratio": {"type": "float", "low": 0.0, "high": 1.0},
        "max_iter": {"type": "int", "low": 1000, "high": 5000},
        "class_weight": {"type": "fixed", "value": "balanced"},
    },
    "sgd": {
        "penalty": {"type": "categorical", "choices": ["l2", "l1", "elasticnet"]},
        "alpha": {"type": "float", "low": 1.0e-6, "high": 0.1, "log": True},
        "l1_ratio": {"type": "float", "low": 0.0, "high": 1.0},
        "max_iter": {"type": "fixed", "value": 5000},
    },
    "svc": {
        "C": {"type": "float", "low": 0.001, "high": 100.0, "log": True},
        "tol": {"type": "float", "low": 1.0e-4, "high": 1.0e-2, "log": True},
        "max_iter": {"type": "fixed", "value": 15000},
    },
    "dense_nn": {
        "num_layer": {"type": "int", "low": 2, "high": 5},
        "num_perceptron": {"type": "categorical", "choices": [128, 256, 1024, 2048]},
        "learning_rate": {"type": "float", "low": 0.0005, "high": 0.05, "log": True},
    },
}
SPACES["linear_svc"] = SPACES["svc"]


def draw(rng: random.Random, space: dict[str, dict[str, Any]]) -> dict[str, Any]:
    """One random point of a space."""
    point = {}
    for name, rule in space.items():
        kind = rule["type"]
        if kind == "fixed":
            point[name] = rule["value"]
        elif kind == "categorical":
            point[name] = rng.choice(rule["choices"])
        elif kind == "int":
            point[name] = rng.randint(rule["low"], rule["high"])
        elif kind == "float" and rule.get("log"):
            point[name] = rule["low"] * (rule["high"] / rule["low"]) ** rng.random()
        elif kind == "float":
            point[name] = rng.uniform(rule["low"], rule["high"])
        else:
            raise ValueError(f"{name}: unknown kind of parameter {kind!r}")
    return point


def with_fixed(space: dict[str, dict[str, Any]], params: dict[str, Any]) -> dict[str, Any]:
    """Put the fixed values back; the words none and null stand for no value."""
    fixed = {name: rule["value"] for name, rule in space.items() if rule["type"] == "fixed"}
    empty = ("none", "null")
    return {**params, **{k: None if str(v).lower() in empty else v for k, v in fixed.items()}}


def strip_prefix(params: dict[str, Any], model: str) -> dict[str, Any]:
    """``<model>_depth`` becomes ``depth``; other names stay."""
    return {key.removeprefix(f"{model}_"): value for key, value in params.items()}
