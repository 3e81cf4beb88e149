"""Drift of features and of class shares against brute force."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tabulon.operators import drift


def gap(a, b):
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in {*a, *b})


def test_largest_gap_with_ties_nulls_and_hot_values(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") % 90 == 4, None).otherwise(F.col("id") % 4 == 0).alias("now"),
        F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 17 == 1, None).when(F.col("id") % 19 == 1, float("nan"))
        .otherwise(F.pmod(F.hash("id"), F.lit(50)) / 3.0).alias("x"),
        (F.col("id") + F.when(F.col("id") % 4 == 0, 400).otherwise(0)).alias("moved"),
        F.when(F.col("id") % 4 != 0, 1.0).alias("one side"), F.lit(None).cast("double").alias("none"), F.lit(2).alias("same"),
    )
    names = ["x", "moved", "one side", "none", "same"]
    got = {r.feature: r for r in drift.ks_drift(rows, F.col("now"), names).collect()}
    assert set(got) == set(names)
    kept = [r for r in rows.collect() if r.now is not None]
    for name in ("x", "moved", "same"):
        old, new = ([r[name] for r in kept if r.now is side and r[name] is not None and not math.isnan(r[name])] for side in (False, True))
        assert (got[name].n_reference, got[name].n_current) == (len(old), len(new))
        assert got[name].statistic == pytest.approx(gap(old, new), abs=1e-12)
    assert got["moved"].drifted and not got["same"].drifted
    assert got["same"].statistic == 0 and got["same"].p_value == 1
    assert (got["one side"].n_current, got["one side"].statistic, got["one side"].drifted) == (0, None, False)
    assert (got["none"].n_reference, got["none"].p_value) == (0, None)
    assert all(r.n_reference == 0 for r in drift.ks_drift(rows.limit(0), F.col("now"), names).collect())


def test_tail_of_the_kolmogorov_distribution(spark):
    # known quantiles, and both forms where they meet
    x = [0.0, 0.2, 0.4999999, 0.5, 0.8275735551899077, 1.3580986393225505, 1.6276236115189503, 9.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").select(drift.kolmogorov_tail(F.col("x"))).collect()]
    assert got[0] == 1 and got[1] == pytest.approx(1) and got[2] == pytest.approx(got[3], abs=1e-6)
    assert got[4:7] == pytest.approx([0.5, 0.05, 0.01], abs=1e-9) and got[7] == pytest.approx(0, abs=1e-12)


def test_no_window_over_one_partition(spark):
    rows = spark.range(100).select((F.col("id") % 2 == 0).alias("now"), F.col("id").cast("double").alias("x"))
    plan = drift.ks_drift(rows, F.col("now"), ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan  # what is left reads the stored walk


def test_shares_of_classes_on_either_side(spark):
    reference = drift.reference_shares(spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",), (None,)], "label string"), "label")
    assert {r["class"]: r.share for r in reference.collect()} == pytest.approx({"a": 0.6, "b": 0.3, "c": 0.1})
    rows = [(1, "a"), (1, "a"), (1, "b"), (1, "new"), (1, None), (2, "a"), (2, "b"), (3, None)]
    got = {(r.batch, r["class"]): r for r in drift.share_drift(spark.createDataFrame(rows, "day long, label string"), "day", "label", reference).collect()}
    assert set(got) == {(1, c) for c in ("a", "b", "c", "new")} | {(2, c) for c in ("a", "b", "c")}
    assert [got[1, c].n for c in ("a", "b", "c", "new")] == [2, 1, 0, 1]
    assert got[1, "new"].reference_share == 0 and got[1, "new"].difference == pytest.approx(0.25)
    assert got[2, "c"].difference == pytest.approx(-0.1)
    assert {r.distance for k, r in got.items() if k[0] == 1} == {got[1, "a"].distance}
    assert got[1, "a"].distance == pytest.approx((0.1 + 0.05 + 0.1 + 0.25) / 2)
    assert drift.share_drift(spark.createDataFrame([], "day long, label string"), "day", "label", reference).collect() == []
