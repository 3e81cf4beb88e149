"""Order statistics, ranks, hash cutoffs, joins and neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tabulon.functions import hashing, joins, neighbours, quantiles, ranks


def skewed(spark, n=3000):
    """A third of the values are one number; the rest spread over many magnitudes, some null."""
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7.0)
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.exp(F.pmod(F.hash("id"), F.lit(1000)) / 50.0))
        .alias("x"),
        F.pmod(F.hash("id", F.lit(1)), F.lit(40)).cast("long").alias("y"),
    )


@pytest.mark.parametrize("final_rows", [5, 100, 10_000])
def test_order_statistics_by_narrowing(spark, final_rows):
    df = skewed(spark).cache()
    xs = sorted(r.x for r in df.collect() if r.x is not None)
    ys = sorted(r.y for r in df.collect())
    wanted = {"x": [0, 10, len(xs) // 2, len(xs) - 1], "y": [0, 1500, 2999]}
    found = quantiles.order_statistics(df, wanted, final_rows=final_rows)
    assert found["x"] == {k: xs[k] for k in wanted["x"]}
    assert found["y"] == {k: ys[k] for k in wanted["y"]}
    with pytest.raises(ValueError):
        quantiles.order_statistics(df, {"x": [len(xs)]})


def test_order_statistics_beyond_double_precision(spark):
    base = 1_237_650_000_000_000_000
    df = spark.range(1000).select((F.lit(base) + F.col("id")).alias("k"))
    assert quantiles.order_statistics(df, {"k": [0, 501, 999]}, final_rows=10)["k"] == {
        0: base, 501: base + 501, 999: base + 999,
    }


def test_quantiles_interpolate_like_numpy(spark, monkeypatch):
    df = skewed(spark)
    xs = np.array([r.x for r in df.collect() if r.x is not None])
    for limit in (20, 200_000):
        monkeypatch.setattr(quantiles, "FINAL_ROWS", limit)
        found = quantiles.exact_quantiles(df, ["x"], [0.25, 0.5, 0.9])["x"]
        assert found == pytest.approx(list(np.quantile(xs, [0.25, 0.5, 0.9])))
    empty = spark.range(3).select(F.lit(None).cast("double").alias("e"))
    assert quantiles.exact_quantiles(empty, ["e"], [0.5]) == {"e": [None]}


def test_median_is_mean_of_the_middle_values(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 9.0)], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [0.5])["x"] == [3.0]


def test_global_position_with_a_hot_value(spark):
    df = skewed(spark, 500)
    placed = ranks.global_position(df, ["y", "id"]).orderBy("position").collect()
    assert [r.position for r in placed] == list(range(500))
    assert [(r.y, r.id) for r in placed] == sorted((r.y, r.id) for r in df.collect())
    down = ranks.global_position(df, [F.col("id").desc()]).orderBy("position").collect()
    assert [r.id for r in down] == list(range(499, -1, -1))


def test_running_totals_and_average_ranks(spark):
    counts = skewed(spark).where("x is not null").groupBy((F.col("id") % 2).alias("g"), "x").agg(F.count("*").alias("n"))
    got = {(r.g, r.x): r.n_before for r in ranks.running_totals(counts, ["g"], "x", ["n"]).collect()}
    want, before = {}, {}
    for g, x, n in rows(counts):
        want[g, x] = before.get(g, 0)
        before[g] = before.get(g, 0) + n
    assert got == want
    table = spark.createDataFrame([(1.0, 2), (3.0, 1), (5.0, 3)], "x double, n long")
    assert rows(ranks.average_ranks(table, [], "x", "n"), "x", "avg_rank") == [(1.0, 1.5), (3.0, 3.0), (5.0, 5.0)]


@pytest.mark.parametrize("few", [0, 100_000])
def test_hash_cutoffs_take_exactly_n(spark, monkeypatch, few):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"), hashing.order_hash(1, "id").alias("h"))
    monkeypatch.setattr(hashing, "FEW_GROUPS", few)
    for final in (2, 4096):
        monkeypatch.setattr(hashing, "FINAL_HASHES", final)
        for n in (0, 1, 1234, 5000, 6000):
            kept = df.where(F.col("h") <= hashing.hash_cutoff(df, "h", n))
            assert kept.count() == min(n, 5000)
            if n == 1234:
                assert [r.id for r in kept.orderBy("h").collect()] == [r.id for r in df.orderBy("h").limit(n).collect()]
        take = F.when(F.col("g") == 0, 5).when(F.col("g") == 1, 700).otherwise(0)
        cuts, groups = hashing.hash_cutoffs(df, "h", "g", take)
        assert groups == 3
        kept = df.join(cuts, "g").where("h <= cutoff")
        assert rows(kept.groupBy("g").count()) == [(0, 5), (1, 700)]
        assert dict(rows(cuts))[2] == ""


def test_hash_cutoffs_refuse_a_repeated_key(spark):
    same = spark.range(100).select(hashing.order_hash(1, F.lit("k")).alias("h"))
    with pytest.raises(Exception, match="unique"):
        hashing.hash_cutoff(same, "h", 10)


@pytest.mark.parametrize("limit", [0, 100_000])
def test_attach_small_and_large_lookups_agree(spark, limit):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1700).alias("k"))
    lookup = left.where("k <> 5").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    lookup = lookup.withColumn("gap", F.when(F.col("k") % 2 == 0, F.col("k")))
    want = rows(left.join(lookup.drop("n"), ["k"], "left").select("id", "k", "top", "gap").fillna(-1))
    for size_col in ("n", None):
        got = joins.attach(left, lookup if size_col else lookup.drop("n"), ["k"], size_col, limit=limit)
        assert rows(got.select("id", "k", "top", "gap").fillna(-1)) == want


@pytest.mark.parametrize("cell_points, query_chunk", [(2000, 20_000), (20, 3)])
def test_nearest_neighbours_equal_brute_force(spark, monkeypatch, cell_points, query_chunk):
    monkeypatch.setattr(neighbours, "CELL_POINTS", cell_points)
    monkeypatch.setattr(neighbours, "QUERY_CHUNK", query_chunk)
    rng = np.random.default_rng(0)
    points = np.round(rng.normal(size=(400, 3)) * [1, 10, 0.1], 1)
    points[:130] = points[0]  # a third are copies
    points[130] = points[1] + 50  # far away
    labels = ["a" if k % 4 else "b" for k in range(400)]
    df = spark.createDataFrame([(lab, *map(float, p)) for lab, p in zip(labels, points)], "c string, x double, y double, z double")
    got = neighbours.nearest_neighbours(df, df, "c", ["x", "y", "z"], 5).collect()
    by_class = {c: [tuple(map(float, p)) for lab, p in zip(labels, points) if lab == c] for c in "ab"}
    assert len(got) == sum(len(set(v)) for v in by_class.values())
    for r in got:
        q = (r.x, r.y, r.z)
        others = list(by_class[r.c])
        others.remove(q)
        ordered = sorted(others, key=lambda p: (np.sqrt(sum((a - b) ** 2 for a, b in zip(q, p))), p))[:5]
        assert [tuple(v) for v in r.neighbours] == ordered


def test_cells_divide_where_most_points_have_the_largest_value(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_POINTS", 50)
    draw = np.random.default_rng(0)
    points = np.column_stack([draw.random(4_000), (draw.random(4_000) < 0.6) * 9.0])
    df = spark.createDataFrame(points.tolist(), "x double, y double").withColumn("c", F.lit(1))
    placed, levels = neighbours._own_cells(df, "c", ["x", "y"])
    sizes = [r[0] for r in placed.groupBy("cell").count().select("count").collect()]
    assert sum(sizes) == 4_000 and max(sizes) <= 50 and len(sizes) < 800 and len(levels) <= 3
    same = spark.createDataFrame([(0.0, float(k == 0)) for k in range(200)], "x double, y double").withColumn("c", F.lit(1))
    assert neighbours._cuts(same.withColumn("cell", F.lit("")), "c", ["x", "y"])[0].first()["at"] == [0.0]


def test_neighbours_in_a_thousand_classes(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_POINTS", 4)
    monkeypatch.setattr(neighbours, "CHILDREN", 3)
    draw = np.random.default_rng(1)
    points = np.round(draw.random((9_000, 2)) * 30, 1)
    df = spark.createDataFrame([(k % 1000, *map(float, p)) for k, p in enumerate(points)], "c int, x double, y double")
    asked = df.where("c % 37 = 0")  # the cells of all classes are cut
    got = {(r.c, r.x, r.y): r.neighbours for r in neighbours.nearest_neighbours(df, asked, "c", ["x", "y"], 2).collect()}
    assert len(got) == len({(k % 1000, *p) for k, p in enumerate(points.tolist()) if k % 1000 % 37 == 0})
    for c in range(0, 1000, 37):
        own = [tuple(map(float, p)) for p in points[c::1000]]
        for q in own:
            rest = list(own)
            rest.remove(q)
            near = sorted(rest, key=lambda p: (np.hypot(p[0] - q[0], p[1] - q[1]), p))[:2]
            assert [tuple(v) for v in got[c, *q]] == near


def test_neighbours_in_very_many_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_POINTS", 10)
    df = spark.range(100_000).select((F.rand(1) * 100).alias("x"), (F.randn(2) * 5).alias("y"), F.lit("a").alias("c"))
    points = df.toPandas()
    df = spark.createDataFrame(points)
    asked = points.iloc[::2500]
    got = neighbours.nearest_neighbours(df, spark.createDataFrame(asked), "c", ["x", "y"], 2).collect()
    assert len(got) == len(asked)
    at = points[["x", "y"]].to_numpy()
    for r in got:
        far = np.hypot(at[:, 0] - r.x, at[:, 1] - r.y)
        assert [tuple(v) for v in r.neighbours] == [tuple(at[k]) for k in np.argsort(far)[1:3]]


def test_null_keys_are_spread(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") < 100, F.col("id") % 7).alias("k"))
    lookup = df.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    got = rows(joins.attach(df, lookup, ["k"], size_col="n", limit=0))
    want = {r.k: r.m for r in lookup.collect()}
    assert got == sorted(((i, None, None) if k is None else (i, k, want[k]) for i, k in df.collect()), key=lambda r: r[0])


def test_quantiles_of_filled_columns(spark):
    import random

    from tabulon.functions.quantiles import exact_quantiles, filled_quantiles

    draw = random.Random(5)
    for n, gaps in ((9, 0), (9, 4), (10, 3), (1, 6), (2, 5), (40, 41)):
        values = [float(draw.randrange(6)) if n > 9 else draw.random() for _ in range(n)]
        rows = [(x, None) for x in [*values, *[None] * gaps]]
        df = spark.createDataFrame(rows, "x double, e double")
        medians, found = filled_quantiles(df, ["x", "e"], [0.25, 0.5, 0.75])
        assert medians == {"x": exact_quantiles(df, ["x"], [0.5])["x"][0], "e": None}
        filled = df.fillna({"x": medians["x"]})
        assert found == {"x": exact_quantiles(filled, ["x"], [0.25, 0.5, 0.75])["x"], "e": None}
