"""Behaviour on small frames."""

from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tabulon.config import Cleaning
from tabulon.functions import hashing
from tabulon.operators import cleaning, density, dependence, evaluation, models, profile, resampling, splits, transforms


# --- cleaning


def test_clean_in_order(spark):
    df = spark.createDataFrame([(1, -9999.0, 2.0, "-9999"), (-9999, 5.0, 3.0, "s")], "k long, u double, g double, t string")
    got = cleaning.clean(df, Cleaning((-9999,), (("u", "g"),), ("g",)))
    assert got.columns == ["k", "u", "t", "u_g"]
    assert [tuple(r) for r in got.orderBy("t").collect()] == [(1, None, "-9999", None), (None, 5.0, "s", 2.0)]


def test_missing_columns_are_errors(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        cleaning.drop_columns(df, ["nope"])
    with pytest.raises(ValueError):
        cleaning.add_differences(df, [("id", "nope")])
    with pytest.raises(ValueError):
        cleaning.drop_null_rows(df, ["nope"])


def test_features_and_target(spark):
    df = spark.createDataFrame([(1, 2, "A", 9), (3, 4, "B", 9)], "f1 long, f2 long, class string, field_ID long")
    got = cleaning.features_and_target(df, "class", "field_ID")
    assert got.columns == ["f1", "f2", "label", "group_id"]
    with pytest.raises(ValueError):
        cleaning.features_and_target(df.where("f1 > 5"), "class", "field_ID")
    with pytest.raises(ValueError):
        cleaning.features_and_target(df.select("class", "field_ID"), "class", "field_ID")


def test_inference_input(spark):
    df = spark.createDataFrame([(1, 2, "A")], "f1 long, field_ID long, class string")
    assert cleaning.inference_input(df, ["f1"], "class", "field_ID").columns == ["f1"]
    with pytest.raises(ValueError):
        cleaning.inference_input(df, ["f1", "f2"], "class", "field_ID")


def test_preflight_guards(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "y string, g long")
    cleaning.check_preflight(df, "y", "g", 3)
    for bad, folds in ((df, 1), (df, 4), (df.where("y = 'A'"), 2), (df.where("g > 9"), 2), (df.where("g < 1"), 2)):
        with pytest.raises(ValueError):
            cleaning.check_preflight(bad, "y", "g", folds)
    with pytest.raises(ValueError):
        cleaning.check_preflight(df, "nope", "g", 2)


def test_replace_everywhere_but_in_text(spark):
    df = spark.createDataFrame([("22", 22, 22.0), ("a", 1, 2.0)], "s string, n int, d double")
    assert rows(cleaning.replace_value(df, 22, 1)) == [("22", 1, 1.0), ("a", 1, 2.0)]


# --- profile


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaac"], "v string")
    assert [tuple(r) for r in profile.top_values(df, "v", 2).collect()] == [("a", 2, 0.4), ("b", 2, 0.4)]


def test_sorted_rows_and_last_row(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "t long, v string")
    assert [r.v for r in profile.ordered(df, F.asc("t")).collect()] == ["a", "b", "c"]
    assert [r.v for r in profile.first_rows(df, [F.desc("t")]).collect()] == ["c"]


def test_sample_is_exact_and_seeded(spark):
    df = spark.range(1000)
    first = rows(profile.sample_rows(df, "id", 100, 42))
    assert len(first) == 100 and first == rows(profile.sample_rows(df.repartition(7), "id", 100, 42))
    assert first != rows(profile.sample_rows(df, "id", 100, 43))
    assert profile.sample_rows(df, "id", 5000, 42).count() == 1000
    assert profile.sample_rows(df, "id", 0, 42).count() == 0


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 9, 10)], "x double")
    got = density.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r.n for r in got] == [2, 1, 0, 0, 2] and got[-1].bin_high == 10
    flat = density.histogram(df.select(F.lit(3.0).alias("x")), "x", 2).orderBy("bin").collect()
    assert [r.n for r in flat] == [5, 0]


def test_density_integrates_to_the_share(spark):
    df = spark.range(200).select(F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("c"), F.sqrt("id").alias("x"))
    for common, want in ((False, {"a": 1.0, "b": 1.0}), (True, {"a": 0.25, "b": 0.75})):
        curve = density.kde(df, "x", "c", common).orderBy("c", "grid_point").collect()
        for c in "ab":
            part = [r for r in curve if r.c == c]
            area = sum((p.x - q.x) * (p.density + q.density) / 2 for q, p in zip(part, part[1:]))
            assert area == pytest.approx(want[c], abs=0.01)


def test_binned_density_equals_the_exact_one(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 3).alias("c"),
        F.when(F.col("id") % 5 == 0, 1.25).when(F.col("id") % 41 == 1, None).otherwise(F.randn(3) * F.exp(F.col("id") % 3)).alias("x"),
    )
    rows = rows.unionByName(spark.createDataFrame([(7, 2.0), (7, 2.0), (8, 1.0), (None, 1.0)], "c long, x double"))
    for common in (False, True):
        exact = {(r.c, r.grid_point): r for r in density.kde(rows, "x", "c", common, exact=True).collect()}
        binned = density.kde(rows, "x", "c", common).collect()
        assert len(binned) == len(exact) == 600  # one value alone has no curve
        top = max(r.density for r in exact.values())
        assert max(abs(r.density - exact[r.c, r.grid_point].density) for r in binned) < 1e-11 * top
        few = density.kde(rows, "x", "c", common, bins=60).collect()
        assert max(abs(r.density - exact[r.c, r.grid_point].density) for r in few) < 1e-3 * top
    plan = density.kde(rows, "x", "c")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("_bin")  # bins meet the grid, not values


def test_yates_correction_only_for_two_by_two(spark):
    df = spark.createDataFrame([("a", "x")] * 12 + [("a", "y")] * 5 + [("b", "x")] * 7 + [("b", "y")] * 9, "p string, q string")
    got = dependence.chi_square_test(df, "p", "q")
    cells = {("a", "x"): 12, ("a", "y"): 5, ("b", "x"): 7, ("b", "y"): 9}
    r, c = {"a": 17, "b": 16}, {"x": 19, "y": 14}
    want = sum((abs(o - r[a] * c[b] / 33) - 0.5) ** 2 / (r[a] * c[b] / 33) for (a, b), o in cells.items())
    assert got["statistic"] == pytest.approx(want) and got["dof"] == 1
    assert got["p_value"] == pytest.approx(math.erfc(math.sqrt(want / 2)))


def test_chi_square_matches_the_library_test(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    df = spark.range(3000).select(
        F.pmod(F.hash("id"), F.lit(12)).cast("double").alias("a"), F.pmod(F.hash("id", F.lit(3)), F.lit(3)).cast("double").alias("b")
    )
    got = dependence.chi_square_test(df, "a", "b")
    want = ChiSquareTest.test(VectorAssembler(inputCols=["a"], outputCol="v").transform(df), "v", "b", flatten=True).first()
    assert got["statistic"] == pytest.approx(want.statistic) and got["dof"] == want.degreesOfFreedom
    assert got["p_value"] == pytest.approx(want.pValue, abs=1e-9)


def test_spearman_with_copies_ties_and_gaps(spark):
    import pandas as pd

    pdf = pd.DataFrame({"a": [1.0, 2, 2, None, 5, 6, 1, 1] * 30, "b": [2.0, 1, 4, 4, None, 9, 2, 2] * 30, "c": [float(k % 7) for k in range(240)]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "a double, b double, c double")
    got = {(r.column_a, r.column_b): r.correlation for r in dependence.spearman(df, ["a", "b", "c"]).collect()}
    for (a, b), value in got.items():
        pair = pdf[[a, b]].dropna().rank()
        assert value == pytest.approx(pair[a].corr(pair[b]), abs=1e-12)


# --- splits


@pytest.fixture()
def timed(spark):
    return spark.createDataFrame(
        [(1, 5, 0, 10.1), (2, 6, 1, 10.3), (3, 7, 1, 10.2), (4, 8, 9, 10.0)], "id long, f long, class long, MJD double"
    )


def test_temporal_holdout(timed):
    sided = splits.temporal_holdout(timed, "MJD", "id", 0.5)
    train, prod = sided.where("side = 'train'"), sided.where("side = 'prod'")
    assert [r.id for r in train.orderBy("MJD").collect()] == [4, 1] and [r.id for r in prod.orderBy("MJD").collect()] == [3, 2]
    meta = splits.split_metadata(sided, "MJD", "side", 0.5).first().asDict()
    assert meta == {
        "split_prod_ratio": 0.5, "n_train": 2, "n_prod": 2, "train_mjd_min": 10, "train_mjd_max": 10,
        "prod_mjd_min": 10, "prod_mjd_max": 10, "split_method": "time_based_MJD",
    }


@pytest.mark.parametrize("column, fraction", [("MJD", 0.0), ("MJD", 1.1), ("MJD", 0.0001), ("nope", 0.5)])
def test_temporal_holdout_refuses(timed, column, fraction):
    with pytest.raises(ValueError):
        splits.temporal_holdout(timed, column, "id", fraction)


@pytest.mark.parametrize("key", ["id", "name"])
def test_temporal_holdout_inside_one_hot_time(spark, key):
    df = spark.range(100).select("id", F.format_string("k%03d", "id").alias("name"), F.when(F.col("id") < 90, 7).otherwise(8).alias("t"))
    for fraction in (0.1, 0.25, 0.99):
        sided = splits.temporal_holdout(df, "t", key, fraction)
        assert [r.id for r in sided.where("side = 'prod'").orderBy("id").collect()] == list(range(100 - int(100 * fraction), 100))


def test_group_split_by_groups(spark):
    df = spark.range(10).select("id", (F.floor(F.col("id") / 2) + 1).alias("g"))
    sided = splits.group_shuffle_split(df, "g", 0.6, 42)
    train, test = sided.where("side = 'train'"), sided.where("side = 'test'")
    assert (train.count(), test.count()) == (6, 4)
    assert splits.shared_groups(train, test, "g").count() == 0
    assert rows(sided) == rows(splits.group_shuffle_split(df.repartition(5), "g", 0.6, 42))
    for share in (0.0, 1.0, 0.05):
        with pytest.raises(ValueError):
            splits.group_shuffle_split(df, "g", share, 42)


def test_folds_keep_groups_whole_and_classes_even(spark):
    df = spark.range(6000).select("id", F.pmod(F.hash("id"), F.lit(300)).alias("g"), F.pmod(F.hash("id", F.lit(2)), F.lit(10)).alias("d"))
    df = df.withColumn("y", F.when(F.col("d") < 6, "A").when(F.col("d") < 8, "B").otherwise("C"))
    folded = splits.with_folds(df, "y", "g", 3, 42)
    assert folded.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    shares = {}
    for r in folded.groupBy("fold", "y").count().collect():
        shares.setdefault(r.y, []).append(r["count"])
    assert all(len(n) == 3 and max(n) - min(n) < 0.1 * sum(n) for n in shares.values())


def test_every_fold_gets_a_group(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "y string, g long")
    assert sorted(r.fold for r in splits.stratified_group_folds(df, "y", "g", 3, 1).collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        splits.stratified_group_folds(df, "y", "g", 1, 1)


def test_row_split_and_batches(spark):
    df = spark.range(100).withColumn("t", F.col("id") % 10)
    assert rows(splits.row_split(df, "id", 0.15, 1).groupBy("side").count()) == [("test", 15), ("train", 85)]
    sliced = splits.batch_slices(df, "t", "id", 30)
    assert rows(sliced.groupBy("batch").count()) == [(1, 30), (2, 30), (3, 30), (4, 10)]
    assert sliced.where("batch = 1").agg(F.max("t")).first()[0] == 2


def test_unseen_label_is_refused(spark):
    train = spark.createDataFrame([(v,) for v in ("GALAXY", "STAR", "QSO")], "y string")
    test = spark.createDataFrame([(v,) for v in ("QSO", "STAR")], "y string")
    splits.check_labels_seen(train, test, "y")
    with pytest.raises(ValueError, match="SUPERNOVA"):
        splits.check_labels_seen(train, test.union(spark.createDataFrame([("SUPERNOVA",)], "y string")), "y")


# --- fitted transforms


def test_label_codes_round_trip(spark):
    df = spark.createDataFrame([(v,) for v in ("GALAXY", "STAR", "QSO", "QSO")], "y string")
    codes = transforms.fit_labels(df, "y")
    assert codes.labels == ("GALAXY", "QSO", "STAR")
    coded = codes.encode(df, "y")
    assert rows(coded.distinct()) == [("GALAXY", 0), ("QSO", 1), ("STAR", 2)]
    assert rows(codes.decode(coded, "label_code"), "y", "prediction") == sorted((r.y, r.y) for r in df.collect())
    with pytest.raises(Exception, match="SUPERNOVA"):
        codes.encode(spark.createDataFrame([("SUPERNOVA",)], "y string"), "y").collect()


def test_imputer_drops_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None), (2.0, None), (9.0, None)], "x double, e double")
    model = transforms.fit_median_imputer(df, ["x", "e"])
    assert model.medians == {"x": 3.0} and model.dropped == ("e",)
    assert rows(model.transform(df)) == [(1.0,), (2.0,), (3.0,), (4.0,), (9.0,)]


@pytest.mark.parametrize(
    "name, want",
    [("standard", [-1.0, -1.0, 1.0, 1.0]), ("robust", [-0.5, -0.5, 0.5, 0.5]), ("MinMax", [0.0, 0.0, 1.0, 1.0])],
)
def test_scalers_and_constant_columns(spark, name, want):
    df = spark.createDataFrame([(k, v, 5.0) for k, v in enumerate((1.0, 1.0, 3.0, 3.0))], "k long, x double, c double")
    got = transforms.fit_scaler(df, ["x", "c"], name).transform(df)
    assert got.columns == ["x", "c", "k"]
    assert [(r.x, r.c) for r in got.orderBy("k").collect()] == [(w, 0.0) for w in want]


def test_unknown_scaler(spark):
    with pytest.raises(ValueError, match="minmax"):
        transforms.fit_scaler(spark.range(2), ["id"], "maxabs")


def test_pca_shares(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"))
    assert [round(r.variance_share, 9) for r in transforms.pca_variance(df, ["a", "b"]).collect()] == [1.0, 0.0]


# --- resampling


def imbalanced(spark, n=600):
    label = F.when(F.col("id") % 10 == 0, "few").when(F.col("id") % 10 < 4, "some").otherwise("many")
    return spark.range(n).select(
        "id", label.alias("y"), (F.pmod(F.hash("id"), F.lit(1000)) / 100.0).alias("a"), F.sin("id").alias("b")
    )


def test_class_weights(spark):
    got = {r.y: (r.n, round(r.weight, 9)) for r in resampling.class_weights(imbalanced(spark), "y").collect()}
    assert got == {"few": (60, round(600 / 180, 9)), "some": (180, round(600 / 540, 9)), "many": (360, round(600 / 1080, 9))}


def test_undersample_is_seeded(spark):
    df = imbalanced(spark)
    first = resampling.undersample(df, "y", "id", 7)
    assert rows(first.groupBy("y").count()) == [("few", 60), ("many", 60), ("some", 60)]
    assert rows(first) == rows(resampling.undersample(df.repartition(9), "y", "id", 7))


def test_smote_stays_on_lines_between_class_members(spark):
    df = imbalanced(spark)
    got = resampling.smote(df, "y", "id", ["a", "b"], 7)
    assert rows(got.groupBy("y").count()) == [("few", 360), ("many", 360), ("some", 360)]
    assert got.where("not synthetic").count() == 600
    box = df.groupBy("y").agg(F.min("a").alias("la"), F.max("a").alias("ha"), F.min("b").alias("lb"), F.max("b").alias("hb"))
    out = got.join(box, "y").where("a < la - 1e-9 or a > ha + 1e-9 or b < lb - 1e-9 or b > hb + 1e-9")
    assert out.count() == 0
    again = resampling.smote(df.repartition(3), "y", "id", ["a", "b"], 7)
    assert rows(again) == rows(got)


def test_smote_of_copies_gives_copies(spark):
    df = spark.range(40).select("id", F.when(F.col("id") < 10, "c").otherwise("d").alias("y"), F.lit(2.0).alias("a"))
    got = resampling.smote(df, "y", "id", ["a"], 1)
    assert rows(got.where("synthetic").groupBy("y", "a").count()) == [("c", 2.0, 20)]


def test_smote_needs_enough_rows_and_no_gaps(spark):
    df = spark.range(40).select("id", F.when(F.col("id") < 5, "c").otherwise("d").alias("y"), F.col("id").cast("double").alias("a"))
    with pytest.raises(ValueError, match="too few"):
        resampling.smote(df, "y", "id", ["a"], 1)
    with pytest.raises(ValueError, match="impute"):
        resampling.smote(df.withColumn("a", F.nullif("a", F.lit(3.0))), "y", "id", ["a"], 1)


def test_resampler_by_name(spark):
    df = imbalanced(spark)
    assert resampling.resample(df, None, "y", "id", ["a"], 1) is df
    assert resampling.resample(df, "class_weight", "y", "id", ["a"], 1) is df
    with pytest.raises(ValueError, match="smote"):
        resampling.resample(df, "adasyn", "y", "id", ["a"], 1)


# --- evaluation


def scored(spark):
    data = [
        ("A", "A", [0.7, 0.2, 0.1]), ("A", "B", [0.3, 0.5, 0.2]), ("B", "B", [0.2, 0.6, 0.2]), ("B", "B", [0.1, 0.8, 0.1]),
        ("C", "A", [0.6, 0.2, 0.2]), ("C", "C", [0.0, 0.0, 1.0]), ("A", "A", [1.0, 0.0, 0.0]),
    ]
    return spark.createDataFrame(data, "y string, p string, w array<double>")


def test_log_loss_clips(spark):
    want = -sum(math.log(max(p, 2.220446049250313e-16)) for p in (0.7, 0.3, 0.6, 0.8, 0.2, 1.0, 1.0)) / 7
    assert evaluation.log_loss(scored(spark), "ABC", "y", "w").first()[0] == pytest.approx(want)
    never = spark.createDataFrame([("A", [0.0, 1.0])], "y string, w array<double>")
    assert evaluation.log_loss(never, "AB", "y", "w").first()[0] == pytest.approx(-math.log(2.220446049250313e-16))


def test_auc_pairs_by_definition(spark):
    data = [(r.y, r.w) for r in scored(spark).collect()]

    def auc(up, down):
        pos = [w["ABC".index(up)] for y, w in data if y == up]
        neg = [w["ABC".index(up)] for y, w in data if y == down]
        return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))

    weights = {("A", "B"): 5, ("A", "C"): 5, ("B", "C"): 4}
    want = sum((auc(a, b) + auc(b, a)) / 2 * n for (a, b), n in weights.items()) / sum(weights.values())
    assert evaluation.auc_one_vs_one(scored(spark), "ABC", "y", "w").first()[0] == pytest.approx(want)


def test_report_and_confusion_keep_zeros(spark):
    table = {r.truth: (r.pred_A, r.pred_B, r.pred_C, r.pred_D) for r in evaluation.confusion(scored(spark), "ABCD", "y", "p").collect()}
    assert table == {"A": (2, 1, 0, 0), "B": (0, 2, 0, 0), "C": (1, 0, 1, 0), "D": (0, 0, 0, 0)}
    report = {r.label: r for r in evaluation.classification_report(scored(spark), "y", "p").collect()}
    assert (report["A"].precision, report["A"].recall, report["A"].support) == (pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
    assert report["accuracy"].f1 == pytest.approx(5 / 7) and report["weighted avg"].support == 7
    assert report["macro avg"].recall == pytest.approx((2 / 3 + 1 + 1 / 2) / 3)


def test_label_metrics_agree_with_the_library(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    code = {k: F.instr(F.lit("ABC"), F.col(k)).cast("double") for k in ("y", "p")}
    numbers = scored(spark).select(code["y"].alias("label"), code["p"].alias("prediction"))
    got = evaluation.label_metrics(scored(spark), "y", "p").first()
    names = {"accuracy": "accuracy", "f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}
    for ours, theirs in names.items():
        assert got[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(numbers))


def test_mixed_label_kinds(spark):
    with pytest.raises(ValueError):
        evaluation.outcome_counts(spark.createDataFrame([("A", 1)], "y string, p long"), "y", "p")


def test_unknown_labels_are_refused(spark):
    scored = spark.createDataFrame([("A", [0.5, 0.5]), ("C", [0.5, 0.5])], "y string, p array<double>")
    for row in (scored, scored.withColumn("y", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="no probability for the value"):
            evaluation.log_loss(row, ["A", "B"], "y", "p").collect()
        with pytest.raises(Exception, match="no probability for the value"):
            evaluation.auc_one_vs_one(row, ["A", "B"], "y", "p").collect()


def test_crosstab_finds_values_and_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, "x"), (2, "y")], "a long, b string")
    assert rows(dependence.crosstab(df, "a", "b")) == [(1, 1, 1), (2, 0, 1)]
    with pytest.raises(Exception, match="beside"):
        dependence.crosstab(df, "a", "b", ["x"]).collect()
    assert dependence.crosstab(df.limit(0), "a", "b").collect() == []


def test_flag_of_null_is_zero(spark):
    df = spark.createDataFrame([("O",), ("P",), (None,)], "c string")
    assert [r.f for r in cleaning.binary_flag(df, "c", "O", "f").collect()] == [1, 0, 0]


def test_null_groups_are_refused(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", None)], "y string, g long")
    with pytest.raises(ValueError, match="belong to no fold"):
        cleaning.check_preflight(df, "y", "g", 2)


def test_parameters_are_honoured_or_refused():
    assert models.clean_params("catboost", {"random_state": 7, "depth": 3}) == {"seed": 7, "max_depth": 3}
    assert models.clean_params("logreg", {"class_weight": "balanced", "n_jobs": 4}) == {}
    for name, params in (("logreg", {"class_weight": None}), ("logreg", {"solver": "saga"}), ("dense_nn", {"act_func": "relu"}),
                         ("xgboost", {"objective": "multi"}), ("catboost", {"loss_function": "RMSE"})):
        with pytest.raises(ValueError):
            models.clean_params(name, params)
    with pytest.raises(ValueError, match="deep"):
        models._depth({"max_depth": 31}, 5)


def test_rows_without_class_are_refused_everywhere(spark):
    df = spark.createDataFrame([(k, "a" if k % 2 else "b", float(k)) for k in range(40)] + [(100, None, 1.0)], "k long, c string, x double")
    for job in (
        lambda: resampling.class_weights(df, "c"),
        lambda: resampling.class_counts(df, "c"),
        lambda: resampling.undersample(df, "c", "k", 1),
        lambda: resampling.smote(df, "c", "k", ["x"], 1),
        lambda: models.fit_classifier(df, "random_forest", ["x"], "c", transforms.LabelCodes(("a", "b")), None, 1),
    ):
        with pytest.raises(ValueError, match="1 rows have no value of 'c'"):
            job()
    with pytest.raises(Exception, match="label not seen in training: null"):
        transforms.LabelCodes(("a", "b")).encode(df, "c").collect()


def test_undersampling_ten_thousand_classes_has_a_plan_of_constant_size(spark, monkeypatch):
    monkeypatch.setattr(resampling, "MOST_CLASSES", 10)
    with pytest.raises(ValueError, match="more than 10 classes"):
        resampling.class_counts(spark.range(11), "id")
    df = spark.range(42_000).select("id", F.pmod(F.col("id"), F.lit(10_000)).alias("c"), F.lit("x").alias("n"), F.lit("y").alias("cutoff"))
    df = df.unionByName(spark.range(42_000, 92_000).select("id", F.lit(3).cast("long").alias("c"), F.lit("x").alias("n"), F.lit("y").alias("cutoff")))
    kept = resampling.undersample(df, "c", "id", 5)
    assert kept.columns == df.columns
    sizes = rows(kept.groupBy("c").count())
    assert sizes == [(c, 4) for c in range(10_000)]
    few = resampling.undersample(df.where("c < 4"), "c", "id", 5)
    length = lambda x: len(x._jdf.queryExecution().optimizedPlan().toString().split("\n"))
    assert abs(length(kept) - length(few)) <= 2  # a broadcast hint more or less
    taken = {r.id for r in few.where("c = 3").collect()}
    order = df.where("c = 3").select("id", hashing.order_hash(5, "id").alias("h")).orderBy("h").limit(5).collect()
    assert taken == {r.id for r in order}


def test_spearman_deals_many_values_over_more_tasks(spark, monkeypatch):
    df = spark.range(400).select(F.col("id").alias("a"), ((F.col("id") * 7) % 401).alias("b"))
    want, seen, ranks = rows(dependence.spearman(df, ["a", "b"])), [], dependence.average_ranks
    monkeypatch.setattr(dependence, "VALUES_AT_ONCE", 100)
    monkeypatch.setattr(dependence, "average_ranks", lambda *x: (seen.append(spark.conf.get("spark.sql.shuffle.partitions")), ranks(*x))[1])
    got = rows(dependence.spearman(df, ["a", "b"]))
    assert seen == ["8"] and spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert [x[:2] for x in got] == [x[:2] for x in want] and got[0][2] == pytest.approx(want[0][2])
