"""Training, search, scoring and streams on a small table with learnable classes."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tabulon.config import BAND_PAIRS, Cleaning, Contract, Features, GroupSplit, Holdout, SearchSettings
from tabulon.operators import cleaning, models, splits, transforms
from tabulon.plans import dataset, search, spaces, training, validation
from tabulon.plans.scoring import Predictor, batch_predict, expected_inputs, score_table
from tabulon.sources import artifacts, tables
from tabulon.streaming import scoring as streams

FEATURES = Features()
RAW = ("obj_ID", "field_ID", "MJD", "class", "u", "g", "r", "i", "z", "redshift")
CLEAN = Cleaning((-9999,), BAND_PAIRS, ("MJD", "u", "g", "i", "z"))
FOREST = {"n_estimators": 10, "max_depth": 5}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Redshift and colours depend on the class; some bands are missing."""
    noise = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000.0
    label = F.when(F.col("id") % 5 < 3, "GALAXY").when(F.col("id") % 5 == 3, "STAR").otherwise("QSO")
    df = spark.range(900).withColumn("class", label)
    df = df.select(
        F.col("id").alias("obj_ID"),
        F.pmod(F.xxhash64("id"), F.lit(60)).alias("field_ID"),
        (50_000 + F.floor(F.col("id") / 7)).alias("MJD"),
        "class",
        F.when(F.col("id") % 97 == 0, -9999.0).otherwise(20 + noise(1)).alias("u"),
        (19 + noise(2) + F.when(F.col("class") == "STAR", 1.5).otherwise(0)).alias("g"),
        (18 + noise(3)).alias("r"),
        (17 + noise(4)).alias("i"),
        (16 + noise(5)).alias("z"),
        (noise(6) + F.when(F.col("class") == "QSO", 1.2).when(F.col("class") == "GALAXY", 0.4).otherwise(-0.5)).alias("redshift"),
    )
    path = str(tmp_path_factory.mktemp("raw") / "t")
    tables.write_table(df, path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def sides(raw):
    sided = splits.group_shuffle_split(cleaning.clean(raw, CLEAN), "field_ID", 0.8, 1)
    return sided.where("side = 'train'"), sided.where("side = 'test'")


@pytest.fixture(scope="module")
def forest(sides):
    return training.train(sides[0], FEATURES, "class", "obj_ID", "random_forest", FOREST)


@pytest.fixture(scope="module")
def predictor(forest):
    scored = Cleaning((-9999,), BAND_PAIRS, ("obj_ID", "MJD", "u", "g", "i", "z"))
    return Predictor(forest, expected_inputs(RAW, "class", "field_ID"), scored)


@pytest.mark.parametrize(
    "name, params, least",
    [
        ("random_forest", FOREST, 0.9),
        ("catboost", {"iterations": 5, "depth": 3, "random_state": 1}, 0.9),
        ("logreg", {"C": 1.0, "l1_ratio": 0.0, "max_iter": 50}, 0.9),
        ("sgd", {"alpha": 0.001, "penalty": "l2"}, 0.85),
        ("svc", {"C": 1.0, "max_iter": 30, "probability": True}, 0.75),
        ("dense_nn", {"num_layer": 1, "num_perceptron": 8, "max_iter": 60}, 0.8),
    ],
)
def test_models_learn_save_and_load(spark, sides, tmp_path, name, params, least):
    model, found = training.train_and_evaluate(*sides, FEATURES, "class", "obj_ID", name, params)
    assert found["accuracy"] >= least
    assert ("log_loss" in found) == ("roc_auc" in found) == (name != "svc")
    scored = model.predict_keeping(sides[1])
    assert scored.count() == sides[1].count() and set(sides[1].columns) < set(scored.columns)
    if name != "svc":
        total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
        assert scored.where(F.abs(total - 1) > 1e-6).count() == 0
    root = str(tmp_path / "model")
    model.save(spark, root, sides[1])
    again = training.TrainedModel.load(spark, root)
    assert rows(again.predict_keeping(sides[1]), "obj_ID", "prediction") == rows(scored, "obj_ID", "prediction")


def test_same_seed_and_layout_same_forest(sides):
    one_partition = sides[0].coalesce(1)
    first, again = (training.train(one_partition, FEATURES, "class", "obj_ID", "random_forest", FOREST) for _ in range(2))
    assert rows(again.predict(sides[1]), "obj_ID", "prediction") == rows(first.predict(sides[1]), "obj_ID", "prediction")


@pytest.mark.parametrize("scaler, resampling", [("robust", "smote"), ("minmax", "undersampling"), ("standard", None)])
def test_training_choices(sides, scaler, resampling):
    chosen = Features(scaler=scaler, resampling=resampling)
    model = training.train(sides[0], chosen, "class", "obj_ID", "logreg", {"max_iter": 20})
    assert training.score(model, sides[1], "class")["f1"] > 0.85


def test_unknown_names(sides):
    for change in ({"scaler": "nope"}, {"resampling": "nope"}):
        with pytest.raises(ValueError):
            training.train(sides[0], Features(**change), "class", "obj_ID", "logreg")
    with pytest.raises(ValueError, match="unknown model"):
        training.train(sides[0], FEATURES, "class", "obj_ID", "nope")
    with pytest.raises(ValueError, match="no parameter"):
        models.clean_params("logreg", {"depth": 3})
    with pytest.raises(ValueError, match="no training rows"):
        training.train(sides[0].where("obj_ID < 0"), FEATURES, "class", "obj_ID", "logreg")
    with pytest.raises(ValueError, match="no test rows"):
        training.train_and_evaluate(sides[0], sides[1].where("obj_ID < 0"), FEATURES, "class", "obj_ID", "logreg")


def test_hidden_layers_halve():
    assert models.hidden_layers(4, 128) == [128, 64, 32, 16]


def test_importance_finds_the_informative_columns(sides, forest):
    top = forest.classifier.importance().orderBy(F.desc("importance")).first()
    assert top.feature == "redshift"
    found = {r.feature: r.importance for r in validation.permutation_importance(forest, sides[1], "class", "obj_ID", 3).collect()}
    assert set(found) == set(FEATURES.columns)
    assert max(found, key=found.get) == "redshift" and found["redshift"] > 0.2 and abs(found["i_z"]) < 0.1


def test_importance_is_for_forests(sides):
    model = training.train(sides[0], FEATURES, "class", "obj_ID", "logreg", {"max_iter": 5})
    with pytest.raises(ValueError, match="permutation"):
        model.classifier.importance()


def test_cross_validation(raw):
    clean = cleaning.clean(raw, CLEAN)
    table = validation.cross_validate(clean, FEATURES, "class", "field_ID", "obj_ID", "random_forest", FOREST)
    assert [r.fold for r in table.orderBy("fold").collect()] == [0, 1, 2]
    mean = validation.mean_over_folds(table).first()
    assert mean.f1 == pytest.approx(sum(r.f1 for r in table.collect()) / 3) and mean.f1 > 0.9
    with pytest.raises(ValueError):
        validation.cross_validate(clean, FEATURES, "class", "field_ID", "obj_ID", "logreg", folds=1)


def test_draws_and_prefixes():
    space = {
        "a": {"type": "int", "low": 1, "high": 3}, "b": {"type": "float", "low": 0.001, "high": 10, "log": True},
        "c": {"type": "categorical", "choices": ["x", None]}, "d": {"type": "fixed", "value": "None"},
        "e": {"type": "float", "low": -1, "high": 1},
    }
    point = spaces.draw(random.Random(1), space)
    assert point == spaces.draw(random.Random(1), space)
    assert 1 <= point["a"] <= 3 and 0.001 <= point["b"] <= 10 and -1 <= point["e"] <= 1
    assert spaces.with_fixed(space, {"a": 2}) == {"a": 2, "d": None}
    assert spaces.strip_prefix({"svc_C": 1, "alpha": 2}, "svc") == {"C": 1, "alpha": 2}
    with pytest.raises(ValueError):
        spaces.draw(random.Random(1), {"a": {"type": "nope"}})
    for name in models.FAMILIES:
        models.clean_params(name, spaces.draw(random.Random(2), spaces.SPACES[name]))


def test_experiment(spark, raw, tmp_path):
    small = {"logreg": {"C": {"type": "float", "low": 0.1, "high": 10, "log": True}, "max_iter": {"type": "fixed", "value": 20}}}
    settings = SearchSettings(models=("logreg",), trials=2, folds=2, spaces=small, resamplings=("class_weight",))
    out = str(tmp_path / "run")
    model, found = search.run_experiment(
        cleaning.clean(raw, CLEAN), FEATURES, GroupSplit("field_ID", "class", 0.8, 1), "obj_ID", settings, out
    )
    assert found["f1"] > 0.85 and tables.read_record(spark, f"{out}/metrics") == found
    assert artifacts.load_labels(spark, f"{out}/labels") == ["GALAXY", "QSO", "STAR"]
    log = artifacts.read_log(spark, f"{out}/runs")
    assert {"trial-0", "trial-1"} < {r.run_id for r in log.select("run_id").distinct().collect()}
    assert log.where("run_id = 'trial-0' and key = 'logreg_C'").count() == 1
    assert tables.read_record(spark, f"{out}/best_params")["max_iter"] == 20
    for report in ("classes", "confusion", "rank_correlation", "importance", "target_train", "target_test"):
        assert spark.read.json(f"{out}/reports/{report}").count() > 0
    assert training.TrainedModel.load(spark, f"{out}/model").classifier.labels == model.classifier.labels


def test_dataset_build(spark, raw, tmp_path):
    paths = dataset.DatasetPaths(*[str(tmp_path / n) for n in ("train", "prod", "batches", "processed", "meta", "runs")])
    dataset.build_dataset(raw, Contract(RAW, 900), Holdout("MJD", "obj_ID", 0.2, 50), CLEAN, paths)
    train, prod = spark.read.parquet(paths.training), spark.read.parquet(paths.production)
    assert (train.count(), prod.count()) == (720, 180)
    assert train.agg(F.max("MJD")).first()[0] <= prod.agg(F.min("MJD")).first()[0]
    assert rows(spark.read.parquet(paths.batches).groupBy("batch").count()) == [(1, 50), (2, 50), (3, 50), (4, 30)]
    assert set(spark.read.parquet(paths.processed).columns) == {"obj_ID", "field_ID", "class", *FEATURES.columns}
    meta = tables.read_record(spark, paths.metadata)
    assert meta["n_train"] == 720 and meta["split_method"] == "time_based_MJD" and meta["training_path"] == paths.training
    with pytest.raises(RuntimeError, match="contract"):
        dataset.build_dataset(raw, Contract(RAW, 901), Holdout("MJD", "obj_ID"), CLEAN, paths)


def test_batch_scoring(spark, raw, predictor, tmp_path):
    scored, report = score_table(predictor, raw, str(tmp_path / "out"))
    assert scored.count() == 900 and scored.columns == [*RAW, "prediction", "prediction_timestamp"]
    assert scored.select("prediction_timestamp").distinct().count() == 1
    assert rows(scored.select(*RAW)) == rows(raw)  # sentinels and labels come back as they were
    assert {r.label for r in report.collect()} == {"GALAXY", "QSO", "STAR", "accuracy", "macro avg", "weighted avg"}
    unlabelled, none = score_table(predictor, raw.drop("class", "field_ID"))
    assert none is None and rows(unlabelled, "obj_ID", "prediction") == rows(scored, "obj_ID", "prediction")
    with pytest.raises(ValueError, match="contract"):
        predictor.predict(raw.drop("u"))
    with pytest.raises(FileNotFoundError):
        batch_predict(spark, predictor, str(tmp_path / "none"))


def test_one_record(raw, predictor):
    found = predictor.predict_one(raw.where("obj_ID = 3"))
    assert found["true_class"] == "STAR" and found["prediction"] in ("GALAXY", "QSO", "STAR") and found["latency_seconds"] > 0
    assert predictor.predict_one(raw.where("obj_ID = 3").drop("class"))["true_class"] is None
    for bad in (raw.where("obj_ID < 0"), raw.where("obj_ID < 3")):
        with pytest.raises(ValueError):
            predictor.predict_one(bad)


def test_stream_equals_batch_and_isolates_bad_rows(spark, raw, predictor, tmp_path):
    source, out, bad = (str(tmp_path / n) for n in ("in", "out", "bad"))
    spoilt = raw.withColumn("r", F.when(F.col("obj_ID") % 100 != 7, F.col("r")))
    tables.write_batches(splits.batch_slices(spoilt, "MJD", "obj_ID", 250), source)
    schema = spark.read.parquet(source).schema
    stream = lambda: streams.read_batches(spark, source, schema)
    state = str(tmp_path / "state")
    assert streams.stream_predict(stream(), predictor, out, bad, F.col("r").isNotNull(), state) == 891
    got = streams.read_predictions(spark, out)
    want = predictor.predict(raw.where("obj_ID % 100 <> 7"))
    assert rows(got, "obj_ID", "prediction") == rows(want, "obj_ID", "prediction")
    assert sorted(r.batch_id for r in got.select("batch_id").distinct().collect()) == [0, 1, 2, 3]
    assert got.where("latency_seconds > 0").count() == 891
    assert rows(spark.read.parquet(bad), "obj_ID") == [(k,) for k in range(7, 900, 100)]
    truth = {r.obj_ID: r["class"] for r in raw.collect()}
    hits = [(r.batch_id, truth[r.obj_ID] == r.prediction) for r in got.collect()]
    n = 0
    for k, r in enumerate(streams.read_accuracy(spark, out).orderBy("batch_id").collect()):
        own = [h for b, h in hits if b == k]
        n += len(own)
        so_far = [h for b, h in hits if b <= k]
        assert (r.batch_id, r.n, r.n_so_far) == (k, len(own), n)
        assert (r.accuracy, r.running_accuracy) == pytest.approx((sum(own) / len(own), sum(so_far) / n))
    # nothing new has arrived: a restart from the same state scores nothing twice
    assert streams.stream_predict(stream(), predictor, out, bad, F.col("r").isNotNull(), state) == 0
    assert streams.read_predictions(spark, out).count() == 891


def test_many_waiting_files_take_few_micro_batches(spark, raw, predictor, tmp_path):
    source, out = str(tmp_path / "batches"), str(tmp_path / "out")
    batches = raw.withColumn("batch", F.col("obj_ID") % 40)
    tables.write_batches(batches, source)
    waiting = spark.read.parquet(source)
    assert streams.files_at_once(waiting) == 8 and streams.files_at_once(waiting, most_batches=3) == 14
    assert streams.files_at_once(waiting, least=1) == 2
    stream = streams.read_batches(spark, source, waiting.schema, streams.files_at_once(waiting, most_batches=3))
    assert streams.stream_predict(stream, predictor, out, str(tmp_path / "bad")) == raw.count()
    got = streams.read_predictions(spark, out)
    assert got.select("batch_id").distinct().count() == 3
    assert rows(got, "obj_ID", "batch") == rows(batches, "obj_ID", "batch")


def test_stream_stops_after_enough_records(spark, raw, predictor, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    tables.write_batches(splits.batch_slices(raw, "MJD", "obj_ID", 60), source)
    schema = spark.read.parquet(source).schema
    done = streams.stream_predict(
        streams.read_batches(spark, source, schema), predictor, out, str(tmp_path / "bad"), max_records=100
    )
    assert done == 100 == streams.read_predictions(spark, out).count()


def test_parsing_and_replay(spark):
    df = spark.createDataFrame([(1, "1.5", "2"), (2, "n/a", None), (3, None, "x")], "k long, a string, b string")
    parsed = streams.parse_records(df, ["a", "b"]).orderBy("k")
    assert [tuple(r) for r in parsed.collect()] == [(1, 1.5, 2.0, 0), (2, None, None, 1), (3, None, None, 1)]
    good, bad = streams.split_valid(parsed, F.col("a") > 1)
    assert (good.count(), bad.count()) == (1, 2)
    drawn = streams.replay(spark.range(50), "id", 200, 9)
    assert drawn.count() == 200 and rows(drawn) == rows(streams.replay(spark.range(50).repartition(6), "id", 200, 9))
    assert {r.id for r in drawn.collect()} <= set(range(50))
    with pytest.raises(ValueError):
        streams.replay(spark.range(0), "id", 5, 1)


def test_replay_as_a_stream_goes_on_where_it_ended(spark, tmp_path):
    table = spark.range(50).select("id", (F.col("id") * 2).alias("value"))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    want = rows(streams.replay(table, "id", 700, 9).select("draw", "id", "value"))
    part = streams.replay_stream(table, "id", 700, 9, out, state, rows_per_second=300, most_batches=3)
    assert part.columns == ["draw", "id", "value"] and part.count() < 700
    whole = streams.replay_stream(table, "id", 700, 9, out, state, rows_per_second=300)
    assert rows(whole) == want  # each draw once, those of the first run too
    with pytest.raises(ValueError):
        streams.replay_stream(table.limit(0), "id", 5, 1, str(tmp_path / "none"))


def test_labels_survive_a_class_missing_from_a_fold(sides):
    labels = transforms.LabelCodes(("GALAXY", "QSO", "STAR"))
    part = sides[0].where("class <> 'STAR'")
    model = training.train(part, FEATURES, "class", "obj_ID", "random_forest", FOREST, labels=labels)
    assert len(model.predict(sides[1]).first().probability) == 3


def test_trials_share_the_steps_of_a_fold(sides, monkeypatch):
    space = {"random_forest": {"n_estimators": {"type": "int", "low": 2, "high": 4}, "max_depth": {"type": "int", "low": 2, "high": 3}}}
    settings = SearchSettings(models=("random_forest",), trials=3, folds=2, scalers=("robust",), resamplings=("class_weight",), spaces=space)
    alone = [
        validation.cross_validate(sides[0], Features(scaler="robust"), "class", "field_ID", "obj_ID", t.model, t.params, 2, settings.seed)
        for t in search.plan_trials(settings)
    ]
    made = []
    monkeypatch.setattr(validation, "prepare_training", lambda *a, make=validation.prepare_training: made.append(a) or make(*a))
    trials = search.run_search(sides[0], FEATURES, "class", "field_ID", "obj_ID", settings)
    assert len(made) == 2  # folds, not folds of each trial
    for trial, metrics in zip(trials, alone, strict=True):
        assert trial.metrics == pytest.approx(validation.mean_over_folds(metrics).first().asDict())
