from __future__ import annotations

import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.config import Contract
from tabulon.session import materialize, materialize_sized, scratch_path, shared_dir
from tabulon.sources import artifacts, contracts, fingerprints, tables


@pytest.fixture()
def abc(spark):
    return spark.createDataFrame([(1, 4, 7), (2, 5, 8), (3, 6, 9)], "a long, b long, c long")


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_materialize_keeps_rows_and_size(spark, abc):
    stored, n = materialize_sized(abc)
    assert n == 3 and rows(stored) == rows(abc)
    assert rows(materialize(abc.where("a > 5"))) == []


def test_contract(spark, abc):
    assert contracts.check_contract(abc, Contract(("c", "a", "b"), 3)) is abc
    with pytest.raises(ValueError, match="columns"):
        contracts.check_contract(abc, Contract(("a", "b"), 3))
    with pytest.raises(ValueError, match="columns"):
        contracts.check_contract(abc, Contract(("a", "b", "c", "d"), 3))
    with pytest.raises(ValueError, match="rows"):
        contracts.check_contract(abc, Contract(("a", "b", "c"), 4))


def test_missing_and_empty_paths(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType())])
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, str(tmp_path / "none.csv"), schema)
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        tables.read_parquet(spark, str(empty))


def test_csv_round_trip_nan_and_corrupt_lines(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("u-g", T.DoubleType()), T.StructField("s", T.StringType())])
    file = tmp_path / "in.csv"
    file.write_text("a,u-g,s\n1,0.5,x\n2,NaN,y\nthree,1.5,z\n4,,w\n")
    got = tables.read_csv(spark, str(file), schema)
    assert [tuple(r) for r in got.orderBy("s").collect()] == [(4, None, "w"), (1, 0.5, "x"), (2, None, "y"), (None, 1.5, "z")]
    kept = tables.read_csv(spark, str(file), schema, keep_corrupt=True).cache()
    assert [r[0] for r in kept.where(F.col("_corrupt_record").isNotNull()).select("_corrupt_record").collect()] == ["three,1.5,z"]
    tables.write_table(got, str(tmp_path / "deep" / "out"), "csv")
    again = tables.read_csv(spark, str(tmp_path / "deep" / "out"), schema)
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_usable_file(spark, tmp_path):
    file = tmp_path / "in.csv"
    file.write_text("a,b\n1,2\n3,4\n")
    assert contracts.is_usable(spark, str(file)) and contracts.is_usable(spark, str(file), 2)
    assert not contracts.is_usable(spark, str(file), 3)
    assert not contracts.is_usable(spark, str(tmp_path / "none.csv"))
    (tmp_path / "zero.csv").write_text("")
    assert not contracts.is_usable(spark, str(tmp_path / "zero.csv"))


def test_file_fingerprint(spark, tmp_path):
    (tmp_path / "hello.txt").write_text("hello world")
    (tmp_path / "b.bin").write_bytes(b"ab")
    for batch in ("batch=1", "batch=2"):
        (tmp_path / "deep" / batch).mkdir(parents=True)
        (tmp_path / "deep" / batch / "part-0").write_text(batch)
    got = rows(fingerprints.file_fingerprint(spark, str(tmp_path)))
    assert [r[0] for r in got] == ["b.bin", "deep/batch=1/part-0", "deep/batch=2/part-0", "hello.txt"]
    assert [got[0], got[3]] == [("b.bin", 2, hashlib.md5(b"ab").hexdigest()), ("hello.txt", 11, "5eb63bbbe01eeed093cb22bb8f5acdc3")]


def test_table_fingerprint_ignores_order_and_files(spark, abc):
    one = fingerprints.table_fingerprint(abc, ["a", "b", "c"]).first()
    assert one == fingerprints.table_fingerprint(abc.orderBy(F.desc("a")).repartition(3), ["a", "b", "c"]).first()
    assert one != fingerprints.table_fingerprint(abc.withColumn("c", F.col("c") + 1), ["a", "b", "c"]).first()


def test_table_fingerprint_sees_every_value(spark):
    def of(*row):
        return fingerprints.table_fingerprint(spark.createDataFrame([row], "a string, b string, x double"), ["a", "b", "x"]).first()

    assert len({of(*r) for r in (("p", None, 1.5), (None, "p", 1.5), ("p", None, 1.5000001), ("p", "n", 1.5), ("p", None, None), ("p", None, 1e300))}) == 6


def test_batches_are_one_file_each(spark, tmp_path):
    path = str(tmp_path / "batches")
    tables.write_batches(spark.range(10).withColumn("batch", F.floor(F.col("id") / 4) + 1), path)
    assert sorted(p.name for p in (tmp_path / "batches").glob("batch=*")) == ["batch=1", "batch=2", "batch=3"]
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in (tmp_path / "batches").glob("batch=*"))
    assert rows(spark.read.parquet(path).groupBy("batch").count()) == [(1, 4), (2, 4), (3, 2)]


def test_labels_records_and_run_log(spark, tmp_path):
    artifacts.save_labels(spark, ["GALAXY", "QSO", "STAR"], str(tmp_path / "labels"))
    assert artifacts.load_labels(spark, str(tmp_path / "labels")) == ["GALAXY", "QSO", "STAR"]
    tables.write_record(spark, {"n": 3, "name": "x", "share": 0.5}, str(tmp_path / "rec"))
    assert tables.read_record(spark, str(tmp_path / "rec")) == {"n": 3, "name": "x", "share": 0.5}
    log = str(tmp_path / "runs")
    artifacts.log_run(spark, log, "r1", params={"depth": 3, "criterion": "gini"})
    artifacts.log_run(spark, log, "r1", metrics={"f1": 0.5}, state={})
    assert rows(artifacts.read_log(spark, log), "run_id", "kind", "key", "value") == [
        ("r1", "metrics", "f1", "0.5"), ("r1", "params", "criterion", '"gini"'), ("r1", "params", "depth", "3"),
    ]


def test_versions(spark, tmp_path):
    root = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        artifacts.version_path(spark, root)
    for v in (1, 2, 10):
        tables.write_record(spark, {"v": v}, f"{root}/v={v}/manifest")
    assert artifacts.version_path(spark, root).endswith("v=10")
    assert artifacts.version_path(spark, root, 2).endswith("v=2")
    assert artifacts.next_version_path(spark, root).endswith("v=11")
    with pytest.raises(FileNotFoundError):
        artifacts.version_path(spark, root, 3)


def test_large_files_are_read_in_pieces(spark, tmp_path):
    import hashlib
    import random

    draw = random.Random(4)
    bodies = {
        "plain": b"a\nb", "ends": b"a\nb\n", "feeds": b"\n" * 700, "mark": b"\xef\xbb\xbfa\n" * 200, "both": b"\xef\xbb\xbfx" * 300 + b"\n",
        "returns": b"a\r\nb\r" * 100, "one line": b"z" * 5000, "bytes": draw.randbytes(300_000), "empty": b"", "sub/deep %20.bin": draw.randbytes(4000) + b"\n\n",
    }
    for name, body in bodies.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    want = sorted((n, len(b), hashlib.md5(b).hexdigest()) for n, b in bodies.items() if b)  # Spark does not list empty files
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        for limit in (0, 500, 1 << 30):
            assert rows(fingerprints.file_fingerprint(spark, str(tmp_path), whole_bytes=limit)) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "big.gz").write_bytes(b"x" * 100)
    with pytest.raises(ValueError, match="compressed"):
        fingerprints.file_fingerprint(spark, str(tmp_path), whole_bytes=50)


def test_a_large_file_is_read_by_one_task_without_a_row_of_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROW_BYTES", 2000, raising=False)
    bodies = {f"{k} {{1}}": (b"%d,abc\n" % k) * 900 for k in range(3)} | {"small": b"x" * 2000, "packed.gz": b"y\n" * 3000}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    read = []
    monkeypatch.setattr(fingerprints, "materialize", lambda df: read.append((df.rdd.getNumPartitions(), df)) or materialize(df), raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = rows(fingerprints.file_fingerprint(spark, str(tmp_path)))
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1000"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == sorted((n, len(b), hashlib.md5(b).hexdigest()) for n, b in bodies.items())
    assert [n for n, _ in read] == [3]  # a task each for the large ones, none for parts of them
    assert "Exchange" not in read[0][1]._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("whole", [1 << 30, 3000])
def test_files_with_long_pieces_are_left_to_rows(spark, tmp_path, monkeypatch, whole):
    monkeypatch.setattr(fingerprints, "ROW_BYTES", 2000, raising=False)
    monkeypatch.setattr(fingerprints, "PIECE_BYTES", 100, raising=False)
    bodies = {"one %20 line": b"z" * 2500, "some": b"a\n" * 900 + b"z" * 1500 + b"\nb", "short": b"a\n" * 2000, "longer": b"\xef\xbb\xbf" + b"y" * 4000 + b"\n"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    found = rows(fingerprints.file_fingerprint(spark, str(tmp_path), whole_bytes=whole))
    assert found == sorted((n, len(b), hashlib.md5(b).hexdigest()) for n, b in bodies.items())
