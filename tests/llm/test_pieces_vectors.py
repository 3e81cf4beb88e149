"""Piece encoding, centroid clustering and hard negatives against the library and brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tabulon.llm import hard_negatives, pieces
from tabulon.llm.centroids import lloyd, with_inertia
from tabulon.llm.hard_negatives import feasible, mine_negatives
from tabulon.llm.pieces import PieceEncoder, encode_pieces
from tabulon.llm.queries import op11_piece_encoding, piece_model_path
from conftest import SF

VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


@pytest.fixture(scope="module")
def own():
    with open(piece_model_path(), "rb") as file:
        return PieceEncoder(file.read())


# --- piece encoding ---

ALPHABETS = [
    "abcdefgh ", "aeiou\n\t ", "▁  x", "中文字母한국어", "éßСжйкл ", "̀किन", "0123456789.,;:!?()[]{}<>/=+-_*\"'",
    "👍🏽‍▁\x00﻿Ω", "<0x0A></s><s><unk>", "theandingionerun ▁▁▁▁", " a",
]


def lists(encoder, texts):
    flat, counts = encoder.encode(texts)
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


@pytest.mark.parametrize("parted", [True, False])
def test_ids_are_those_of_the_library(library, own, parted, monkeypatch):
    draw = random.Random(7)
    texts = [None, "", " ", "  ", "▁", "a", " a", "a ", "▁a▁", "x" * 64 + "é" * 200, " " * 500, "the" * 400, "a\n" * 90]
    for k in range(3000):
        letters = ALPHABETS[k % len(ALPHABETS)] if k % 3 else "".join(ALPHABETS)
        texts.append("".join(draw.choices(letters, k=draw.choice([1, 3, 10, 40, 150]))))
    monkeypatch.setattr(own, "_parted", parted)
    own._forget()
    assert lists(own, texts) == [library.encode(t or "") for t in texts]
    own._forget()


def test_words_are_forgotten_and_learnt_again(library, own, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    monkeypatch.setattr(pieces, "TABLE_WORDS", 3)
    monkeypatch.setattr(pieces, "PAIRS", 10)
    texts = ["one two three four five six", "seven eight nine ten one two", "one"]
    for text in texts:
        assert lists(own, [text]) == [library.encode(text)]


def test_encoding_keeps_rows_and_columns(spark, library):
    rows = [(1, None, "x", 5), (2, "", "y", 6), (3, "Héllo  wörld\n\n!", None, 7), (3, "Héllo  wörld\n\n!", None, 7), (None, "a" * 3000, "z", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, `odd name` int").repartition(3)
    got = encode_pieces(docs, piece_model_path())
    assert got.columns == ["doc_id", "text", "odd name", "ids", "decoded"]
    want = [(k, t, n, library.encode(t or ""), library.decode(library.encode(t or ""))) for k, t, _, n in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert encode_pieces(docs.limit(0), piece_model_path(), ["doc_id"]).collect() == []


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}

    def digest(x):
        return hashlib.sha256(x.encode()).hexdigest()

    for r in op11_piece_encoding(spark, SF).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))


# --- centroid clustering ---


def clustered(rows, k, rounds, scale, size, seed=3):
    """By keys and vectors in plain Python: assignments, distances and centroids."""
    kept = [(key, [int(np.floor(scale * float(x))) for x in v]) for key, v, _ in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        parts = [[] for _ in centres]
        for _, v in kept:
            parts[place(v)[1]].append(v)
        centres = [[sum(c) // len(p) for c in zip(*p)] if p else old for p, old in zip(parts, centres)]
    return [(key, place(v)[1], place(v)[0]) for key, v in kept], centres


def table(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("width", [2, 3, 32])
def test_lloyd_equals_brute_force(spark, width):
    draw = np.random.default_rng(width)
    rows = [(i, (draw.standard_normal(5) * 3).round(2).tolist(), 0) for i in range(160)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(60)] + [(7, rows[7][1], 0)]  # copies and a repeated row
    rows += [(500, None, 0), (501, [1.0] * 4, 0), (502, [1.0, None, 1.0, 1.0, 1.0], 0), (503, [float("nan")] * 5, 0), (504, [float("inf")] * 5, 0)]
    rows += [(None, [0.5] * 5, 0)]
    vectors = spark.createDataFrame(rows, VECTORS).withColumn("cluster", F.lit("x")).repartition(3)
    placed, centroids = lloyd(vectors, k=6, rounds=4, size=5, scale=1024, width=width)
    want, centres = clustered(rows, 6, 4, 1024, 5)
    assert table(map(tuple, placed.collect())) == table(want)
    assert [r.centroid for r in centroids.orderBy("cluster").collect()] == centres
    totals = with_inertia(placed, centroids).collect()
    assert {r.inertia for r in totals} == {sum(d for _, _, d in want)}
    for r in totals:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_lloyd_of_few_equal_and_no_vectors(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(3)]
    placed, centroids = lloyd(spark.createDataFrame(rows, VECTORS), k=8, rounds=2, size=2, width=1)
    assert table(map(tuple, placed.collect())) == table([(i, 0, 0) for i in range(3)])  # empty clusters keep their centre
    assert [r.centroid for r in centroids.collect()] == [[1024, 2048]] * 3
    placed, centroids = lloyd(spark.createDataFrame([], VECTORS), size=2)
    assert placed.collect() == [] and centroids.collect() == [] and with_inertia(placed, centroids).collect() == []


def test_lloyd_moves_no_vectors_in_a_round(spark):
    from tabulon.llm import centroids as c
    from tabulon.llm.tables import store_bucketed

    rows = [(i, [float(i), 2.0], 0) for i in range(50)]
    whole = spark.createDataFrame(rows, VECTORS).select(F.col("vec_id").alias("id"), c.whole_numbers("embedding", 4).alias("v"))
    blocks = store_bucketed(c._groups(whole, 2, 1), ["block", "grp"])
    centres = spark.createDataFrame([(0, 0, [3]), (1, 0, [4])], "block int, cluster int, c array<long>")
    plan = c._updated(blocks, spark.createDataFrame([], "grp long, best binary"), centres, 2, 1, 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text[text.index("Join") :]
    assert "Bucketed: true" in join and join.count("Exchange") == 1  # the assignments alone are shuffled to the join


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        lloyd(spark.createDataFrame([(1, [1e12, 0.0], 0)], VECTORS), size=2, rounds=1)[0].collect()


# --- hard negatives ---


def mined(rows, every=100, scale=256, n_pos=5, n_neg=5, percent=80):
    kept = [
        (key, label, [int(np.floor(scale * float(x))) for x in v])
        for key, v, label in rows
        if key is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for a, (key, label, v) in enumerate(kept):
        if key % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), other, l == label) for b, (other, l, w) in enumerate(kept) if b != a and len(w) == len(v)]
        for ps, positive, _ in sorted(s for s in scored if s[2])[:n_pos]:
            fit = sorted((s, k) for s, k, same in scored if not same and percent * -ps <= 100 * -s <= 100 * -ps)
            out += [(key, positive, r + 1, k, -ps, -s) for r, (s, k) in enumerate(fit[:n_neg])]
    return out


@pytest.mark.parametrize("bucket, at_once", [(2048, 16384), (16, 3)])
def test_mining_equals_brute_force(spark, monkeypatch, bucket, at_once):
    monkeypatch.setattr(hard_negatives, "BUCKET", bucket)
    monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", at_once)
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((6, 8))
    rows = [(i, (centres[i % 6] * draw.choice([0.3, 1, 4]) + 0.4 * draw.standard_normal(8)).tolist(), int(draw.integers(3))) for i in range(400)]
    rows += [(1000 + i, rows[20][1], rows[20][2]) for i in range(150)] + [(2000 + i, rows[21][1], i % 3) for i in range(40)]  # copies
    rows += [(20, rows[20][1], rows[20][2]), (40, rows[3][1], 1)]  # a repeated row, and its key on another vector
    rows += [(3000, [0.0] * 8, 0), (3020, [0.0] * 8, 1), (3040, [1.0, 2.0], 0), (3041, [2.0, 2.0], 0), (3042, [1.9, 1.9], 1)]
    rows += [(3060, None, 0), (3080, [1.0] * 8, None), (3100, [None] * 8, 0), (3120, [float("nan")] * 8, 0), (None, [1.0] * 8, 0), (3140, [], 0)]
    vectors = spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("x")).withColumn("k1", F.lit("x")).repartition(4)
    got = mine_negatives(vectors, F.col("vec_id") % 20 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert table(map(tuple, got.collect())) == table(mined(rows, 20))


def test_nothing_to_mine(spark):
    assert mine_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 20 == 0).collect() == []
    one = spark.createDataFrame([(20, [1.0], 0), (21, [1.0], 0), (22, [-1.0], 0)], VECTORS)
    assert mine_negatives(one, F.col("vec_id") % 20 == 0).collect() == []


def test_no_vector_above_the_threshold_is_pruned():
    draw = np.random.default_rng(2)
    x = draw.standard_normal((500, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = np.argsort(x, axis=0).T
    values = np.take_along_axis(x.T, lists, axis=1)
    ruled_out = 0
    for q in x[:50]:
        for threshold in (0.2, 0.7, 0.95, 1.0):
            some = feasible(threshold, np.arccos(np.clip(q, -1, 1)), lists, values, np.argsort(-np.abs(q))[:3])
            assert set(np.flatnonzero(x @ q >= threshold).tolist()) <= set(some.tolist())
            ruled_out += len(x) - len(some)
    assert ruled_out > 50 * 4 * 500 / 2
