"""Packing, decontamination, language, URL, vector operators and the pipeline against brute force."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabulon.llm import language, packing, vectors
from tabulon.llm.decontamination import find_leaks
from tabulon.llm.language import Settings, fit_language_model, held_out
from tabulon.llm.packing import bin_completion, lower_bound, pack_documents
from tabulon.llm.queries import RULES, tokenizer_path
from tabulon.llm.url_graph import filter_urls
from tabulon.llm.vectors import Forest, near_vectors
from tabulon.session import scratch_tables

SCHEMA = "doc_id long, text string"


# --- packing ---


def fewest(sizes, capacity):
    """Least number of bins by trying everything."""
    best = [len(sizes)]

    def place(rest, bins):
        if len(bins) >= best[0]:
            return
        if not rest:
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + rest[0] <= capacity:
                place(rest[1:], bins[:k] + [bins[k] + rest[0]] + bins[k + 1 :])
        place(rest[1:], [*bins, rest[0]])

    place(sorted(sizes, reverse=True), [])
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_bin_completion_is_optimal_on_small_cases(seed):
    draw = random.Random(seed)
    capacity = 40
    sizes = [draw.randint(1, 40) if seed % 2 else draw.randint(8, 24) for _ in range(11)]
    counts = np.bincount(sizes, minlength=capacity + 1)
    packed = bin_completion(counts, capacity, nodes=5000)
    used = np.zeros(capacity + 1, dtype=int)
    for pattern, times in packed:
        assert sum(pattern) <= capacity
        np.add.at(used, pattern, times)
    assert (used == counts).all()
    assert lower_bound(counts, capacity) <= sum(n for _, n in packed) == fewest(sizes, capacity)


def test_bin_completion_beats_best_fit_and_takes_edges():
    counts = np.bincount(np.random.default_rng(1).integers(300, 900, 60), minlength=2049)
    best_fit = sum(n for _, n in packing._best_fit(counts, 2048))
    assert sum(n for _, n in bin_completion(counts)) < best_fit
    assert bin_completion(np.zeros(2049, dtype=int)) == []
    assert sum(n for _, n in bin_completion(np.bincount([2048] * 5 + [1] * 7, minlength=2049))) == 6


def test_packing_is_gapless_and_keeps_the_tokens(spark):
    from tokenizers import Tokenizer

    draw = random.Random(3)
    letters = "abcXYZéßСж中 .,!'\n0123\u0300\u0130"
    rows = [(i, "".join(draw.choices(letters, k=draw.choice([0, 1, 20, 300, 9000])))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "<|endoftext|> Hello <|ENDOFTEXT|>"), (62, "x"), (62, "x"), (None, "It's YOU'RE a,'s b")]
    wide = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit(1)).withColumn("rank", F.lit(1)).repartition(3)
    got = pack_documents(wide, tokenizer_path(), keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = []
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at : at + 2048]
            want.append((key, k, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()), tuple(cut)))
    order = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got), key=order) == sorted(want, key=order)
    of_sequence: dict[int, list] = {}
    for r in got:
        of_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in of_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    counts = np.bincount([r.length for r in got], minlength=2049)
    assert len(of_sequence) == sum(n for _, n in bin_completion(counts))
    assert pack_documents(spark.createDataFrame([], SCHEMA), tokenizer_path()).collect() == []


def test_word_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    encode = packing.WordEncoder(tokenizer_path())
    texts = [f"word{i} letters".encode() for i in range(200)]
    one_by_one = [encode([t], 0)[0].tolist() for t in texts]
    assert one_by_one == [x.tolist() for x in packing.WordEncoder(tokenizer_path())(texts, 0)]


def test_workers_keep_no_words_of_a_packing(spark):
    docs = spark.range(0, 800, 1, 8).select(F.col("id").alias("doc_id"), F.concat(F.lit("letters word"), "id").alias("text"))
    path = tokenizer_path()
    assert packing.token_pieces(docs, path).count() == 800

    def words(batches):
        for batch in batches:
            found = [len(x._code) for x in packing._ENCODERS.values()]
            yield batch.slice(0, 1).set_column(0, "id", [sum(found)])

    left = spark.range(0, 800, 1, 8).mapInArrow(words, "id long").collect()  # in the workers of the packing, as no others are begun
    assert [r.id for r in left] == [0] * 8


# --- decontamination ---


def passage_score(item, words):
    """Smith and Waterman cell by cell, as a share of a full match."""
    h = [[0] * (len(words) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(words, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a == b else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best / (2 * len(item))


def leak_case():
    draw = random.Random(8)
    names = ["".join(draw.choices("bcdefgaiou", k=draw.randint(2, 8))) for _ in range(900)]
    common = ["of", "the", "and", "to"]
    prose = lambda k: [draw.choice(common) if draw.random() < 0.4 else draw.choice(names) for _ in range(k)]
    items = [(i, prose(draw.randint(15, 50))) for i in range(20)]
    docs = []
    for i in range(150):
        words = prose(draw.randint(5, 300))
        if i % 3 == 0:
            copy = list(items[draw.randrange(20)][1])
            for _ in range(int(len(copy) * draw.choice([0, 0.1, 0.2, 0.6]))):
                k = draw.randrange(len(copy))
                copy[k : k + 1] = draw.choice([[], [draw.choice(names)], [copy[k], draw.choice(names)]])
            at = draw.randrange(len(words))
            words[at:at] = copy
        docs.append((i, words))
    return docs, items


@pytest.mark.parametrize("block_words", [2_000_000, 150])
def test_leaks(spark, block_words):
    docs, items = leak_case()
    text = lambda w: ", ".join(w).upper()
    frame = spark.createDataFrame([(i, text(w)) for i, w in docs] + [(900, None), (901, "")], SCHEMA)
    tests = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(77, None), (78, "of the"), (79, "")], "item_id long, text string")
    wide = frame.withColumn("leaks", F.lit(1)).withColumn("words", F.lit(2))
    out = find_leaks(wide, tests, block_words=block_words)
    assert out.columns == ["doc_id", "text", "words", "leaks"]
    got = {(r.doc_id, x.item_id): x.score for r in out.collect() for x in r.leaks}
    want = {(d, i): s for d, w in docs for i, item in items if (s := passage_score(item, w)) >= 0.5}
    assert got == pytest.approx(want)
    assert len(want) > 30


def test_leaks_without_items_or_documents(spark):
    docs, none = spark.createDataFrame([(1, "a b c d e f")], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert [r.leaks for r in find_leaks(docs, none).collect()] == [[]]
    assert find_leaks(spark.createDataFrame([], SCHEMA), none).collect() == []
    hot = spark.createDataFrame([(i, f"a{i} one two three four five six seven b{i}") for i in range(60)], SCHEMA)
    item = spark.createDataFrame([(5, "one two three four five six seven")], "item_id long, text string")
    assert all(len(r.leaks) == 1 for r in find_leaks(hot, item).collect())  # a copy in every document is still found


# --- language ---


def tongues(n=400):
    draw = random.Random(4)
    parts = {"aa": ["ka", "to", "mi", "ra", "su"], "bb": ["sch", "ung", "ein", "der", "ß"], "cc": ["é", "eau", "ou", "que", "la"]}
    rows = []
    for i in range(n):
        lang = draw.choice(list(parts))
        words = ["".join(draw.choices(parts[lang], k=draw.randint(1, 4))) for _ in range(draw.randint(3, 60))]
        rows.append((i, " ".join(words).capitalize() + ".", lang))
    return rows


def test_language(spark):
    rows = tongues() + [(900, None, "aa"), (901, "", "bb"), (902, "12 -- ?", "cc"), (903, "kato mira", None), (None, "eau que la eau", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    settings = Settings(train_rows=120, calibration_rows=60)
    model = fit_language_model(docs, ~held_out(), settings)
    assert model.labels == ["aa", "bb", "cc"] and np.mean(model.weights == 0) > 0.5
    wide = docs.withColumn("held", held_out()).withColumn("score", F.lit("x")).withColumn("role", F.lit(1))
    got = model.predict(wide).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held and r.doc_id is not None and r.doc_id < 900]
    assert len(held) > 50 and np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 < r.score <= 1 for r in held)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (900, 901, 902)} == {("und", 0.0)}
    again = fit_language_model(docs.repartition(7), ~held_out(), settings)
    assert np.abs(again.weights - model.weights).max() < 1e-3  # the sample does not depend on the layout


def test_language_with_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "aa")], "doc_id long, text string, lang string")
    model = fit_language_model(docs, ~held_out())
    assert [(r.lang_pred, r.score) for r in model.predict(docs).collect()] == [("und", 0.0)] * 2


# --- URLs ---


def test_url_rules_and_graph(spark):
    link = '<a class="x" HREF="{}">t</a>'
    pages = [
        (1, "https://Good.com/x?y", link.format("//friend.org/") + "<a href='/own'>"), (2, "http://www.example.com/en/1#a", ""),
        (3, "http://www.example.com/fr", ""), (4, "http://m.example.com/en/1", ""), (5, "http://example.com", ""),
        (6, "http://a.net/es/1", ""), (7, "http://a.net/en/1", ""), (8, "http://farm.org/1", link.format("https://A.NET/q") * 3),
        (9, "http://friend.org/", None), (10, "nothing", "x"), (11, None, None), (12, "notexample.com://q/en/", ""),
        (13, "http://badexample.com/en/", ""), (14, "x://", ""), (15, "http://both.org", link.format("http://a.net") + link.format("http://good.com") * 9),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit(1)).withColumn("best", F.lit(1))
    got = {r.page_id: r for r in filter_urls(frame, RULES).collect()}
    assert len(got) == len(pages)
    want = {
        1: ("good.com", "/x", "com/", "allow"), 2: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        3: ("www.example.com", "/fr", "com/", "allow"), 4: ("m.example.com", "/en/1", "example.com/en/", "block"),
        5: ("example.com", "", None, "allow"), 6: ("a.net", "/es/1", "net/es/", "block"), 7: ("a.net", "/en/1", None, "block"),
        8: ("farm.org", "/1", None, "allow"), 9: ("friend.org", "/", None, "allow"), 10: ("", "", None, "allow"),
        11: ("", "", None, "allow"), 12: ("q", "/en/", None, "allow"), 13: ("badexample.com", "/en/", "com/", "allow"),
        14: ("", "", None, "allow"), 15: ("both.org", "", None, "allow"),
    }
    assert {k: (r.host, r.path, r.rule, r.verdict) for k, r in got.items()} == want
    assert filter_urls(frame.limit(0), RULES).collect() == []

    # scores against dense linear algebra
    hosts = ["good.com", "www.example.com", "m.example.com", "example.com", "a.net", "farm.org", "friend.org", "q", "badexample.com", "both.org"]
    at = {h: i for i, h in enumerate(hosts)}
    links = np.zeros((len(hosts), len(hosts)))
    for a, b, n in [("good.com", "friend.org", 1), ("farm.org", "a.net", 3), ("both.org", "a.net", 1), ("both.org", "good.com", 9)]:
        links[at[a], at[b]] = n
    share = lambda m: m / np.maximum(m.sum(axis=1, keepdims=True), 1)
    trusted, blocked = np.zeros(len(hosts)), np.zeros(len(hosts))
    trusted[[at["good.com"], at["www.example.com"], at["badexample.com"]]] = 1
    blocked[at["m.example.com"]], blocked[at["a.net"]] = 1, 0.5
    for kind, seeds, step in (("trust", trusted, share(links)), ("distrust", blocked, share(links.T))):
        exact = np.linalg.solve(np.eye(len(hosts)) - 0.85 * step.T, seeds)
        for r in got.values():
            if r.host in at:
                assert getattr(r, kind) == pytest.approx(exact[at[r.host]], abs=1e-4)


@pytest.mark.parametrize("linkers", [1, 2, 40])
def test_link_farm_is_blocked_whatever_its_size(spark, linkers):
    link = "<a href='http://{}/'>"
    pages = [(0, "http://bad.net/es/1", ""), (1, "http://fair.org/", link.format("bad.net") + link.format("other.org") * 3)]
    pages += [(2, "http://relay.org/", link.format("farm0.org")), (3, "http://good.com/", link.format("fair.org"))]
    pages += [(10 + i, f"http://farm{i}.org/", link.format("bad.net")) for i in range(linkers)]
    got = {r.host: r for r in filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()}
    assert {h for h, r in got.items() if r.verdict == "block"} == {"bad.net", "relay.org", *(f"farm{i}.org" for i in range(linkers))}
    want = {"bad.net": 1, "farm0.org": 0.85, "relay.org": 0.85**2, "fair.org": 0.85 / 4, "good.com": 0.85**2 / 4}
    assert {h: got[h].exposure for h in want} == pytest.approx(want, abs=1e-5)


def test_url_scores_meet_their_tolerance(spark):
    # two hosts that link to each other keep a score going round: 30 rounds leave 0.8 % of it out
    pages = [(1, "http://a.com/", "<a href='http://b.org/'>"), (2, "http://b.org/", "<a href='http://a.com/'>"), (3, "http://c.net/es/", "")]
    got = {r.host: r for r in filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()}
    assert [got[h].trust for h in ("a.com", "b.org")] == pytest.approx([1 / (1 - 0.85**2), 0.85 / (1 - 0.85**2)], abs=1e-4)


# --- vectors ---


def brute_vectors(rows, cosine=0.93):
    ok = [
        i for i, (_, v, label) in enumerate(rows)
        if label is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
    ]
    x = {i: np.array(rows[i][1], np.float32).astype(float) for i in ok}
    near = {i: set() for i in range(len(rows))}
    for i in ok:
        for j in ok:
            if i != j and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= cosine:
                    near[i].add(j)
    out = {}
    for i, (key, _, _) in enumerate(rows):
        reach, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        least = min(rows[j][0] for j in reach)
        out[key] = (len(near[i]), least, least == key)
    return out


def vector_rows(seed=2, n=900, size=16):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((150, size))
    rows = []
    for i in range(n):
        v = draw.standard_normal(size) if i % 2 else centres[draw.integers(150)] + draw.standard_normal(size) * 0.12
        rows.append((i, v.astype(np.float32).tolist(), int(draw.integers(3)) if i % 7 else 1))
    for k in range(120):  # one vector over and over, under one label
        rows.append((n + k, rows[3][1], 1))
    odd = [([0.0] * size, 1), (None, 1), ([float("nan")] * size, 1), ([1.0] * size, None), ([1.0] * size, None), ([], 2), ([1.0, 2.0], 2), ([2.0, 4.0], 2)]
    return rows + [(2000 + k, v, label) for k, (v, label) in enumerate(odd)]


@pytest.mark.parametrize("leaf", [60, 5000])
def test_near_vectors(spark, leaf):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("c", F.lit(1)).withColumn("node", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(frame, Forest(leaf=leaf)).collect()}
    want = brute_vectors(rows)
    assert got.keys() == want.keys()
    links = sum(v[0] for v in want.values())
    if leaf == 5000:
        assert got == want
    else:
        assert 0.95 * links <= sum(v[0] for v in got.values()) <= links
        assert all(got[k][0] <= want[k][0] for k in want)
    assert {k: v for k, v in got.items() if k >= 2000} == {k: v for k, v in want.items() if k >= 2000}


def test_leaf_that_cannot_be_cut_is_compared_in_blocks(spark):
    draw = np.random.default_rng(5)
    base = draw.standard_normal(8)
    rows = [(i, (base + draw.standard_normal(8) * 1e-3).astype(np.float32).tolist(), 0) for i in range(150)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), Forest(leaf=20, trees=2)).collect()
    assert all((r.n_links, r.component_id) == (149, 0) for r in got)


@pytest.mark.parametrize("whole", [1 << 24, 0])
def test_vectors_are_stored_once(spark, whole):
    """As classes, whatever the number of trees."""
    draw = np.random.default_rng(6)
    rows = [(i, draw.standard_normal(64).astype(np.float32).tolist(), i % 2) for i in range(4000)]
    with scratch_tables(spark) as scratch:
        near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), Forest(whole=whole, leaf=300) if whole == 0 else Forest())
        stored = sum(p.stat().st_size for path in scratch.paths for p in Path(path.removeprefix("file:")).rglob("*.parquet"))
    assert stored < 2 * 4000 * 64 * 4


@pytest.mark.parametrize("block", [1 << 22, 600])
def test_labels_too_large_to_compare_whole(spark, block):
    rows = vector_rows(seed=8)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = brute_vectors(rows)
    got = {r.vec_id: r.n_links for r in near_vectors(frame, Forest(leaf=60, whole=1000, block=block)).collect()}
    assert got.keys() == want.keys() and all(got[k] <= want[k][0] for k in want)
    assert sum(got.values()) >= 0.95 * sum(v[0] for v in want.values())


@pytest.mark.parametrize("noise", [0.15, 0.02])
def test_pairs_equal_brute_force(monkeypatch, noise):
    monkeypatch.setattr(vectors, "_TILE", (32, 48))
    draw = np.random.default_rng(9)
    centres, copies = draw.standard_normal((3, 16)), draw.integers(1, 9, 500)
    x = (centres[draw.integers(3, size=500)] + noise * draw.standard_normal((500, 16))).astype(np.float32)
    x[::3] = draw.standard_normal((167, 16))
    u = x.astype(np.float64)
    near = (u @ u.T) / np.linalg.norm(u, axis=1) / np.linalg.norm(u, axis=1)[:, None]
    cosine = float(near[1, near[1] < 0.999].max())  # a pair lies at it, but for the last digit
    near = near >= cosine - 1e-12
    np.fill_diagonal(near, False)
    for left, right in ((np.arange(500),) * 2, (np.arange(0, 500, 2), np.arange(1, 500, 2))):
        kept = np.zeros((500, 500), dtype=bool)
        kept[np.ix_(left, right)] = near[np.ix_(left, right)]
        kept |= kept.T
        pairs = vectors._Pairs(x, copies, cosine - 1e-12)
        pairs.compare(left, left if len(left) == 500 else right)
        assert pairs.others.tolist() == (kept @ copies).tolist()
        p, q = np.nonzero(kept)
        assert pairs.root.tolist() == vectors._united(500, p, q).tolist()
        split = vectors._Pairs(x, copies, cosine - 1e-12)  # pair by pair, some left out
        split.compare(left, left if len(left) == 500 else right, lambda a, b: (a + b) % 3 == 0)
        rest = kept & ((np.arange(500) + np.arange(500)[:, None]) % 3 != 0)
        assert split.others.tolist() == (rest @ copies).tolist()


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


# --- pipeline ---


def test_pipeline_stages(spark, tmp_path):
    draw = random.Random(12)
    prose = lambda k: " ".join("".join(draw.choices(["ka", "to", "mi", "ra", "su", "ne", "lo"], k=draw.randint(1, 5))) for _ in range(k))
    item = prose(30)
    block = "\n".join(prose(6) for _ in range(4))
    near = prose(100).split()
    edited = [*near[:50], "xyz", *near[51:]]
    texts = [prose(60) for _ in range(30)] + [
        f"{prose(20)} {item} {prose(20)}", f"{prose(30)}\n{block}", f"{prose(30)}\n{block}\n{prose(9)}", " ".join(near), " ".join(edited), None, "12 34", "",
    ]
    rows = [(i, t, "aa", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    docs = docs.withColumn("rest", F.lit("r")).withColumn("leaks", F.lit("l")).withColumn("score", F.lit(1))
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    assert set(kept[0]) == set(range(35))  # null and letterless texts go
    assert kept[1][31] == texts[31] and kept[1][32] == "\n".join(texts[32].split("\n")[i] for i in (0, 5))
    assert set(kept[2]) == set(range(34))
    assert set(kept[3]) == set(range(34)) - {30}
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(kept[3])
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_copies_do_not_enlarge_the_sample(spark, monkeypatch):
    words = {"a": "der die das und ist", "b": "the of and to in"}
    rows = [(k, " ".join(random.Random(k).choices(words[x].split(), k=30)), x) for k in range(1500) for x in "ab"]
    copies = [(10_000 + k, rows[k % 3][1], rows[k % 3][2]) for k in range(3000)]
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string, lang string").withColumn("_read_text", F.lit(1)).repartition(7)
    settings = Settings(train_rows=600, calibration_rows=150)
    sizes = []
    fit = language._fit
    monkeypatch.setattr(language, "_fit", lambda sample, *rest: sizes.append([r.role for r in sample.collect()]) or fit(sample, *rest))
    model = fit_language_model(docs, F.lit(True), settings)
    assert 450 < sizes[0].count("train") < 700 and 80 < sizes[0].count("calibrate") < 220
    assert model.predict(docs).columns == ["doc_id", "text", "lang", "_read_text", "lang_pred", "score"]


def test_seeds_are_the_bound_of_spread_edits(spark):
    """A copy with every third word replaced has no seed; with every fourth replaced it is found."""
    item = [f"word{k}" for k in range(38)]
    texts = [" ".join("x" if k % step == step - 1 else w for k, w in enumerate(item)) for step in (3, 4, 6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("_leak_text", F.lit(0))
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    found = find_leaks(docs, items)
    assert found.columns == ["doc_id", "text", "_leak_text", "leaks"]
    assert {r.doc_id for r in found.collect() if r.leaks} == {1, 2}


def test_the_pipeline_leaves_what_its_result_reads(spark):
    from pathlib import Path

    from conftest import SF

    from tabulon.session import shared_dir

    def tables():
        return {p for p in Path(shared_dir(spark)).glob("*/*") if p.is_dir()}

    before = tables()
    result = corpus_pipeline.run(spark, SF)
    left = tables() - before
    read = {Path(f.removeprefix("file:")).parent for f in result.inputFiles()}
    assert result.count() and {p.name for p in left} >= {p.name for p in read} and len(left) <= 4
