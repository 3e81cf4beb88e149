"""Operators on documents against brute force, with nulls, empty tables, ties, repeated rows and odd columns."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabulon.llm.components import components
from tabulon.llm.line_windows import drop_repeated_windows
from tabulon.llm.personal_data import sanitise, span_list
from tabulon.llm.sharding import shard_contiguous, text_size
from tabulon.llm import shingle_join
from tabulon.llm.shingle_join import similar_groups
from tabulon.llm.substrings import drop_repeated_sequences

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def vocabulary(n=400, seed=5):
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdeéß") for _ in range(draw.randint(1, 7))) for _ in range(n)]


def corpus(seed=1, n=120):
    """Prose with exact copies, near copies, passages that documents share, one word over and over, nulls."""
    draw, names = random.Random(seed), vocabulary()
    shared = [" ".join(draw.choices(names, k=50)) for _ in range(4)]
    texts = []
    for i in range(n):
        words = draw.choices(names, k=draw.choice([0, 1, 3, 5, 9, 60, 200]))
        text = " ".join(words)
        if i % 5 == 1 and texts:
            text = draw.choice(texts) or ""
        elif i % 5 == 2 and texts:
            words = (draw.choice(texts) or "").split()
            for _ in range(min(2, len(words))):
                words[draw.randrange(len(words))] = draw.choice(names)
            text = "\t".join(words)
        elif i % 5 == 3:
            text = f"{text}\n{draw.choice(shared)}\x0b{' '.join(draw.choices(names, k=20))}"
        texts.append(text)
    texts += [None, None, "", "  \n", "x", "x " * 300, "x " * 300, "Y X", "y x"]
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def words_of(text):
    return WORDS.findall(text or "")


# --- substrings ---


def brute_substrings(texts, window):
    listed = [words_of(t) for t in texts]
    seen = collections.Counter(tuple(w[i : i + window]) for w in listed for i in range(len(w) - window + 1))
    out = []
    for w in listed:
        gone = {i + j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest(), " ".join(kept)))
    return out


@pytest.mark.parametrize(("window", "anchor"), [(35, 8), (9, 9)])
def test_substrings(spark, window, anchor):
    rows = corpus()
    got = {r[0]: tuple(r[1:]) for r in drop_repeated_sequences(frame(spark, rows), window, anchor).collect()}
    want = brute_substrings([t for _, t in rows], window)
    assert got == {i: w for (i, _), w in zip(rows, want, strict=True)}
    assert any(w[1] for w in want)


def test_substrings_odd_tables(spark):
    assert drop_repeated_sequences(frame(spark, [])).collect() == []
    long = " ".join(vocabulary(60))
    rows = [(None, long), (None, long), (3, None), (3, "a b")]
    wide = frame(spark, rows).withColumn("spans", F.lit(1)).withColumn("kept", F.lit("k")).withColumn("_t1", F.lit(0))
    got = sorted((r.doc_id is None, r.n_words, r.n_removed, r.kept) for r in drop_repeated_sequences(wide).collect())
    assert got == [(False, 0, 0, ""), (False, 2, 0, "a b"), (True, 60, 60, ""), (True, 60, 60, "")]


# --- shingle join ---


def brute_groups(rows, width=5):
    low = {c: c + 32 for c in range(65, 91)}
    sets = []
    for _, text in rows:
        w = words_of((text or "").translate(low))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= 80 * len(a | sets[j]):
                p, q = top(i), top(j)
                group[max(p, q)] = min(p, q)
    return {rows[i][0]: (len(s), rows[top(i)][0]) for i, s in enumerate(sets)}


@pytest.mark.parametrize(("seed", "crowd"), [(1, 256), (2, 2), (3, 5)])
def test_similar_groups(spark, seed, crowd):
    rows = corpus(seed, 100)
    draw, names = random.Random(seed), vocabulary()
    base = draw.choices(names, k=30)
    for k in range(25):  # near copies around the border, of which many only link by way of others
        words = list(base)
        for _ in range(draw.randint(0, 2)):
            words[draw.randrange(len(words))] = draw.choice(names)
        rows.append((500 + k, " ".join(words)))
    for k in range(25):  # short texts, which enumerate pairs of tokens
        rows.append((600 + k, " ".join(base[: draw.randint(4, 12)])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(frame(spark, rows), crowd=crowd).collect()}
    assert got == brute_groups(rows)


def test_similar_groups_odd_tables(spark):
    assert similar_groups(frame(spark, [])).collect() == []
    text = " ".join(vocabulary(20))
    rows = [(4, text), (4, text), (None, text), (None, "q r"), (9, None), (9, "")]
    wide = frame(spark, rows).withColumn("n", F.lit(1)).withColumn("component", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id or -1) for r in similar_groups(wide).collect())
    assert got == [(-1, 1, -1), (-1, 16, 4), (4, 16, 4), (4, 16, 4), (9, 0, 9), (9, 0, 9)]


def test_components(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]  # a chain and a star
    edges += [(draw.randrange(2000, 2400), draw.randrange(2000, 2400)) for _ in range(250)]
    group: dict[int, int] = {}

    def top(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = top(a), top(b)
            group[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in group}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- line windows ---


def brute_lines(rows, width=3):
    windows = collections.defaultdict(list)
    for doc, text in rows:
        lines = (text or "").split("\n")
        full = [i for i, x in enumerate(lines) if x.strip()]
        for k in range(len(full) - width + 1):
            at = full[k : k + width]
            windows[tuple(lines[i] for i in at)].append((doc, at))
    gone = collections.defaultdict(set)
    for places in windows.values():
        for doc, at in sorted(places)[1:]:
            gone[doc].update(at)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone[doc])
        out[doc] = (kept, 0 if text is None else len(lines), len(gone[doc]))
    return out


def test_line_windows(spark):
    draw = random.Random(2)
    lines = [" ".join(draw.choices(vocabulary(), k=3)) for _ in range(30)] + ["", " ", "\t"]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.choice([1, 2, 3, 6, 30])))) for i in range(60)]
    rows += [(60, rows[7][1]), (61, None), (62, ""), (63, "a\na\na\na\na\na"), (64, "\n\n\n\n"), (65, "a\na\na")]
    wide = frame(spark, rows).withColumn("n_lines", F.lit("x")).withColumn("gone", F.lit(1)).withColumn("id", F.lit(0))
    out = drop_repeated_windows(wide)
    assert out.columns == ["doc_id", "text", "gone", "id", "n_lines", "n_removed"]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out.collect()}
    assert got == brute_lines(rows)
    assert drop_repeated_windows(frame(spark, [])).collect() == []


def test_line_windows_repeated_rows(spark):
    rows = [(1, "a\nb\nc\nd")] * 3 + [(None, "x\ny\nz"), (None, "x\ny\nz")]
    got = sorted((r.doc_id or 0, r.text, r.n_removed) for r in drop_repeated_windows(frame(spark, rows)).collect())
    assert got == [(0, "", 3), (0, "x\ny\nz", 0), (1, "", 4), (1, "", 4), (1, "a\nb\nc\nd", 0)]


# --- shards ---


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards(spark, shards):
    rows = corpus(4, 300) + [(None, "n"), (None, "n")]
    given = frame(spark, rows).repartition(5).withColumn("shard", F.lit("old")).withColumn("id", F.lit(1))
    got = shard_contiguous(given, text_size(), shards).collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(rows)
    assert all(r.size == len((r.text or "").encode()) + 16 for r in got)
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    of_shard = collections.defaultdict(list)
    for r in got:
        of_shard[r.shard].append(r)
    assert set(of_shard) <= set(range(shards))
    for own in of_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= largest
    assert shard_contiguous(frame(spark, []), text_size(), 3).collect() == []


# --- personal data ---

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_base_spans(spark):
    draw = random.Random(6)
    pieces = ["a.b@c.de", "x@y", "@q.r", "a@b.c@d.e", "m@n.com_x@y.zz", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.255",
              "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "+49 (30) 123.45-67 8", "+1", "+12345678901234567", "é",
              "word", " ", " ", "\n", "-", ".", "12", "9999999999999999999999", "a-b.c-d@e-f.g-h.", "😀", "x" * 40, "%+@-._"]
    rows = [(i, "".join(draw.choices(pieces, k=draw.randint(1, 14)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "1" * 50_000), (303, "a.b" * 20_000 + "@c.d"), (304, "a@" + "b." * 20_000 + "c")]
    wide = frame(spark, rows).withColumn("base", F.lit(1)).withColumn("row", F.lit(2)).withColumn("kind", F.lit("k"))
    got = {r.doc_id: r.base for r in sanitise(wide).select("doc_id", span_list("base").alias("base")).collect()}
    assert got == {i: brute_spans(t) for i, t in rows}
    assert sanitise(frame(spark, [])).collect() == []


def test_terms_that_disclose(spark):
    filler = vocabulary(300, 9)
    draw = random.Random(1)
    rows = [(i, " ".join(x for x in draw.choices(filler, k=30))) for i in range(200)]
    rows += [(200, "the baker Zorquil has jo@x.org now"), (201, "ask Zorquil the man jo@x.org at once"), (202, "the man has the shop")]
    rows += [(203, "the man"), (204, "ask the man"), (205, "the man once"), (206, None)]
    got = {r.doc_id: r for r in sanitise(frame(spark, rows)).collect()}
    assert [s.kind for s in got[200].spans] == ["term", "email"]
    start, end = got[200].spans[0].start, got[200].spans[0].end
    assert rows[200][1][start:end] == "Zorquil"
    assert got[200].clean_text == "the baker  has <EMAIL> now"
    assert got[202].spans == [] and got[202].clean_text == rows[202][1]
    assert got[206].clean_text is None and got[206].n_email == 0


def letters(copies=1):
    draw, filler = random.Random(1), vocabulary(300, 9)
    texts = [" ".join(draw.choices(filler, k=30)) for _ in range(200)]
    far = " " + " ".join(filler[:60]) + "\n"
    both = [f"Dear Zorquil\n{far}write to jo@x.org, Zorquil", f"Li and Zorquil were here{far * 3}jo@x.org, or ask Li"]
    return texts + [t for t in both for _ in range(copies)] + ["or ask here", "were and dear", "to ask, write or were here", "and to dear"]


@pytest.mark.parametrize("copies", [1, 10, 200])
def test_terms_disclose_over_whole_texts_whatever_their_copies(spark, copies):
    rows = list(enumerate(letters(copies)))
    got = {r.doc_id: r for r in sanitise(frame(spark, rows)).collect()}
    for i, text in rows:
        # Zorquil is in both letters, Li in one of them
        want = [(m.start(), m.end(), "") for m in re.finditer("Zorquil", text)] if "@" in text else []
        assert [(s.start, s.end, s.tag) for s in got[i].spans if s.kind == "term"] == want
        assert "Zorquil" not in got[i].clean_text


def test_short_words_disclose_and_repeats_in_one_text_do_not(spark):
    texts = [*letters()[:200], "Wu has wu@x.org", "from W\nwu@x.org, says Wu", "kim@x.org for Kop\nkim@x.org by Kop\nkim@x.org of Kop"]
    got = {r.doc_id: r.clean_text for r in sanitise(frame(spark, list(enumerate(texts)))).collect()}
    assert [got[i] for i in (200, 201)] == [" has <EMAIL>", "from W\n<EMAIL>, says "]
    assert got[202] == texts[202].replace("kim@x.org", "<EMAIL>")


def test_components_survive_ties(spark):
    got = components(spark.createDataFrame([(1, 1), (2, 3), (3, 2), (2, 3)], "a long, b long")).collect()
    assert sorted(map(tuple, got)) == [(2, 2), (3, 2)]


def test_small_near_copies_write_few_keys(spark):
    # a crowd of sets of 55 shingles, each with 13 tokens of which the others have 12
    tokens = F.concat(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda x: x.cast("long")), F.array(F.col("id") + 1000))
    classes = spark.range(300).select(F.col("id").alias("c"), F.lit(55).cast("long").alias("n"), tokens.alias("tokens"))
    border = shingle_join.boundary(classes)
    assert shingle_join._keys(classes, border).count() <= 300 * 13


def test_keys_are_counted_by_nothing_but_the_key(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(shingle_join, "store", lambda df, store=shingle_join.store: stored.append(df.columns) or store(df))
    texts = [(k, " ".join(f"w{(k // 2) * 50 + j}" for j in range(40)) + f" x{k}") for k in range(12)]
    got = {r.doc_id: r.component_id for r in similar_groups(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {k: k // 2 * 2 for k in range(12)}
    assert stored.count(["key"]) == shingle_join.PARTS and not any("p" in columns for columns in stored)


def test_a_block_of_large_sets_is_compared_in_bounded_memory():
    rng, m = np.random.default_rng(3), 400
    sketch = rng.integers(-(1 << 15), 1 << 15, (m, 300)).astype(np.int16)
    sketch[1::2] = sketch[::2]  # pairs of equal sets
    same = {"n": 300, "most": 300, "g": 0, "size": 2 * m, "last": 0, "p": 61, "own": 0, "other": 0, "key": 7}
    table = {k: np.full(m, v, dtype=np.int64) for k, v in same.items()} | {"c": np.arange(m), "late": np.zeros(m, dtype=bool)}
    table["g"] = np.arange(m)
    lists = {"k": pa.array(list(sketch)), "tokens": pa.array([[7]] * m, pa.list_(pa.int64())), "block": pa.array(["0,0"] * m)}
    table = pa.table({k: pa.array(v) for k, v in table.items()} | lists)
    tracemalloc.start()
    try:
        found = [tuple(x.values()) for b in shingle_join._survivors(table, 256, False) for x in b.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sorted(found) == [(k, k + 1) for k in range(0, m, 2)]
    assert peak < 50_000_000
