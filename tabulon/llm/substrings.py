"""Removal of repeated word sequences by parsing every document against an index of all documents.

The index holds reference blocks: a short anchor, chosen by its content, with all the words that a window around
it can reach. Anchors are chosen so that equal windows have the same one at the same place; a document is parsed
block by block, and windows are compared only where anchors are. A factor runs on as long as whole
blocks repeat; at its ends, where the block as a whole is unlike any other, each window is looked up by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.tables import if_small, store, text_key
from tabulon.llm.words import Runs, find_words, list_column, mix, signed, slices, text_bytes

WINDOW = 35
ANCHOR = 8
_SPAN = "array<struct<s0:int,s1:int>>"


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value of each run of ``width`` values."""
    best, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        have += step
    return best


def _blocks(batch: pa.RecordBatch, window: int, anchor: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per text the number of its blocks; per block its first and last window, anchor and content hash."""
    words = find_words(*text_bytes(batch.column("text")))
    n, first = len(words.hashes), words.first
    reach = window - anchor  # words of a window before or behind its anchor
    if n < window:
        return np.zeros(batch.num_rows, dtype=np.int64), [np.empty(0, np.int64)] * 4
    near, far = Runs(words.hashes, 0), Runs(words.hashes, 1)
    places = np.arange(n - anchor + 1)
    grams = near(places, places + anchor)
    chosen = _leftmost_least(grams, reach + 1)
    text = words.text_of
    start = np.flatnonzero(text[: n - window + 1] == text[window - 1 :])
    if not len(start):
        return np.zeros(batch.num_rows, dtype=np.int64), [np.empty(0, np.int64)] * 4
    at, row = chosen[start], text[start]
    opens = np.ones(len(start), dtype=bool)
    opens[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(opens)
    tails = np.append(heads[1:], len(start)) - 1
    a, row = at[heads], row[heads]
    before, behind = np.minimum(reach, a - first[row]), np.minimum(window, first[row + 1] - a)
    content = mix(far(a - before, a + behind) + (before * 1_000_003 + behind).astype(np.uint64))
    own = first[row]
    return np.bincount(row, minlength=batch.num_rows), [start[heads] - own, start[tails] - own, grams[a], content]


def _index(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Reference blocks of every document, as one list for each."""
    block = "struct<s0:int,s1:int,h:long,u:long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, (s0, s1, h, u) = _blocks(batch, window, anchor)
            fields = [pa.array(s0.astype(np.int32)), pa.array(s1.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(u.view(np.int64))]
            blocks = list_column(pa.StructArray.from_arrays(fields, ["s0", "s1", "h", "u"]), counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("id", "t1", "t2")] + [blocks], names=["id", "t1", "t2", "blocks"]
            )

    t1, t2 = text_key()
    keyed = docs.select(F.monotonically_increasing_id().alias("id"), t1.alias("t1"), t2.alias("t2"), "text")
    return store(keyed.mapInArrow(run, f"id long, t1 long, t2 long, blocks array<{block}>").where("size(blocks) > 0"))


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """(id, s, weight, w1, w2): two hashes of each window that the listed blocks hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = find_words(*text_bytes(batch.column("text")))
            lists = batch.column("open")
            counts = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            s0, s1, weight = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
            row = np.repeat(np.arange(batch.num_rows), counts)
            each = s1 - s0 + 1
            which = np.repeat(np.arange(len(s0)), each)
            s = s0[which] + np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
            at = words.first[row[which]] + s
            hashes = [signed(Runs(words.hashes, k)(at, at + window)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(row[which])), pa.array(s.astype(np.int32)),
                    pa.array(weight[which].astype(np.int32)), *map(pa.array, hashes),
                ],
                names=["id", "s", "weight", "w1", "w2"],
            )

    return texts.mapInArrow(run, "id long, s int, weight int, w1 long, w2 long")


def _merged(spans: DataFrame) -> DataFrame:
    """Sort the window spans of each text and join those that touch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans in batch.column("spans").to_pylist():
                merged: list[dict] = []
                for x in sorted(spans, key=lambda x: x["s0"]):
                    if merged and x["s0"] <= merged[-1]["s1"] + 1:
                        merged[-1]["s1"] = max(merged[-1]["s1"], x["s1"])
                    else:
                        merged.append(dict(x))
                out.append(merged)
            kind = pa.list_(pa.struct([("s0", pa.int32()), ("s1", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("t1"), batch.column("t2"), pa.array(out, kind)], names=["t1", "t2", "spans"]
            )

    return spans.mapInArrow(run, f"t1 long, t2 long, spans {_SPAN}")


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(t1, t2, spans): for each text with repeated windows, by its key, the runs of their first words.

    Blocks are counted by anchor first, so that the many that occur once end there. Of blocks with one
    anchor those alike in all their words repeat as a whole. The others are compared by single windows: each kind of block
    once, however many copies it has.
    """
    index = _index(docs, window, anchor)
    blocks = index.select("id", F.explode("blocks").alias("b")).select("id", "b.*")
    shared = (
        blocks.groupBy("h").agg(F.count("*").alias("n"), F.min("u").alias("lo"), F.max("u").alias("hi")).where("n > 1")
    )
    # stored before each join: adaptive execution splits a hot key only between plain exchanges
    shared = store(shared.select("h", (F.col("lo") == F.col("hi")).alias("whole")))
    met = store(blocks.join(shared, "h"))
    kinds = store(
        met.where("not whole").groupBy("h", "u").agg(F.count("*").alias("n"), F.min(F.struct("id", "s0", "s1")).alias("one"))
    )
    ends = kinds.groupBy("h").agg(F.min("n").alias("least")).where("least = 1").select("h")
    weight = F.least("n", F.lit(2)).cast("int").alias("weight")
    to_check = (
        kinds.join(ends, "h")
        .select("one.*", weight)
        .groupBy("id")
        .agg(F.collect_list(F.struct("s0", "s1", "weight")).alias("open"))  # of one document
    )
    wanted = store(to_check.join(index.select("id", "t1", "t2"), "id"))
    t1, t2 = text_key()
    keyed = docs.select("text", t1, t2)
    texts = (
        keyed.join(if_small(wanted, 48 + 16 * F.size("open")), (F.col("_t1") == F.col("t1")) & (F.col("_t2") == F.col("t2")))
        .select("id", "text", "open")
        .dropDuplicates(["id"])
    )
    windows = store(_windows(texts, window))
    often = store(windows.groupBy("w1", "w2").agg(F.sum("weight").alias("n")).where("n > 1").select("w1", "w2"))
    single = windows.where("weight = 1").join(often, ["w1", "w2"]).select("id", F.col("s").alias("s0"), F.col("s").alias("s1"))
    in_kinds = met.where("not whole").join(kinds.where("n > 1").select("h", "u"), ["h", "u"])
    spans = met.where("whole").select("id", "s0", "s1").unionByName(in_kinds.select("id", "s0", "s1")).unionByName(single)
    per_document = spans.groupBy("id").agg(F.collect_list(F.struct("s0", "s1")).alias("spans"))
    per_text = per_document.join(index.select("id", "t1", "t2"), "id").dropDuplicates(["t1", "t2"])  # equal texts have equal spans
    return store(_merged(per_text.select("t1", "t2", "spans")))


def drop_repeated_sequences(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of each document of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII white space. Each word goes that is covered by a window of ``window`` words which
    also starts anywhere else, in the same document too; every copy goes, none is a first. ``kept``
    is the other words, joined by one space. A null text counts no words and keeps an empty text, like an empty
    one; texts shorter than a window stay. Equal rows are treated alike, each has its own result.
    """
    docs = docs.select("doc_id", "text")
    found = repeated_windows(docs, window, anchor)
    t1, t2 = text_key()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            n_words, n_removed, digests, texts = [], [], [], []
            for a, b, spans in zip(offsets[:-1], offsets[1:], batch.column("spans").to_pylist(), strict=True):
                words = raw[a:b].split()
                kept: list[bytes] = []
                at = 0
                for span in spans or ():
                    kept += words[at : max(at, span["s0"])]
                    at = max(at, span["s1"] + window)
                kept += words[at:]
                text = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(text).hexdigest())
                texts.append(text.decode())
            columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            )

    keyed = docs.select("doc_id", "text", t1, t2)
    joined = keyed.join(if_small(found, 48 + 16 * F.size("spans")), (F.col("_t1") == F.col("t1")) & (F.col("_t2") == F.col("t2")), "left")
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept string"
    return joined.select("doc_id", "text", "spans").mapInArrow(run, schema)
