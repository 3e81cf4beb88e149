"""Training documents that hold a benchmark item, word for word, edited or paraphrased in part.

Word n-grams of the items are seeds; where a document has a rare one, or several common ones close together, the
passage around it is aligned with the item after Smith and Waterman. The items are the stated queries: they are read in blocks of bounded size, each
of which is broadcast and meets all documents where they lie, so no document is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.tables import unused
from tabulon.llm.words import LOOSE, Runs, Words, find_words, slices, text_bytes

SEED = 3  # words
LEAST_WORDS = 5
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
RARENESS = 2.0
COMMON_SEEDS = 3
BLOCK_WORDS = 2_000_000
SLICE_BYTES = 1_000_000  # of texts whose words are found at once
_BITS = 20


@dataclass
class Block:
    """Items as arrays: word hashes one after the other, and their seeds sorted by hash."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    seeds: np.ndarray  # distinct, sorted
    use_first: np.ndarray  # of a seed's uses
    use_item: np.ndarray
    use_place: np.ndarray
    use_rare: np.ndarray
    sieve: np.ndarray

    def item(self, k: int) -> np.ndarray:
        return self.words[self.first[k] : self.first[k + 1]]


def _words(texts: pa.Array) -> Words:
    return find_words(*text_bytes(pc.utf8_lower(texts)), LOOSE)


def _block(ids: list, texts: list[str], seed: int, least: int) -> Block:
    words = _words(pa.array(texts, pa.string()))
    counts = words.counts
    n = np.where(counts >= least, np.maximum(counts - seed + 1, 0), 0)
    item = np.repeat(np.arange(len(counts)), n)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = words.first[:-1][item] + place
    values = Runs(words.hashes)(start, start + seed)
    order = np.argsort(values, kind="stable")
    seeds, use_first = np.unique(values[order], return_index=True)
    sieve = np.zeros(1 << _BITS, dtype=bool)
    sieve[seeds >> np.uint64(64 - _BITS)] = True
    rare = np.ones(len(values), dtype=bool)
    return Block(ids, words.hashes, words.first, seeds, np.append(use_first, len(values)), item[order], place[order], rare, sieve)


def _found(block: Block, hashes: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Word places where a seed begins, and which seed."""
    n = len(hashes) - seed + 1
    if n <= 0 or not len(block.seeds):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.arange(n)
    grams = Runs(hashes)(start, start + seed)
    maybe = np.flatnonzero(block.sieve[grams >> np.uint64(64 - _BITS)])
    at = np.minimum(np.searchsorted(block.seeds, grams[maybe]), len(block.seeds) - 1)
    same = block.seeds[at] == grams[maybe]
    return maybe[same], at[same]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment as a share of the item's perfect score, and its words [start, end) in the passage."""
    score, end = _best(item, passage)
    if score <= 0:
        return 0.0, 0, 0
    _, back = _best(item[::-1], passage[:end][::-1])
    return score / (MATCH * len(item)), end - back, end


def _best(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    above = np.zeros(len(passage) + 1, dtype=np.int64)
    steps = -GAP * np.arange(len(passage) + 1)
    score, end = 0, 0
    for word in item:
        now = np.zeros_like(above)
        now[1:] = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISMATCH), above[1:] + GAP)
        now = np.maximum.accumulate(np.maximum(now, 0) + steps) - steps  # gaps along the passage
        k = int(now.argmax())
        if now[k] > score:
            score, end = int(now[k]), k
        above = now
    return score, end


def _passages(block: Block, words: np.ndarray, seed: int, threshold: float) -> list[dict]:
    """Items found in one document's words, the best alignment of each."""
    places, which = _found(block, words, seed)
    if not len(places):
        return []
    uses = block.use_first[which + 1] - block.use_first[which]
    use = np.repeat(block.use_first[which], uses) + np.arange(int(uses.sum())) - np.repeat(np.cumsum(uses) - uses, uses)
    item, begin = block.use_item[use], np.repeat(places, uses) - block.use_place[use]
    out = []
    for k in np.unique(item).tolist():
        own = block.item(k)
        slack = len(own) // 2 + 2
        mine = np.flatnonzero(item == k)
        mine = mine[np.argsort(begin[mine], kind="stable")]
        lows, rare, place = begin[mine] - slack, block.use_rare[use[mine]], block.use_place[use[mine]]
        opens = np.append(True, lows[1:] > lows[:-1] + len(own) + 2 * slack)
        heads = np.flatnonzero(opens)
        lasts = np.append(heads[1:], len(lows)) - 1
        best = (0.0, 0, 0)
        for head, last in zip(heads.tolist(), lasts.tolist(), strict=True):
            if not rare[head : last + 1].any() and len(set(place[head : last + 1].tolist())) < COMMON_SEEDS:
                continue
            low, high = max(0, int(lows[head])), int(lows[last]) + len(own) + 2 * slack
            score, a, b = align(own, words[low:high])
            if score > best[0]:
                best = (score, low + a, low + b)
        if best[0] >= threshold:
            out.append({"item_id": block.ids[k], "score": best[0], "start": best[1], "end": best[2]})
    return out


def _rare(docs: DataFrame, block: Block, seed: int, rareness: float) -> Block:
    """The block with its rare seeds marked: those no more frequent in the corpus than ``rareness`` times the
    median of their item's seeds that occur at all, so an item has rare seeds however often it was copied."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        total = np.zeros(len(block.seeds), dtype=np.int64)
        for batch in slices(batches, "text", SLICE_BYTES):
            words = _words(batch.column("text"))
            places, which = _found(block, words.hashes, seed)
            row = np.searchsorted(words.first, places, side="right") - 1
            inside = places + seed <= words.first[row + 1]
            pairs = np.unique(row[inside] * len(block.seeds) + which[inside])
            total += np.bincount(pairs % len(block.seeds), minlength=len(total)) if len(pairs) else 0
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["seed", "n"])

    counted = docs.select("text").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n")).collect()  # of a block
    frequency = np.zeros(len(block.seeds))
    for k, n in counted:
        frequency[k] = n
    of_use = np.repeat(np.arange(len(block.seeds)), np.diff(block.use_first))
    per_use = frequency[of_use]
    rare = np.zeros(len(per_use), dtype=bool)
    order = np.argsort(block.use_item, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(block.use_item[order])) + 1):
        met = per_use[own][per_use[own] > 0]
        if len(met):
            rare[own] = per_use[own] <= rareness * np.median(met)
    return replace(block, use_rare=rare)


def find_leaks(
    docs: DataFrame, items: DataFrame, keep: list[str] | None = None, seed: int = SEED, least_words: int = LEAST_WORDS,
    threshold: float = THRESHOLD, rareness: float = RARENESS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` and ``leaks``: item_id, score and words [start, end) of each item found.

    Words are what spaces and ASCII punctuation part, in lower case. A document leaks an item
    if an alignment scores ``threshold`` or more of a full match (2 for a match, -1 for another or a missing
    word): a third of the words may be changed, as long as three words in a row are left of them somewhere, which is a seed: an item
    with every third word replaced has none and is not found. Texts of any length are read whole. Items of fewer than ``least_words`` words tell
    nothing and are never found, nor are null ones; equal items are all found. A null or empty text leaks
    nothing. Equal rows have equal results. Without items every list is empty. A column named ``leaks`` is replaced.
    """
    keep = [c for c in (keep or docs.columns) if c != "leaks"]
    item_kind = items.schema["item_id"].dataType.simpleString()
    texts = items.where("text is not null").select("item_id", "text")
    n_words = texts.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    n_blocks = max(1, math.ceil(n_words / block_words))
    leak = f"array<struct<item_id:{item_kind},score:double,start:int,end:int>>"
    body = unused("_leak_text", keep)
    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias(body), F.lit(None).cast(leak).alias("leaks"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    for k in range(n_blocks):
        rows = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).collect()  # of bounded size
        block = _block([r.item_id for r in rows], [r.text for r in rows], seed, least_words)
        block = _rare(docs.select("text"), block, seed, rareness)
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in slices(batches, body, SLICE_BYTES):
                words = _words(batch.column(body))
                found = batch.column("leaks").to_pylist()
                places, _ = _found(block, words.hashes, seed)
                for row in np.unique(np.searchsorted(words.first, places, side="right") - 1).tolist():
                    own = _passages(block, words.hashes[words.first[row] : words.first[row + 1]], seed, threshold)
                    found[row] = (found[row] or []) + own
                kind = batch.schema.field("leaks").type
                columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array([x or [] for x in found], kind)]
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        frame = frame.mapInArrow(run, fields)
    return frame.drop(body)
