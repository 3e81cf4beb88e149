"""Packing of tokenised documents into sequences of a fixed number of tokens.

The lengths of the pieces, at most ``capacity`` different ones, are counted in Spark. Bin completion runs on
those counts, whose number does not grow with the data, and gives patterns of lengths with the number of
sequences of each. Every piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.tables import if_small, store
from tabulon.llm.words import slices, text_bytes

CAPACITY = 2048
CACHED_WORDS = 1_000_000
SLICE_BYTES = 1_000_000  # of texts that are encoded at once
NODES = 400
WIDTH = 6
_STOPS = b".,;:!?"

_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Token ids of texts whose tokenizer never joins what white space parts: words are encoded once
    and remembered (up to ``CACHED_WORDS``, then anew) until ``forget`` is called."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        names = self._tokenizer.get_vocab()
        self._ends_word = np.zeros(max(names.values()) + 1, dtype=bool)
        self._ends_word[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self._code: dict[bytes, int] = {}
        self._ids = np.empty(1 << 21, dtype=np.uint32)
        self._starts = np.zeros(1 << 19, dtype=np.int64)

    def _add(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self._code)
        ends = self._starts[n] + np.cumsum(lengths)
        while n + len(words) + 1 > len(self._starts):
            self._starts = np.concatenate((self._starts, np.zeros_like(self._starts)))
        while ends[-1] > len(self._ids):
            self._ids = np.concatenate((self._ids, np.empty_like(self._ids)))
        self._ids[self._starts[n] : ends[-1]] = ids
        self._starts[n + 1 : n + 1 + len(words)] = ends
        self._code.update(zip(words, range(n, n + len(words)), strict=True))

    def _add_each(self, words: list[bytes]) -> None:
        coded = self._tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        ids = [e.ids for e in coded]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self._add(words, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths)

    def _add_letters(self, runs: list[bytes]) -> None:
        """Runs of letters, encoded many in one text and parted again where a token ends a word."""
        for at in range(0, len(runs), 1024):
            part = runs[at : at + 1024]
            coded = self._tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)
            ids = np.array(coded[0].ids, dtype=np.int64)
            ends = np.flatnonzero(self._ends_word[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                self._add(part, ids, np.diff(ends, prepend=0))
            else:
                self._add_each(part)

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after the other, and their numbers."""
        starts = self._starts[codes]
        lengths = self._starts[codes + 1] - starts
        heads = np.cumsum(lengths) - lengths
        return self._ids[np.repeat(starts - heads, lengths) + np.arange(int(lengths.sum()))], lengths

    def _learn(self, words: set[bytes]) -> None:
        """Most words are letters that some stops may follow; these two are encoded apart, as the
        tokenizer parts them too, and put together. Other words are encoded as they are."""
        plain, joined, other = set(), [], []
        for word in words:
            run = word.rstrip(_STOPS)
            if not run.isalpha() and not (run and max(letters := run.decode()) <= "\u00ff" and letters.isalpha()):
                other.append(word)
            else:
                plain.add(run)
                if len(run) != len(word):
                    joined.append((word, run, word[len(run) :]))
        other += {tail for _, _, tail in joined}.difference(words)
        if fresh := [w for w in plain if w not in self._code]:
            self._add_letters(fresh)
        if fresh := [w for w in other if w not in self._code]:
            self._add_each(fresh)
        if joined:
            code = self._code.__getitem__
            pairs = np.array([(code(run), code(tail)) for _, run, tail in joined], dtype=np.int64)
            ids, lengths = self._gather(pairs.ravel())
            self._add([w for w, _, _ in joined], ids, lengths.reshape(-1, 2).sum(axis=1))

    def __call__(self, texts: list[bytes], end: int) -> list[np.ndarray]:
        """The ids of each text, with ``end`` behind them."""
        words: list[bytes] = []
        counts = []
        for text in texts:
            # a special token is only known in its own spelling
            own = (text if b"<|" in text else text.lower()).split()
            words += own
            counts.append(len(own))
        if len(self._code) > CACHED_WORDS:
            self.forget()
        missing = set(words).difference(self._code)
        if missing:
            self._learn(missing)
        flat, lengths = self._gather(np.fromiter(map(self._code.__getitem__, words), np.int64, len(words)))
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(counts)]
        out, at = [], 0
        for to in ends:
            ids = np.empty(to - at + 1, dtype=np.uint32)
            ids[:-1] = flat[at:to]
            ids[-1] = end
            out.append(ids)
            at = to
        return out


def _encoder(path: str) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(
    docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, end: int = 0, keep_ids: bool = False
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, part, rank[, ids]) of every document.

    A document is its ids and ``end``; a longer one than ``capacity`` is cut into pieces of that
    length, the last may be shorter. ``rank`` numbers the pieces of one length within task ``part``.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in slices(batches, "text", SLICE_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            coded = encode([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], end)
            rows, piece, start, length, crc, rank, ids = [], [], [], [], [], [], []
            for row, own in enumerate(coded):
                for k, at in enumerate(range(0, len(own), capacity)):
                    cut = own[at : at + capacity]
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(len(cut))
                    crc.append(zlib.crc32(cut.astype("<u4").tobytes()))
                    rank.append(seen[len(cut)])
                    seen[len(cut)] += 1
                    if keep_ids:
                        ids.append(cut.astype(np.int32))
            columns = [
                batch.column("key").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(rows), pa.int32()), pa.array(rank, pa.int64()),
            ]
            names = [key, "piece", "start", "length", "ids_crc32", "part", "rank"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
        encode.forget()  # later stages, in which this worker waits or works on, need the memory

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long" + ", ids array<int>" * keep_ids
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(pieces, schema)


# --- bin completion ---


def _best_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Best-fit decreasing on counted lengths: patterns and how often each is used."""
    open_bins: dict[int, list[tuple[list[int], int]]] = {}
    rests = np.zeros(capacity + 1, dtype=bool)  # rests for which there are bins
    done = []
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            fits = np.flatnonzero(rests[size:])
            if not len(fits):
                each = capacity // size
                take, rest = [size] * each, capacity - each * size
                full, tail = divmod(left, each)
                new = [(take, full, rest), ([size] * tail, 1, capacity - tail * size)]
                for pattern, times, rest in new:
                    if pattern and times:
                        open_bins.setdefault(rest, []).append((pattern, times))
                        rests[rest] = True
                left = 0
                continue
            rest = size + int(fits[0])
            pattern, times = open_bins[rest].pop()
            each = rest // size
            full = min(times, left // each)
            moved = [(pattern + [size] * each, full, rest - each * size)]
            if not full:
                moved = [(pattern + [size] * left, 1, rest - left * size)]
                full, left = 1, 0
            else:
                left -= full * each
            if times > full:
                open_bins[rest].append((pattern, times - full))
            if not open_bins[rest]:
                del open_bins[rest]
                rests[rest] = False
            for p, n, r in moved:
                open_bins.setdefault(r, []).append((p, n))
                rests[r] = True
    for bins in open_bins.values():
        done += bins
    return done


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Martello and Toth's bound: no packing uses fewer sequences."""
    sizes = np.arange(capacity + 1)
    number, volume = np.cumsum(counts[::-1])[::-1], np.cumsum((counts * sizes)[::-1])[::-1]
    best = math.ceil(int(volume[0]) / capacity)
    k = np.flatnonzero(counts[: capacity // 2 + 1])
    k = k[k > 0]
    if len(k):
        number, volume = np.append(number, 0), np.append(volume, 0)  # of lengths i and more
        half = capacity // 2 + 1
        large = number[capacity - k + 1]
        middle_n, middle_v = number[half] - large, volume[half] - volume[capacity - k + 1]
        spare = volume[k] - volume[half] - (middle_n * capacity - middle_v)
        best = max(best, int((large + middle_n + np.maximum(0, -(-spare // capacity))).max()))
    return best


def _dominated(filling: list[int], waste: int, counts: np.ndarray) -> bool:
    """A length in stock can take the place of one or several of the filling's and waste less."""
    sums = {0: 0}
    for size in filling:
        sums |= {s + size: n + 1 for s, n in sums.items()}
    for s, n in sums.items():
        if n and (counts[s + 1 : s + waste + 1].any() or n > 1 and s < len(counts) and counts[s] > filling.count(s)):
            return True
    return False


def _fillings(room: int, counts: np.ndarray, most_waste: int, width: int) -> list[list[int]]:
    """Undominated fillings of ``room`` that waste no more than allowed, the best first.

    Lengths are tried from the largest down, each after the last one taken, and a branch ends where
    what remains in stock cannot bring its waste under the bound; ``width`` fillings end the search.
    """
    if room == 0:
        return [[]]
    if counts[room]:
        return [[room]]  # an exact fit dominates all others
    found: list[tuple[int, int, list[int]]] = []
    steps = [0]

    def search(rest: int, last: int, taken: list[int]) -> None:
        steps[0] += 1
        sizes = np.flatnonzero(counts[1 : min(rest, last) + 1]) + 1
        if taken and counts[1 : rest + 1].any() == False or not len(sizes):  # noqa: E712
            if rest <= most_waste and not _dominated(taken, rest, left):
                found.append((rest, len(taken), list(taken)))
            return
        for size in sizes[::-1].tolist():
            if len(found) >= width or steps[0] > 40 * width:
                return
            if left[size]:
                left[size] -= 1
                counts[size] -= 1
                search(rest - size, size, [*taken, size])
                counts[size] += 1
                left[size] += 1

    left = counts.copy()
    search(room, room, [])
    found.sort()
    return [f for _, _, f in found]


def bin_completion(
    counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES, width: int = WIDTH
) -> list[tuple[list[int], int]]:
    """Patterns of lengths and how often each is used, so that all counted lengths are used up.

    Branch and bound: the largest length left is completed by each undominated filling, many equal
    sequences in one step; a branch ends when its waste, or the lower bound of what is left, reaches
    the best packing known. The best-fit packing is the first incumbent; what is left at a node is also
    packed by best fit, which may give a better one. Ends at the lower bound or after ``nodes`` nodes.
    """
    counts = np.asarray(counts, dtype=np.int64).copy()
    best = _best_fit(counts, capacity)
    best_n = sum(n for _, n in best)
    least = lower_bound(counts, capacity)
    total = int((counts * np.arange(len(counts))).sum())
    stack: list[tuple[np.ndarray, list[tuple[list[int], int]], int, int]] = [(counts, [], 0, 0)]
    visited = 0
    while stack and best_n > least and visited < nodes:
        left, used, n_used, waste = stack.pop()
        visited += 1
        if n_used + lower_bound(left, capacity) >= best_n:
            continue
        if visited % 16 == 1:
            tail = _best_fit(left, capacity)
            if n_used + sum(n for _, n in tail) < best_n:
                best, best_n = used + tail, n_used + sum(n for _, n in tail)
        sizes = np.flatnonzero(left)
        if not len(sizes):
            best, best_n = used, n_used
            continue
        largest = int(sizes[-1])
        allowed = (best_n - 1) * capacity - total - waste
        stock = left.copy()
        stock[largest] -= 1
        branches = []
        for filling in _fillings(capacity - largest, stock, allowed, width):
            pattern = [largest, *filling]
            rest = capacity - sum(pattern)
            need = np.bincount(pattern, minlength=len(left))
            some = need > 0
            times = int((left[some] // need[some]).min())
            if rest:
                times = min(times, max(1, allowed // rest))
            branches.append((left - need * times, [*used, (pattern, times)], n_used + times, waste + rest * times))
        stack += reversed(branches)  # the best filling is followed first
    return best


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES, width: int = WIDTH) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset`` in place of ``part`` and ``rank``."""
    stored = store(pieces)
    by_part = stored.groupBy("part", "length").agg(F.count("*").alias("n"))
    by_part = store(by_part)
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in by_part.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` lengths
        counts[length] = n
    bases, sequences, offsets, keys = np.zeros(capacity + 1, dtype=np.int64), [], [], []
    first = 0
    for pattern, times in bin_completion(counts, capacity, nodes, width):
        at = 0
        for length in pattern:
            keys.append((length << 48) + int(bases[length]))
            sequences.append(first - int(bases[length]))
            offsets.append(at)
            bases[length] += times
            at += length
        first += times
    order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    table = [np.array(x, dtype=np.int64)[order] for x in (keys, sequences, offsets)]
    # one entry per pattern and length in it; each step of the search uses up a length
    plan = pieces.sparkSession.sparkContext.broadcast(table)
    over = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("part", "length", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("first"))
    names = [c for c in stored.columns if c not in ("part", "rank")]
    ranked = stored.join(if_small(store(starts), 40), ["part", "length"]).select(
        *names, (F.col("rank") + F.col("first")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, offsets = plan.value
        for batch in batches:
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            columns = [batch.column(c) for c in names] + [pa.array(rank + sequences[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema if f.name in names)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Each piece of each document with its sequence and its place there.

    A null or empty text is a document of the end id alone. Documents are packed row by row, so equal rows
    and null or repeated keys are packed as often as they occur. An empty table gives no pieces.
    """
    return pack(token_pieces(docs, tokenizer, capacity=capacity, keep_ids=keep_ids), capacity)
