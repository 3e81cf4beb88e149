"""Words of a block of texts as numpy arrays, and hashes of runs of consecutive words.

Everything works on the UTF-8 bytes of an Arrow string column, a bounded slice of rows at a time;
no Python object is made per word. Separators are ASCII, so cutting bytes equals cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4_000_000
_SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _random(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


_BYTE = _random(256, 1_000_003)
_BASES = [pow(0x9E3779B97F4A7C15, 3, 1 << 64), pow(0xD1342543DE82EF95, 5, 1 << 64)]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_PLACES = np.empty(0, dtype=np.uint64)


def _places(n: int) -> np.ndarray:
    global _PLACES
    if len(_PLACES) < n:
        _PLACES = _random(max(n, 256), 77_777_777) | np.uint64(1)
    return _PLACES


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 20)
        base = _BASES[which]
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        have = _POWERS[which] = (made[0], made[1])
    return have


def byte_table(separators: bytes = _SPACES, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, byte to hash) for each of the 256 byte values."""
    inside = np.ones(256, dtype=bool)
    inside[list(separators)] = False
    to = np.arange(256)
    if lower:
        to[65:91] += 32
    return inside, _BYTE[to]


PLAIN = byte_table()
LOWER = byte_table(lower=True)
# every ASCII character but letters and digits separates
LOOSE = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()), lower=True)


@dataclass
class Words:
    """Words of some texts: their hashes, byte spans in ``data`` and, per text, the first word's index."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more entry than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its values in them; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or where[0] == where[-1]:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[where[0] : where[-1]], where - where[0]


def find_words(data: np.ndarray, offsets: np.ndarray, table: tuple[np.ndarray, np.ndarray] = PLAIN) -> Words:
    """Words of the texts that lie in ``data`` at ``offsets``; a word never crosses texts."""
    inside, values = table
    is_word = inside[data]
    first_byte = is_word.copy()
    first_byte[1:] &= ~is_word[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    first_byte[borders] = is_word[borders]
    starts = np.flatnonzero(first_byte)
    if not len(starts):
        none = np.empty(0, dtype=np.int64)
        return Words(data, np.empty(0, dtype=np.uint64), none, none, np.zeros(len(offsets), dtype=np.int64))
    last_byte = is_word.copy()
    last_byte[:-1] &= ~is_word[1:]
    ahead = borders[borders > 0] - 1
    last_byte[ahead] = is_word[ahead]
    ends = np.flatnonzero(last_byte) + 1
    lengths = ends - starts
    heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    at = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
    hashes = np.add.reduceat(values[data[is_word]] * _places(int(lengths.max()))[at], heads)
    return Words(data, mix(hashes + lengths.astype(np.uint64)), starts, ends, np.searchsorted(starts, offsets))


class Runs:
    """Hashes of any runs of consecutive words, each from two prefix sums."""

    def __init__(self, hashes: np.ndarray, which: int = 0):
        forward, self._back = _powers(len(hashes) + 1, which)
        self._sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * forward[: len(hashes)], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._back[start] + (end - start).astype(np.uint64))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with about ``most`` bytes of text, one row at least.

    Behind the last one Arrow gives back what it holds unused: the Python worker outlives its task.
    """
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return x.view(np.int64)


def list_column(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """List column whose rows take ``counts`` of ``values`` each."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)
