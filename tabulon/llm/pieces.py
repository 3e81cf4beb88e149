"""SentencePiece BPE by a table of last tokens per prefix.

Merges are ranked by the score of the piece they make, whatever its parts. A sequence of pieces is the encoding
of its text if each piece encodes to itself and each two neighbours are compatible: encoded together they stay
apart. So every prefix of a text has one last piece, which an automaton over the vocabulary proposes and the test
of the pair with the piece before it confirms; the ids are read off backwards from the end.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabulon.llm.words import list_column, slices

SPACE = "▁"
REMEMBERED = 1_000_000  # words whose ids are kept
SHORT = 64  # characters of a word that shares a table with others; longer ones have their own
TABLE_WORDS = 50_000
PAIRS = 2_000_000
_PIECE_BITS = 24

_ENCODERS: dict[bytes, PieceEncoder] = {}


class PieceEncoder:
    """Ids of texts under a model whose normaliser changes nothing but spaces.

    Where no piece of the vocabulary has a space behind another character, texts are parted before their
    spaces, and the ids of the parts, called words here, are remembered.
    """

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = library.vocab_size()
        self._names = names = library.id_to_piece(list(range(size)))
        self._bytes = {int(names[i][3:5], 16): i for i in range(size) if library.is_byte(i)}
        if len(self._bytes) != 256 or any(library.is_unused(i) for i in range(size)):
            raise ValueError("only models with byte fallback and without unused pieces are supported")
        if library.normalize("a  bÅﬁ ") != f"{SPACE}a{SPACE * 2}bÅﬁ{SPACE}":
            raise ValueError("only models with identity normalisation and a leading space are supported")
        pieces = [i for i in range(size) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        self._score = {names[i]: library.get_score(i) for i in pieces}
        characters = set("".join(self._score))
        if not characters <= self._score.keys():
            raise ValueError("only models whose characters are pieces themselves are supported")
        self._characters = np.sort(np.fromiter(map(ord, characters), np.uint32, len(characters)))
        self._break = next(c for c in map(chr, range(0xE000, 0xF8FF)) if c not in characters)
        self._length = np.array(list(map(len, names)))
        self._automaton = ahocorasick.Automaton()
        for i in pieces:
            self._automaton.add_word(names[i], i)
        self._automaton.make_automaton()
        inner_space = re.compile(f"[^{SPACE}]{SPACE}")
        self._parted = not any(inner_space.search(name) for name in self._score)
        self._words = re.compile(f"{SPACE}([^{SPACE}]+|{SPACE}*[^{SPACE}]*)").findall
        self._fit: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self._code: dict[str, int] = {}
        self._ids = np.empty(1 << 20, dtype=np.int32)
        self._starts = np.zeros(1 << 19, dtype=np.int64)

    def _stays(self, text: str, border: int) -> bool:
        """Whether the merges of ``text`` end with one piece on either side of ``border`` (0: with one piece)."""
        score, parts = self._score, list(text)
        starts = list(range(len(parts)))
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                value = score.get(parts[k] + parts[k + 1])
                if value is not None and (best is None or value > best):  # of equal scores the leftmost
                    best, at = value, k
            if best is None:
                break
            if starts[at + 1] == border:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del starts[at + 1]
        return starts == ([0, border] if border else [0])

    def _fits(self, key: int) -> bool:
        """Whether a piece may follow another: the two, encoded as one text, stay as they are. The piece alone, where
        nothing or a character without piece is before it, must be what its own text encodes to."""
        known = self._fit.get(key)
        if known is None:
            before, piece = key >> _PIECE_BITS, key & ((1 << _PIECE_BITS) - 1)
            if not before:
                known = self._stays(self._names[piece], 0)
            else:
                known = self._fits(piece) and self._stays(self._names[before] + self._names[piece], len(self._names[before]))
            if len(self._fit) >= PAIRS:
                self._fit.clear()
            self._fit[key] = known
        return known

    def _matches(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Every piece in ``text`` and where it ends."""
        found = np.fromiter(itertools.chain.from_iterable(self._automaton.iter(text)), np.int64).reshape(-1, 2)
        return found[:, 0] + 1, found[:, 1]

    def _alone(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The characters of ``text`` as numbers, and which of them are in no piece."""
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self._characters, points), len(self._characters) - 1)
        return points, self._characters[at] != points

    def _long_table(self, text: str) -> np.ndarray:
        """The last piece of the encoding of each prefix of ``text``; -1 for a character that is in no piece."""
        last = np.zeros(len(text) + 1, dtype=np.int32)
        last[1:][self._alone(text)[1]] = -1
        length = self._length
        for end, piece in self._automaton.iter(text):
            if not last[end + 1]:
                before = max(int(last[end + 1 - length[piece]]), 0)
                if self._fits(before << _PIECE_BITS | piece):
                    last[end + 1] = piece
        return last

    def _short_tables(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for many words at once, one row each, filled from the first character on: all prefixes of a
        length are decided together. With the words' lengths and their characters."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = self._break.join(words)
        starts = np.cumsum(lengths + 1) - lengths - 1
        points, alone = self._alone(text)
        word_of = np.repeat(np.arange(len(words)), lengths + 1)[: len(text)]
        place = np.arange(len(text)) - starts[word_of]
        inside = place < lengths[word_of]
        last = np.zeros((len(words), int(lengths.max()) + 1), dtype=np.int32)
        characters = np.zeros(last.shape, dtype=np.uint32)
        characters[word_of[inside], place[inside] + 1] = points[inside]
        alone &= inside
        last[word_of[alone], place[alone] + 1] = -1
        ends, pieces = self._matches(text)
        word = word_of[ends - 1]
        ends = ends - starts[word]
        order = np.argsort(ends, kind="stable")
        word, ends, pieces = word[order], ends[order], pieces[order]
        borders = np.searchsorted(ends, np.arange(1, last.shape[1] + 1))
        for end, (low, high) in enumerate(itertools.pairwise(borders.tolist()), 1):
            w, p = word[low:high], pieces[low:high]
            before = np.maximum(last[w, end - self._length[p]], 0).astype(np.int64)
            keys, which = np.unique(before << _PIECE_BITS | p, return_inverse=True)
            good = np.fromiter(map(self._fits, keys.tolist()), bool, len(keys))[which]
            last[w[good], end] = p[good]
        return last, lengths, characters

    def _read_back(self, last: np.ndarray, lengths: np.ndarray, characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and their numbers: from each end back to the first character."""
        word, at = np.arange(len(lengths)), lengths.copy()
        steps = []
        while len(word):
            piece = last[word, at]
            steps.append((word, piece, characters[word, at]))
            at = at - np.where(piece < 0, 1, self._length[piece])
            word, at = word[at > 0], at[at > 0]
        word, piece, point = (np.concatenate(x[::-1]) for x in zip(*steps, strict=True))
        order = np.argsort(word, kind="stable")  # later steps are nearer to the beginning and come first
        word, piece, point = word[order], piece[order], point[order]
        lone = np.unique(point[piece < 0]).tolist()
        spelt = {c: [self._bytes[b] for b in chr(c).encode()] for c in lone}
        times = np.ones(len(piece), dtype=np.int64)
        for c, ids in spelt.items():
            times[(piece < 0) & (point == c)] = len(ids)
        first = np.cumsum(times) - times
        out = np.repeat(piece, times)
        for c, ids in spelt.items():
            heads = first[(piece < 0) & (point == c)]
            for j, i in enumerate(ids):
                out[heads + j] = i
        return out, np.bincount(word, weights=times, minlength=len(lengths)).astype(np.int64)

    def _add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n = len(self._code)
        ends = self._starts[n] + np.cumsum(counts)
        while n + len(words) + 1 > len(self._starts):
            self._starts = np.concatenate((self._starts, np.zeros_like(self._starts)))
        while ends[-1] > len(self._ids):
            self._ids = np.concatenate((self._ids, np.empty_like(self._ids)))
        self._ids[self._starts[n] : ends[-1]] = ids
        self._starts[n + 1 : n + 1 + len(words)] = ends
        self._code.update(zip(words, range(n, n + len(words)), strict=True))

    def _learn(self, words: set[str]) -> None:
        short = sorted(w for w in words if len(w) < SHORT)
        for at in range(0, len(short), TABLE_WORDS):
            part = short[at : at + TABLE_WORDS]
            self._add(part, *self._read_back(*self._short_tables([SPACE + w for w in part])))
        for w in words:
            if len(w) >= SHORT:
                text = SPACE + w
                points, _ = self._alone(text)
                table = self._long_table(text)[None, :], np.array([len(text)]), np.append(np.uint32(0), points)[None, :]
                self._add([w], *self._read_back(*table))

    def _split(self, text: str | None) -> list[str]:
        """The words of a text, each without the space that begins it."""
        if not text:
            return []
        words = text.split(" ")
        if self._parted and SPACE not in text and "" not in words:
            return words
        spaced = text.replace(" ", SPACE)
        return self._words(SPACE + spaced) if self._parted else [spaced]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and their numbers."""
        words, counts = [], []
        for text in texts:
            own = self._split(text)
            words += own
            counts.append(len(own))
        if len(self._code) > REMEMBERED:
            self._forget()
        if missing := set(words).difference(self._code):
            self._learn(missing)
        codes = np.fromiter(map(self._code.__getitem__, words), np.int64, len(words))
        starts = self._starts[codes]
        lengths = self._starts[codes + 1] - starts
        ends = np.cumsum(lengths)
        flat = self._ids[np.repeat(starts - ends + lengths, lengths) + np.arange(int(lengths.sum()))]
        return flat, np.diff(np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))])


def encoder(model: bytes) -> PieceEncoder:
    if model not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model] = PieceEncoder(model)
    return _ENCODERS[model]


def encode_pieces(docs: DataFrame, model_path: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (all) of ``docs``, with ``ids`` and ``decoded``: the piece ids of each whole text, as the
    model's library gives them without begin and end ids, and the text that these ids decode to.

    Null and empty texts have no ids and decode to nothing. A text of any length is encoded in time and memory in
    proportion to it; equal rows have equal results; an empty table stays empty. Columns of ``docs`` named ``ids`` or
    ``decoded`` are replaced. The model is read by the driver (half a megabyte, or as large as the vocabulary) and broadcast. It must
    have byte fallback and leave all characters but the space as they are, or a ValueError is raised.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "decoded")]
    with open(model_path, "rb") as file:
        model = file.read()
    encoder(model)  # unsupported models fail here
    shared = docs.sparkSession.sparkContext.broadcast(model)
    numbered = {c: f"_{k}" for k, c in enumerate(keep)}
    frame = docs.select(docs[f"`{text}`"].alias("text"), *[docs[f"`{c}`"].alias(name) for c, name in numbered.items()])
    kinds = [f"{name} {docs.schema[c].dataType.simpleString()}" for c, name in numbered.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value)
        for batch in slices(batches, "text"):
            flat, counts = own.encode(batch.column("text").to_pylist())
            borders = np.cumsum(counts)[:-1]
            decoded = [own.library.decode(ids.tolist()) for ids in np.split(flat, borders)]
            columns = [batch.column(name) for name in numbered.values()]
            columns += [list_column(pa.array(flat), counts), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*numbered.values(), "ids", "decoded"])

    encoded = frame.mapInArrow(run, ", ".join([*kinds, "ids array<int>", "decoded string"]))
    return encoded.withColumnsRenamed({name: c for c, name in numbered.items()})
