"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from every document that may be learnt from. The weights are fitted by
follow-the-regularised-leader with elastic-net penalties on a bounded sample of them, spread over tasks
whose states are averaged after each epoch; the temperature is fitted on other sampled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.tables import store, unused
from tabulon.session import scratch_tables
from tabulon.llm.words import text_bytes

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    features: int = 1 << 15
    longest: int = 3  # characters in an n-gram
    train_rows: int = 4096  # sampled for the fit, in equal parts for each language
    calibration_rows: int = 1024
    epochs: int = 3
    tasks: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.02


_TABLES: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _TABLES:
        _TABLES.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _TABLES[0]


_STEPS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


def ngram_counts(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashed n-grams of a whole text and their counts; None if it has no letter.

    Letters are lower-cased; any other run of characters is one space.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    known = _letters()[codes]
    if not known.any():
        return None
    codes = np.where(known, codes, np.uint32(32))
    keep = known.copy()
    keep[1:] |= known[:-1]
    codes = np.concatenate((codes[:0], np.array([32], np.uint32), codes[keep], np.array([32], np.uint32)))
    shift = np.uint32(32 - (settings.features - 1).bit_length())
    total = np.zeros(settings.features, dtype=np.int64)
    running = np.zeros(len(codes), dtype=np.uint32)
    for n in range(min(settings.longest, len(codes))):
        running = running[: len(codes) - n] * np.uint32(0x01000193) + codes[n:]
        mixed = (running ^ (running >> np.uint32(15))) * np.uint32(_STEPS[n % len(_STEPS)])
        total += np.bincount(mixed >> shift, minlength=settings.features)
    index = np.flatnonzero(total)
    return index, total[index]


def _weigh(index: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1.0 + np.log(counts)) * idf[index]
    return values / max(np.linalg.norm(values), 1e-12)


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    data, offsets = text_bytes(batch.column("text"))
    raw = data.tobytes()
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield raw[a:b].decode()


@dataclass
class LanguageModel:
    """Fitted weights; ``labels`` is empty if there was nothing to learn from."""

    settings: Settings
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x labels
    temperature: float

    def predict(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """The documents with ``lang_pred`` and ``score``, the calibrated probability of that language.

        Reads nothing but the whole text. A null text, one without a letter, or any text where no
        language was learnt is ``und`` with score 0; of equal probabilities the first label wins.
        """
        session = docs.sparkSession
        shared = session.sparkContext.broadcast((self.labels, self.idf, self.weights, self.temperature))
        settings, names = self.settings, [c for c in docs.columns if c not in ("lang_pred", "score")]
        whole = unused("_read_text", names)
        frame = docs.select(*[F.col(f"`{c}`") for c in names], F.col(text).alias(whole))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            labels, idf, weights, temperature = shared.value
            for batch in batches:
                found, scores = [], []
                for body in _texts(pa.RecordBatch.from_arrays([batch.column(whole)], names=["text"])):
                    grams = ngram_counts(body, settings) if labels else None
                    if grams is None:
                        found.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    logits = _weigh(*grams, idf) @ weights[grams[0]] / temperature
                    p = np.exp(logits - logits.max())
                    k = int(p.argmax())
                    found.append(labels[k])
                    scores.append(float(p[k] / p.sum()))
                columns = [batch.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                    names=[*names, "lang_pred", "score"],
                )

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != whole)
        return frame.mapInArrow(run, f"{fields}, lang_pred string, score double")


def _gather(learnable: DataFrame, settings: Settings) -> DataFrame:
    """One row per n-gram and task with its document count, one row per sampled document."""
    schema = "feature int, df long, n long, role string, lang string, id long, index binary, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n, taken = np.zeros(settings.features, dtype=np.int64), 0, set()  # taken: at most the sample
        names = ["feature", "df", "n", "role", "lang", "id", "index", "counts"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary()]

        def rows(columns: list, size: int) -> pa.RecordBatch:
            full = [pa.nulls(size, k) if c is None else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(full, names=names)

        for batch in batches:
            roles, langs, ids = (batch.column(c).to_pylist() for c in ("role", "lang", "id"))
            kept = []
            for row, body in enumerate(_texts(batch)):
                grams = ngram_counts(body, settings)
                if grams is None:
                    continue
                n += 1
                seen[grams[0]] += 1
                if roles[row] and ids[row] not in taken:
                    taken.add(ids[row])
                    kept.append((roles[row], langs[row], ids[row], grams[0].astype(np.int32).tobytes(), grams[1].astype(np.int32).tobytes()))
            if kept:
                yield rows([None, None, None, *map(list, zip(*kept, strict=True))], len(kept))
        some = np.flatnonzero(seen)
        yield rows([np.append(some, -1), np.append(seen[some], n), None, None, None, None, None, None], len(some) + 1)

    return learnable.select("text", "role", "lang", "id").mapInArrow(run, schema)


def _softmax(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def _leader(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """Weights that minimise the linearised losses so far plus the elastic net."""
    return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def _fit(sample: DataFrame, labels: list[str], idf: np.ndarray, s: Settings) -> np.ndarray:
    context = sample.sparkSession.sparkContext
    code = {x: k for k, x in enumerate(labels)}
    z, n = np.zeros((2, s.features, len(labels)))
    spread = sample.where("role = 'train'").repartition(s.tasks, F.pmod("id", F.lit(s.tasks)))
    for epoch in range(s.epochs):
        shared = context.broadcast((z.astype(np.float32), n.astype(np.float32), idf, code))

        def learn(frames: Iterator[pd.DataFrame], shared=shared, epoch=epoch) -> Iterator[pd.DataFrame]:
            z, n, idf, code = shared.value
            z, n, rows = z.astype(np.float64), n.astype(np.float64), 0
            for frame in frames:
                for _, r in frame.sort_values("id", ascending=epoch % 2 == 0).iterrows():
                    at = np.frombuffer(r["index"], np.int32)
                    x = _weigh(at, np.frombuffer(r["counts"], np.int32), idf)
                    weights = _leader(z[at], n[at], s)
                    error = _softmax(x @ weights)
                    error[code[r["lang"]]] -= 1.0
                    g = x[:, None] * error
                    root = np.sqrt(n[at])
                    n[at] += g * g
                    z[at] += g - (np.sqrt(n[at]) - root) / s.alpha * weights
                    rows += 1
            if rows:
                yield pd.DataFrame({"rows": [rows], "z": [z.astype(np.float32).tobytes()], "n": [n.astype(np.float32).tobytes()]})

        states = spread.mapInPandas(learn, "rows long, z binary, n binary").collect()  # one state per task
        if not states:
            break
        total = sum(r.rows for r in states)
        z, n = np.zeros_like(z), np.zeros_like(n)
        for r in states:
            z += np.frombuffer(r.z, np.float32).reshape(z.shape) * (r.rows / total)
            n += np.frombuffer(r.n, np.float32).reshape(n.shape) * (r.rows / total)
    return _leader(z, n, s)


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """Golden-section search for the temperature of the least log loss."""
    if not len(truth):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        return -float(np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean())

    low, high, ratio = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_language_model(
    docs: DataFrame, learn_from: Column, settings: Settings = Settings(), text: str = "text", lang: str = "lang"
) -> LanguageModel:
    """Fit on the documents where ``learn_from`` holds and text and language are known.

    Document frequencies count all of those. The fit takes about ``train_rows`` different texts of them and the
    calibration ``calibration_rows`` others, chosen by a hash of the text so that each language has an equal part
    of the sample, all its texts if it has fewer; of copies one is taken. Neither depends on how the rows are stored. Texts of any length are
    read whole. ("About" as a language's different texts are counted by a sketch, to some two per cent, and chosen by chance.)
    """
    with scratch_tables(docs.sparkSession):
        body, label = F.col(text), F.col(lang)
        known = docs.where(learn_from & body.isNotNull() & label.isNotNull()).select(body.alias("text"), label.alias("lang"))
        sizes = known.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64(F.lit(11), "text"), 0.02).alias("size"))
        sizes = store(sizes)
        n_labels = sizes.count()
        if not n_labels:
            return LanguageModel(settings, [], np.zeros(settings.features), np.zeros((settings.features, 0)), 1.0)
        each = (settings.train_rows + settings.calibration_rows) / n_labels
        place = F.pmod(F.xxhash64(F.lit(11), "text"), F.lit(1 << 30)) / float(1 << 30)  # where the text falls in [0, 1)
        limit = F.least(F.lit(1.0), F.lit(each) / F.col("size"))
        share = settings.train_rows / (settings.train_rows + settings.calibration_rows)
        role = F.when(place < limit * share, "train").when(place < limit, "calibrate")
        rows = known.join(F.broadcast(sizes), "lang").withColumn("role", role).withColumn("id", F.xxhash64("text", "lang"))
        gathered = store(_gather(rows, settings))
        frequencies = dict(gathered.where("df is not null").groupBy("feature").agg(F.sum("df")).collect())  # one row per feature
        n_docs = frequencies.pop(-1, 0)
        df = np.zeros(settings.features)
        df[list(frequencies)] = list(frequencies.values())
        idf = np.log((1.0 + n_docs) / (1.0 + df)) + 1.0
        sample = gathered.where("role is not null").select("role", "lang", "id", "index", "counts")
        sample = store(sample.dropDuplicates(["id"]))  # one of the copies that several tasks met
        labels = sorted(r.lang for r in sizes.select("lang").collect())
        weights = _fit(sample, labels, idf, settings)
        held = sample.where("role = 'calibrate'").select("lang", "index", "counts").toPandas()  # bounded by calibration_rows
        logits = [
            _weigh(at := np.frombuffer(i, np.int32), np.frombuffer(c, np.int32), idf) @ weights[at]
            for i, c in zip(held["index"], held["counts"], strict=True)
        ]
        truth = np.array([labels.index(x) for x in held["lang"]], dtype=int)
        temperature = _temperature(np.array(logits), truth)
        return LanguageModel(settings, labels, idf, weights, temperature)


def held_out(key: str = "doc_id") -> Column:
    """Documents kept from the fit: a fixed quarter by checksum of the key; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))
