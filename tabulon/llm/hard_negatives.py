"""Hard negatives by inner product, found by coordinate pruning in buckets of similar length.

Different vectors of a label are sorted by length and cut into buckets, each with one sorted list per
coordinate. If an inner product is to reach a threshold, the angle between anchor and vector is bounded, and so is the
range in which each coordinate of the vector can lie. The ranges of the anchor's largest coordinates are cut out of the lists
and intersected; what is left is scored exactly. Anchors are the stated queries: they are read in blocks of bounded
size, each of which is broadcast and meets all buckets where they lie.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.centroids import whole_numbers
from tabulon.llm.tables import if_small, store
from tabulon.llm.words import list_column
from tabulon.session import scratch_tables

BUCKET = 2048  # vectors
SHORTEST = 0.9  # of the longest vector of a bucket
FOCUS = 4  # coordinates
ANCHORS_AT_ONCE = 16_384
_SLACK = 1e-9
_LEAST, _MOST = -(2**63), 2**63 - 1
_FOUND = "k1 long, k2 long, win int, score long, id long, own boolean"


def _buckets(classes: DataFrame) -> DataFrame:
    """(label, size, n, longest, probe, x, lists, k1, k2, ids, n_ids): the longest vectors of a label first. ``probe``
    marks the first bucket of a label in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, seen = None, set()
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                rest = table if rest is None else pa.concat_tables([rest, table])
            if rest is None:
                return
            keys = list(zip(rest.column("label").to_pylist(), rest.column("size").to_pylist(), strict=True))
            length = np.sqrt(rest.column("norm").to_numpy())
            at = 0
            while at < len(keys):
                to = at + 1
                while to < len(keys) and to - at < BUCKET and keys[to] == keys[at] and length[to] >= SHORTEST * length[at]:
                    to += 1
                if to == len(keys) and to - at < BUCKET and batch is not None:
                    break  # may go on in the next batch
                yield _bucket(rest.slice(at, to - at).combine_chunks(), keys[at], float(length[at]), keys[at] not in seen)
                seen.add(keys[at])
                at = to
            rest = rest.slice(at)

    kind = classes.schema["label"].dataType.simpleString()
    schema = f"label {kind}, size int, n int, longest double, probe boolean, x binary, lists binary, k1 array<long>, k2 array<long>, ids array<long>, n_ids array<int>"
    ordered = ["label", "size", F.desc("norm"), "k1", "k2"]
    return classes.repartitionByRange(*ordered).sortWithinPartitions(*ordered).mapInArrow(run, schema)


def _bucket(part: pa.Table, key: tuple, longest: float, probe: bool) -> pa.RecordBatch:
    n, size = part.num_rows, key[1]
    x = part.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, size)
    small = not x.size or np.abs(x).max() < 2**31
    lists = np.argsort(_unit(x), axis=0, kind="stable").T.astype("<u2")
    ids = part.column("ids").combine_chunks()
    one = lambda name: list_column(part.column(name).combine_chunks(), np.array([n]))
    n_ids = list_column(pa.array(np.diff(ids.offsets.to_numpy()), pa.int32()), np.array([n]))
    columns = [
        part.column("label").combine_chunks()[:1], pa.array([size], pa.int32()), pa.array([n], pa.int32()), pa.array([longest]), pa.array([probe]),
        pa.array([x.astype("<i4" if small else "<i8").tobytes()]), pa.array([np.ascontiguousarray(lists).tobytes()]),
        one("k1"), one("k2"), list_column(ids.flatten(), np.array([len(ids.flatten())])), n_ids,
    ]
    return pa.RecordBatch.from_arrays(columns, names=["label", "size", "n", "longest", "probe", "x", "lists", "k1", "k2", "ids", "n_ids"])


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1.0)


@dataclass
class Anchors:
    """Queries of one size with the score windows [low, high] that are asked for."""

    k1: np.ndarray
    k2: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    length: np.ndarray
    angles: np.ndarray  # to each axis
    focus: np.ndarray
    windows: list[list[tuple[int, int]]]


def _anchors(rows: list) -> dict[int, Anchors]:
    out = {}
    for size in {len(r.v) for r in rows}:
        own = [r for r in rows if len(r.v) == size]
        x = np.array([r.v for r in own], dtype=np.int64).reshape(len(own), size)
        unit = _unit(x)
        out[size] = Anchors(
            np.array([r.k1 for r in own]), np.array([r.k2 for r in own]), np.array([r.label for r in own]), x,
            np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)), np.arccos(np.clip(unit, -1, 1)),
            np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS], [[(w.low, w.high) for w in r.windows] for r in own],
        )
    return out


def feasible(threshold: float, angles: np.ndarray, lists: np.ndarray, values: np.ndarray, focus: np.ndarray) -> np.ndarray:
    """Rows whose coordinates ``focus`` allow a cosine of ``threshold``: with an angle of at most d to the query, whose
    angle to an axis is a, a vector has a coordinate from cos(a + d) to cos(a - d) there."""
    reach = math.acos(min(1.0, threshold))
    ranges = []
    for f in focus.tolist():
        low = math.cos(min(math.pi, angles[f] + reach)) - _SLACK
        high = math.cos(max(0.0, angles[f] - reach)) + _SLACK
        a, b = np.searchsorted(values[f], low), np.searchsorted(values[f], high, side="right")
        ranges.append((int(b - a), f, int(a), int(b)))
    ranges.sort()
    n = lists.shape[1]
    _, f, a, b = ranges[0]
    rows = lists[f, a:b]
    for count, f, a, b in ranges[1:]:
        if not len(rows) or count == n:
            break
        inside = np.zeros(n, dtype=bool)
        inside[lists[f, a:b]] = True
        rows = rows[inside[rows]]
    return rows.astype(np.int64)


class _Search:
    """The best rows of each window of each anchor, over the buckets that a task meets."""

    def __init__(self, anchors: dict[int, Anchors], same: bool, count: int):
        self.anchors, self.same, self.count = anchors, same, count
        self.best: dict[tuple[int, int, int], list[tuple[int, int, bool]]] = {}
        self.bound = {s: [[low for low, _ in w] for w in a.windows] for s, a in anchors.items()}
        self.least = {s: np.array([min((float(x) for x in w), default=np.inf) for w in b]) for s, b in self.bound.items()}

    def visit(self, row: dict) -> None:
        size, n = row["size"], row["n"]
        anchors = self.anchors.get(size)
        if anchors is None:
            return
        reached = self.least[size] <= anchors.length * row["longest"] * (1 + _SLACK) + 1  # what is shorter cannot score so high
        wanted = np.flatnonzero(((anchors.labels == row["label"]) == self.same) & reached)
        if not len(wanted):
            return
        x = np.frombuffer(row["x"], "<i4" if len(row["x"]) == 4 * n * size else "<i8").reshape(n, size).astype(np.int64)
        lists = np.frombuffer(row["lists"], "<u2").reshape(size, n)
        values = np.take_along_axis(_unit(x).T, lists.astype(np.int64), axis=1)
        ends = np.cumsum(row["n_ids"])
        starts = ends - row["n_ids"]
        k1, k2, ids = np.array(row["k1"]), np.array(row["k2"]), row["ids"]
        for q in wanted.tolist():
            threshold = self.least[size][q]
            if threshold > 1 and size:
                cosine = (threshold - 1) / (anchors.length[q] * row["longest"])  # the bound as a double may be off by less than 1
                some = feasible(max(0.0, cosine), anchors.angles[q], lists, values, anchors.focus[q])
            else:
                some = np.arange(n)
            if not len(some):
                continue
            scores = x[some] @ anchors.x[q]
            for w, (_, high) in enumerate(anchors.windows[q]):
                good = (scores >= self.bound[size][q][w]) & (scores <= high)
                if not good.any():
                    continue
                mine, rows = scores[good], some[good]
                if len(mine) > self.count:
                    top = mine >= np.partition(mine, len(mine) - self.count)[len(mine) - self.count]
                    mine, rows = mine[top], rows[top]
                own = (k1[rows] == anchors.k1[q]) & (k2[rows] == anchors.k2[q])
                held = self.best.setdefault((size, q, w), [])
                for s, r, o in zip(mine.tolist(), rows.tolist(), own.tolist(), strict=True):
                    held += [(-s, i, o) for i in ids[starts[r] : ends[r]][: self.count]]
                held.sort()
                del held[self.count :]
                if len(held) == self.count:
                    self.bound[size][q][w] = max(self.bound[size][q][w], -held[-1][0])
            self.least[size][q] = min(map(float, self.bound[size][q]))

    def rows(self) -> pa.RecordBatch:
        out = [(int(self.anchors[s].k1[q]), int(self.anchors[s].k2[q]), w, -score, i, own) for (s, q, w), held in self.best.items() for score, i, own in held]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "win", "score", "id", "own"])


def _found(buckets: DataFrame, anchors: DataFrame, same: bool, count: int) -> DataFrame:
    """(k1, k2, win, score, id, own): the best ``count`` rows of each window of each anchor (k1, k2, label, v, windows)."""
    spark = buckets.sparkSession
    n_blocks = max(1, math.ceil(anchors.count() / ANCHORS_AT_ONCE))
    parts = []
    for k in range(n_blocks):
        rows = anchors.where(F.pmod("k1", F.lit(n_blocks)) == k).collect()  # of bounded size
        shared = spark.sparkContext.broadcast(_anchors(rows))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = _Search(shared.value, same, count)
            for batch in batches:
                for row in batch.to_pylist():
                    search.visit(row)
            yield search.rows()

        parts.append(store(buckets.mapInArrow(run, _FOUND)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    place = F.row_number().over(Window.partitionBy("k1", "k2", "win").orderBy(F.desc("score"), "id", F.desc("own")))
    return found.withColumn("place", place).where(F.col("place") <= count).drop("place")


def mine_negatives(
    vectors: DataFrame, anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256,
    positives: int = 5, negatives: int = 5, percent: int = 80,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components x become floor(scale * x); a score is the inner product with the anchor, in whole numbers. An anchor's
    positives are its first ``positives`` other rows of its label, the highest score first, equal ones by key. For each
    of them the first ``negatives`` rows of other labels follow whose score is at least ``percent`` per cent of the
    positive's and not above it; ``rank`` counts them from 1. So nothing follows a positive of negative score.

    Rows without key, label or vector, or with a component that is null or not finite, take no part; only vectors of
    one size are compared. Repeated rows are rows of their own: an anchor leaves out itself once, and a repeated anchor has its rows
    repeatedly. Equal vectors of a label are one class that is searched once and keeps its least keys, as many as can be
    returned. Other columns are ignored; an empty table gives an empty result. Nothing is approximate.
    """
    spark = vectors.sparkSession
    with scratch_tables(spark) as scratch:
        rows = vectors.select(
            vectors[f"`{key}`"].cast("long").alias("id"), vectors[f"`{label}`"].alias("label"), whole_numbers(f"`{vector}`", scale).alias("v"),
            F.coalesce(anchor, F.lit(False)).alias("asks"),
        ).where("id is not null and label is not null and v is not null")
        rows = store(rows.withColumns({"k1": F.xxhash64("label", "v"), "k2": F.xxhash64(F.lit(7), "label", "v")}))
        most = max(positives + 1, negatives)
        place = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("id"))  # cut to ``most`` before the shuffle, too
        first = rows.withColumn("place", place).where(F.col("place") <= most)
        classes = first.groupBy("k1", "k2").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))
        norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
        classes = store(classes.select("*", F.size("v").alias("size"), norm.alias("norm")))
        buckets = store(_buckets(classes))
        asking = rows.where("asks").select("id", "k1", "k2")
        anchors = store(classes.join(asking.select("k1", "k2").distinct(), ["k1", "k2"]).select("k1", "k2", "label", "v"))

        def window(low: Column, high: Column) -> Column:
            return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))

        anything = F.array(window(F.lit(_LEAST), F.lit(_MOST))).alias("windows")
        probed = _found(buckets.where("probe"), anchors.select("*", anything), True, positives + 1)
        least = probed.groupBy("k1", "k2").agg(F.min("score").alias("low"), F.count("*").alias("n"))
        low = F.when(F.col("n") > positives, F.col("low")).otherwise(F.lit(_LEAST))
        above = F.array(window(low, F.lit(_MOST))).alias("windows")
        started = store(anchors.join(least, ["k1", "k2"], "left").select("k1", "k2", "label", "v", above))
        near = store(_found(buckets, started, True, positives + 1))

        # of one class at most ``positives`` + 1 rows
        tops = near.groupBy("k1", "k2").agg(F.collect_list(F.struct((-F.col("score")).alias("order"), "id", "own", "score")).alias("tops"))
        scores = F.array_sort(F.array_distinct(F.transform("tops", lambda t: t["score"])))
        asked = F.filter(scores, lambda s: s >= 0)
        share = F.transform(asked, lambda s: window(F.call_function("div", s * percent + 99, F.lit(100)), s))  # rounded up
        tops = store(tops.select("k1", "k2", F.array_sort("tops").alias("tops"), asked.alias("asked"), share.alias("windows")))
        ranged = store(anchors.join(tops.where(F.size("asked") > 0).select("k1", "k2", "windows"), ["k1", "k2"]))
        far = _found(buckets, ranged, False, negatives)
        lists = far.groupBy("k1", "k2", "win").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("order"), "id", "score"))).alias("far"))
        by_class = lists.groupBy("k1", "k2").agg(F.map_from_entries(F.collect_list(F.struct("win", "far"))).alias("far"))
        whole = store(tops.select("k1", "k2", "tops", "asked").join(by_class, ["k1", "k2"]))

        itself = F.array_position(F.transform("tops", lambda t: t["own"] & (t["id"] == F.col("anchor_id"))), F.lit(True))
        others = F.slice(F.filter("tops", lambda t, i: i + 1 != itself), 1, positives)
        joined = asking.withColumnRenamed("id", "anchor_id").join(if_small(whole, 1000), ["k1", "k2"])
        with_positive = joined.select("anchor_id", "asked", "far", F.explode(others).alias("p")).where(F.col("p.score") >= 0)
        at = (F.array_position("asked", F.col("p.score")) - 1).cast("int")
        with_negative = with_positive.select("anchor_id", "p", F.posexplode(F.try_element_at("far", at)).alias("at", "f"))
        result = store(
            with_negative.select(
                "anchor_id", F.col("p.id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("f.id").alias("negative_id"),
                F.col("p.score").alias("positive_score"), F.col("f.score").alias("negative_score"),
            )
        )
        scratch.keep(result)
    return result
