"""Lloyd clustering of integer vectors whose dimensions are sharded.

Vectors lie in groups of rows, and each group is cut into column blocks. A task on a block knows the block's slice of
the centroids alone: it gives exact partial distances, which are added by group, and the least sum assigns each
vector. The assignment goes back to the blocks, and each updates its own slice. The blocks are stored
bucketed by group and block, so a round moves partial distances and assignments only, never vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.tables import if_small, store, store_bucketed
from tabulon.llm.words import list_column
from tabulon.session import scratch_tables

WIDTH = 32  # columns of a block
ROWS = 1024  # vectors of a group


def whole_numbers(vector: str, scale: int, size: int | None = None) -> Column:
    """floor(scale * x) of each component; null for a vector with a component that is null or not finite or, if ``size``
    is given, of another size. Components so large that a squared distance might leave 64 bits are an error."""
    most = F.sqrt(F.lit(2.0**60) / F.greatest(F.size(vector), F.lit(1)))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if size is not None:
        finite = (F.size(vector) == size) & finite
    too_large = F.raise_error(F.lit("a component is too large for exact distances in 64 bits"))

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) > most, too_large.cast("long")).otherwise(F.floor(scaled).cast("long"))

    return F.when(F.coalesce(finite, F.lit(False)), F.transform(vector, whole))


def _groups(rows: DataFrame, size: int, width: int) -> DataFrame:
    """(block, grp, n, x, ids): the columns of a block of the vectors of a group; the ids lie beside block 0."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n = part.num_rows
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(n, size)
                starts = range(0, size, width)
                ids = list_column(part.column("id"), np.array([n] + [0] * (len(starts) - 1)))
                slices = [np.ascontiguousarray(x[:, s : s + width]).tobytes() for s in starts]
                blocks = pa.array(range(len(starts)), pa.int32())
                columns = [blocks, pa.array([group] * len(starts)), pa.array([n] * len(starts), pa.int32()), pa.array(slices), ids]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "grp", "n", "x", "ids"])
                group += 1

    return rows.mapInArrow(run, f"block int, grp long, n int, x binary, ids array<{kind}>")


def _partial_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for n, x, centres in zip(batch.column("n").to_pylist(), batch.column("x").to_pylist(), batch.column("centres").to_pylist(), strict=True):
            x = np.frombuffer(x, "<i8").reshape(n, -1)
            far = np.empty((n, len(centres)), "<i8")
            for j, centre in enumerate(centres):
                gap = x - np.array(centre, dtype=np.int64)
                far[:, j] = (gap * gap).sum(axis=1)
            out.append(far.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("n"), pa.array(out, pa.binary())], names=["grp", "n", "far"])


def _nearest(blocks: pa.Table) -> pa.Table:
    """The partial distances of one group added; the least sum of each vector, of equal ones the first."""
    n = blocks.column("n")[0].as_py()
    far = sum(np.frombuffer(x, "<i8").reshape(n, -1) for x in blocks.column("far").to_pylist())
    best = far.argmin(axis=1)
    least = far[np.arange(n), best].astype("<i8")
    return pa.table({"grp": blocks.column("grp")[:1], "best": [best.astype("<i4").tobytes()], "least": [least.tobytes()]})


def _assigned(blocks: DataFrame, centres: DataFrame) -> DataFrame:
    """(grp, best, least): cluster and squared distance of each vector of a group."""
    by_block = centres.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("cluster", "c"))).alias("centres"))
    sliced = by_block.select("block", F.transform("centres", lambda x: x["c"]).alias("centres"))
    met = blocks.select("block", "grp", "n", "x").join(F.broadcast(sliced), "block")  # one slice a block: k x dimensions
    far = met.select("grp", "n", "x", "centres").mapInArrow(_partial_distances, "grp long, n int, far binary")
    return far.groupBy("grp").applyInArrow(_nearest, "grp long, best binary, least binary")


def _updated(blocks: DataFrame, assigned: DataFrame, centres: DataFrame, n_blocks: int, width: int, k: int) -> DataFrame:
    """(block, cluster, c): the floor of the mean of each cluster in each block; an empty cluster keeps its centre."""
    everywhere = assigned.select("grp", "best", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    met = blocks.select("block", "grp", "n", "x").join(everywhere, ["block", "grp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, n, x, best in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "x", "best")), strict=True):
                x, best = np.frombuffer(x, "<i8").reshape(n, -1), np.frombuffer(best, "<i4")
                total = sums.setdefault(block, np.zeros((k, x.shape[1]), dtype=np.int64))
                for j in np.unique(best).tolist():
                    total[j] += x[best == j].sum(axis=0)
                counts[block] = counts.get(block, 0) + np.bincount(best, minlength=k)
        for block, total in sums.items():
            some = np.flatnonzero(counts[block])
            values = list_column(pa.array(total[some].ravel()), np.full(len(some), total.shape[1]))
            columns = [pa.array([block] * len(some), pa.int32()), pa.array(some.astype(np.int32)), pa.array(counts[block][some]), values]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "cluster", "n", "s"])

    sums = met.select("block", "n", "x", "best").mapInArrow(run, "block int, cluster int, n long, s array<long>")
    sums = sums.withColumn("old", F.lit(None).cast("array<long>"))
    old = centres.select("block", "cluster", F.lit(0).cast("long").alias("n"), F.lit(None).cast("array<long>").alias("s"), F.col("c").alias("old"))
    added = sums.unionByName(old).groupBy("block", "cluster").agg(
        F.sum("n").alias("n"), F.max("old").alias("old"), *[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(width)]
    )
    exact = F.expr("array(" + ", ".join(f"(s{i} - pmod(s{i}, n)) div n" for i in range(width)) + ")")
    mean = F.slice(exact, 1, F.size("old"))  # the last block may be narrower
    return added.select("block", "cluster", F.when(F.col("n") > 0, mean).otherwise(F.col("old")).alias("c"))


def lloyd(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10, size: int = 64,
    scale: int = 1024, seed: int = 3, width: int = WIDTH,
) -> tuple[DataFrame, DataFrame]:
    """(``key``, cluster, distance) of each vector that is kept, and (cluster, centroid) of the final centroids.

    Kept are vectors of ``size`` components, none null or not finite; each component x becomes floor(scale * x), and from
    there on all is exact. The first centroids are the ``k`` kept vectors (all, if there are fewer) whose keys, written behind the seed and a
    colon, have the least sha256; equal keys go by their vectors, and vectors without key only follow behind all others.
    Each of ``rounds`` rounds assigns every vector to the nearest centroid (of equally near ones the first) and
    replaces each centroid by the floor of its vectors' mean; one without vectors stays. Then vectors are assigned once
    more. Repeated rows are vectors of their own, each with a row in the result; other columns are ignored. An empty
    table gives two empty ones.
    """
    spark = vectors.sparkSession
    n_blocks = -(-size // width)
    with scratch_tables(spark) as scratch:
        whole = vectors.select(vectors[f"`{key}`"].alias("id"), whole_numbers(f"`{vector}`", scale, size).alias("v")).where("v is not null")
        order = [F.col("id").isNull(), F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), F.col("v")]
        first = whole.orderBy(*order).limit(k)  # k rows
        numbered = first.select(F.row_number().over(Window.orderBy(*order)).alias("cluster"), "v")
        cut = F.transform(F.sequence(F.lit(0), F.lit(n_blocks - 1)), lambda b: F.slice("v", b * width + 1, F.lit(width)))
        centres = store(
            numbered.select((F.col("cluster") - 1).cast("int").alias("cluster"), F.posexplode(cut).alias("block", "c")).select("block", "cluster", "c")
        )
        blocks = store_bucketed(_groups(whole, size, width), ["block", "grp"])
        for _ in range(rounds):
            moved = store(_updated(blocks, _assigned(blocks, centres), centres, n_blocks, width, k))
            scratch.drop(centres)
            centres = moved
        assigned = store(_assigned(blocks, centres))
        ids = blocks.where("block = 0").select("grp", "ids")

        def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                best = np.frombuffer(b"".join(batch.column("best").to_pylist()), "<i4")
                least = np.frombuffer(b"".join(batch.column("least").to_pylist()), "<i8")
                yield pa.RecordBatch.from_arrays([batch.column("ids").flatten(), pa.array(best), pa.array(least)], names=["id", "cluster", "distance"])

        kind = vectors.schema[key].dataType.simpleString()
        unfolded = ids.join(assigned, "grp").select("ids", "best", "least").mapInArrow(unfold, f"id {kind}, cluster int, distance long")
        placed = store(unfolded.withColumnRenamed("id", key))
        joined = centres.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("block", "c"))).alias("parts"))
        final = store(joined.select("cluster", F.flatten(F.transform("parts", lambda p: p["c"])).alias("centroid")))
        scratch.keep(placed, final)
    return placed, final


def with_inertia(placed: DataFrame, centroids: DataFrame) -> DataFrame:
    """``placed`` with ``cluster_inertia``, ``inertia`` (distances added up over the cluster and over all) and
    ``centroid_sha256`` of the centroid's components, joined by commas."""
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = sums.agg(F.sum("cluster_inertia")).scalar()
    named = centroids.select("cluster", F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))
    facts = store(sums.join(named, "cluster").withColumn("inertia", total))
    return placed.join(if_small(facts, 100), "cluster")
