"""Exact nearest neighbours inside each class, without forming all pairs.

Equal points are merged into one with a multiplicity, so copies of one point never pile up.
The space of each class is cut into cells of at most a few thousand points: a cell with more is cut along its widest
coordinate at quantiles, and so on, one level at a time for all cells of all classes. The cuts are a table, and points and
queries go down it by joins; neither the number of classes nor that of cells is bounded. A query first
searches its own cell, which gives a radius; it is then sent to just those other cells that its ball touches, and
the candidates are merged. Cells, query loads and candidate lists are bounded, and the answer does not depend on how the
cells were cut. Meant for the handful of numeric features of a table: in many dimensions a ball touches most cells.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.joins import attach, few_or_stored
from tabulon.session import materialize

CELL_POINTS = 4_000
CHILDREN = 64  # of a cell that is cut, at most
QUERY_CHUNK = 20_000
_BLOCK = 256


def _cuts(points: DataFrame, by: str, features: list[str]) -> tuple[DataFrame, int]:
    """(by, cell, dim, at, n) of the cells with too many points, where they are cut along which feature, and their number.

    At the quantiles of the widest feature, as many as make cells of about a quarter of the allowed size; where most points
    share one value, in the middle of the range.
    """
    spans = F.array(*[F.max(f) - F.min(f) for f in features])
    sizes = points.groupBy(by, "cell").agg(F.count("*").alias("n"), spans.alias("spans"))
    sizes = sizes.where(F.col("n") > CELL_POINTS)
    dim = (F.array_position("spans", F.array_max("spans")) - 1).cast("int")
    wide, cells = few_or_stored(sizes.select(by, "cell", "n", dim.alias("dim")))
    if not cells:
        return wide.withColumn("at", F.lit(None).cast("array<double>")), 0
    parts = F.least(F.lit(CHILDREN), F.ceil(4 * F.col("n") / F.lit(CELL_POINTS))).cast("int")
    inside = attach(points.select(by, "cell", *features), wide.withColumn("_n", F.col("n")), [by, "cell"], size_col="_n", stored_rows=cells)
    value = F.element_at(F.array(*features), F.col("dim") + 1)
    steps = [k / CHILDREN for k in range(1, CHILDREN)]
    found = inside.where("dim is not null").select(by, "cell", "dim", "n", value.alias("x")).groupBy(by, "cell", "dim", "n").agg(
        F.percentile_approx("x", steps, 1_000).alias("q"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    taken = F.transform(F.sequence(F.lit(1), parts - 1), lambda k: F.element_at("q", F.greatest(F.lit(1), F.floor(k * CHILDREN / parts).cast("int"))))
    useful = F.array_sort(F.array_distinct(F.filter(taken, lambda x: x < F.col("high"))))
    middle = (F.col("low") + F.col("high")) / 2
    middle = F.when(middle < F.col("high"), middle).otherwise(F.col("low"))
    at = F.when(F.size(useful) > 0, useful).otherwise(F.array(middle))
    return few_or_stored(found.select(by, "cell", "dim", "n", at.alias("at")))


def _child(at: str, x: Column) -> Column:
    """Number of the child of a cut cell in which the value ``x`` lies: a cut belongs to the child below it."""
    return F.size(F.filter(at, lambda t: t < x))


def _own_cells(points: DataFrame, by: str, features: list[str]) -> tuple[DataFrame, list[tuple[DataFrame, int]]]:
    """``points`` with the ``cell`` of each, and the tables of cuts from the whole space down."""
    state = points.withColumn("cell", F.lit(""))
    settled, levels = [], []
    while True:
        cuts, cells = _cuts(state, by, features)
        if not cells:
            return reduce(DataFrame.unionByName, [*settled, state]), levels
        levels.append((cuts, cells))
        placed = attach(state, cuts, [by, "cell"], size_col="n", stored_rows=cells)
        value = F.element_at(F.array(*features), F.col("dim") + 1)
        child = F.concat_ws(".", "cell", _child("at", value).cast("string"))
        # what lies in a cell that is small enough stays where it is and is not written again
        settled.append(placed.where("dim is null").drop("dim", "at"))
        state = materialize(placed.where("dim is not null").withColumn("cell", child).drop("dim", "at"))


def _touched_cells(queries: DataFrame, levels: list[tuple[DataFrame, int]], by: str, features: list[str]) -> DataFrame:
    """``queries`` (with ``radius``), once for each ``cell`` whose side of every cut the ball reaches."""
    state = queries.withColumn("cell", F.lit(""))
    settled = []
    for cuts, cells in levels:
        met = attach(state, cuts, [by, "cell"], size_col="n", stored_rows=cells)
        value = F.element_at(F.array(*features), F.col("dim") + 1)
        reach = F.col("radius") * (1 + 1e-12)
        first, last = _child("at", value - reach), _child("at", value + reach)
        settled.append(met.where("dim is null").drop("dim", "at"))
        deeper = met.where("dim is not null").withColumn("_k", F.explode(F.sequence(first, last)))
        state = materialize(deeper.withColumn("cell", F.concat_ws(".", "cell", F.col("_k").cast("string"))).drop("_k", "dim", "at"))
    return reduce(DataFrame.unionByName, [*settled, state])


def _nearest(queries: np.ndarray, points: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query row, point rows, distances): the k nearest, ordered by distance, then coordinates."""
    k = min(k, len(points))
    for start in range(0, len(queries), _BLOCK):
        block = queries[start : start + _BLOCK]
        squares = np.zeros((len(block), len(points)))
        for dim in range(points.shape[1]):
            squares += (block[:, dim, None] - points[None, :, dim]) ** 2
        distances = np.sqrt(squares)
        border = np.partition(distances, k - 1, axis=1)[:, k - 1]
        for row in range(len(block)):
            near = np.flatnonzero(distances[row] <= border[row])
            keys = [points[near, dim] for dim in reversed(range(points.shape[1]))]
            near = near[np.lexsort([*keys, distances[row, near]])][:k]
            yield start + row, near, distances[row, near]


def _objects(lists: list, index: pd.Index) -> pd.Series:
    return pd.Series(lists, index=index, dtype=object)


def nearest_neighbours(points: DataFrame, queries: DataFrame, by: str, features: Sequence[str], k: int) -> DataFrame:
    """(by, features..., neighbours, copies): for each distinct query point the coordinates of its
    k nearest rows of the same class, itself left out once. Queries must be among the points.
    """
    names = {by: "_by"} | {f: f"_x{d}" for d, f in enumerate(features)}
    found = _nearest_neighbours(_renamed(points, names), _renamed(queries, names), "_by", list(names.values())[1:], k)
    return found.withColumnsRenamed({new: old for old, new in names.items()})


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def _nearest_neighbours(points: DataFrame, queries: DataFrame, by: str, features: list[str], k: int) -> DataFrame:
    points = points.select(by, *features, F.lit(1).cast("long").alias("copies"), F.lit(False).alias("asked"))
    asked = queries.select(by, *features, F.lit(0).cast("long").alias("copies"), F.lit(True).alias("asked"))
    merged = points.unionByName(asked).groupBy(by, *features).agg(F.sum("copies").alias("copies"), F.max("asked").alias("asked"))
    merged = materialize(merged)
    placed, levels = _own_cells(merged, by, features)

    coordinates = ", ".join(f"`{f}` double" for f in features)
    by_type = f"`{by}` {merged.schema[by].dataType.simpleString()}"
    candidate = "candidates array<struct<distance:double, at:array<double>, copies:bigint>>"

    def candidates(at: np.ndarray, copies: np.ndarray, near: np.ndarray, distances: np.ndarray) -> list[dict]:
        return [
            {"distance": float(d), "at": at[p].tolist(), "copies": int(copies[p])} for p, d in zip(near, distances)
        ]

    def search_home(frame: pd.DataFrame) -> pd.DataFrame:
        at, copies = frame[features].to_numpy(dtype=float), frame["copies"].to_numpy()
        asking = np.flatnonzero(frame["asked"].to_numpy(dtype=bool))
        radius, lists = np.full(len(asking), np.inf), []
        for row, near, distances in _nearest(at[asking], at, k + 1):
            enough = np.flatnonzero(np.cumsum(copies[near]) > k)
            if len(enough):
                radius[row] = distances[enough[0]]
            lists.append(candidates(at, copies, near, distances))
        found = frame.iloc[asking][[by, *features, "cell"]].copy()
        return found.assign(radius=radius, candidates=_objects(lists, found.index))

    # cells without a query are not read
    home = materialize(
        _with_queries(placed, by).groupBy(by, "cell").applyInPandas(
            search_home, f"{by_type}, {coordinates}, cell string, radius double, {candidate}"
        )
    )

    if not levels:
        found = home.select(by, *features, F.array_sort("candidates").alias("all"))
        return _spread(found, by, features, k).join(merged.where("asked").drop("asked"), [by, *features])

    asking = home.select(by, *features, "radius", F.col("cell").alias("_home"))
    routed = materialize(_touched_cells(asking, levels, by, features).where("cell != _home").drop("_home"))
    loads = routed.groupBy(by, "cell").agg(F.ceil(F.count("*") / QUERY_CHUNK).cast("int").alias("chunks"))
    loads, cells = few_or_stored(loads)  # one row per cell
    chunk = F.pmod(F.xxhash64(*features), F.col("chunks")).cast("int")
    visiting = attach(routed, loads, [by, "cell"], stored_rows=cells).withColumn("chunk", chunk).drop("chunks")
    visited = (
        attach(placed.drop("asked"), loads, [by, "cell"], stored_rows=cells)
        .where("chunks is not null")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .drop("chunks")
    )

    def search_visit(asking: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        columns = [by, *features, "candidates"]
        if not len(asking) or not len(frame):
            return pd.DataFrame(columns=columns)
        at, copies = frame[features].to_numpy(dtype=float), frame["copies"].to_numpy()
        reach, lists = asking["radius"].to_numpy(), []
        for row, near, distances in _nearest(asking[features].to_numpy(dtype=float), at, k + 1):
            keep = distances <= reach[row]
            lists.append(candidates(at, copies, near[keep], distances[keep]))
        return asking.assign(candidates=_objects(lists, asking.index))[columns]

    keys = [by, "cell", "chunk"]
    away = (
        visiting.groupBy(*keys)
        .cogroup(visited.groupBy(*keys))
        .applyInPandas(search_visit, f"{by_type}, {coordinates}, {candidate}")
    )
    found = home.select(by, *features, "candidates").unionByName(away)
    found = found.groupBy(by, *features).agg(F.array_sort(F.flatten(F.collect_list("candidates"))).alias("all"))
    return _spread(found, by, features, k).join(merged.where("asked").drop("asked"), [by, *features])


def _with_queries(placed: DataFrame, by: str) -> DataFrame:
    """The points of the cells in which a query lies."""
    wanted, cells = few_or_stored(placed.where("asked").select(by, "cell").distinct().withColumn("_wanted", F.lit(True)))
    return attach(placed, wanted, [by, "cell"], stored_rows=cells).where("_wanted").drop("_wanted")


def _spread(found: DataFrame, by: str, features: list[str], k: int) -> DataFrame:
    """One entry per copy. The query itself is first, at distance 0; one copy of it is left out."""
    copies = F.transform("all", lambda c: F.array_repeat(c["at"], F.least(c["copies"], F.lit(k + 1)).cast("int")))
    return found.select(by, *features, F.slice(F.flatten(copies), 2, k).alias("neighbours"))
