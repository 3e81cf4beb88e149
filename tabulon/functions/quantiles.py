"""Exact order statistics and quantiles, found by narrowing value brackets.

``percentile`` would keep every distinct value of a column in one buffer. Here each round asks
``percentile_approx`` for two values around the wanted rank, counts exactly how many rows lie
below and between them, and goes on inside that bracket, which shrinks by a factor of about
a thousand per round. Only a bracket of at most ``FINAL_ROWS`` rows is ever brought together.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.ranks import running_totals
from tabulon.session import materialize

FINAL_ROWS = 200_000  # values of one column brought together at the end
TOTAL_ROWS = 1_000_000  # the same for all columns
ACCURACY = 10_000


@dataclass
class _Bracket:
    column: str
    rank: int
    low: Any
    high: Any
    below: int
    inside: int
    stuck: bool = False

    def member(self) -> Column:
        c = F.col(self.column)
        return F.when(c.between(F.lit(self.low), F.lit(self.high)), c)

    @property
    def single(self) -> bool:
        return self.low == self.high


def order_statistics(
    df: DataFrame, ranks: dict[str, list[int]], final_rows: int | None = None
) -> dict[str, dict[int, Any]]:
    """Value at each 0-based rank among the sorted non-null values of the given columns."""
    return _select(df, list(ranks), lambda column, n: ranks[column], final_rows)[0]


def narrow(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Just these columns as a stored table, which each round of a search then reads. A table that has just been stored
    is not written again."""
    slim = df.select(*[F.col(c) for c in columns])
    if not hasattr(df, "_scratch_path"):
        return materialize(slim)
    slim._scratch_path = df._scratch_path
    return slim


def _select(
    df: DataFrame, columns: list[str], wanted: Callable[[str, int], list[int]], final_rows: int | None, sizes: list | None = None
) -> tuple[dict[str, dict[int, Any]], dict[str, int]]:
    """Values at the ranks that ``wanted`` names per column and row count, and the row counts. ``sizes``: count,
    minimum and maximum of each column, if they are known already."""
    if final_rows is None:
        final_rows = min(FINAL_ROWS, TOTAL_ROWS // max(len(columns), 1))
    found: dict[str, dict[int, Any]] = {c: {} for c in columns}
    if not columns:
        return found, {}
    if sizes is None:
        sizes = _row(df, [e for c in columns for e in (F.count(c), F.min(c), F.max(c))])
    counts = dict(zip(columns, sizes[::3]))
    brackets = []
    for column, n, low, high in zip(columns, sizes[::3], sizes[1::3], sizes[2::3]):
        for rank in sorted(set(wanted(column, n))):
            if not 0 <= rank < n:
                raise ValueError(f"rank {rank} is outside the {n} values of {column}")
            brackets.append(_Bracket(column, rank, low, high, 0, n))

    while True:
        wide = [b for b in brackets if b.inside > final_rows and not b.single and not b.stuck]
        if not wide:
            break
        _narrow(df, wide)

    small: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        if b.single:
            found[b.column][b.rank] = b.low
        elif b.inside <= final_rows:
            small.setdefault((b.column, b.low, b.high), []).append(b)
        else:
            found[b.column][b.rank] = _by_value_counts(df, b)
    groups = list(small.values())
    if groups:
        picks = []
        for group in groups:
            ordered = F.sort_array(F.collect_list(group[0].member()))
            picks.append(F.array(*[F.get(ordered, F.lit(b.rank - b.below)) for b in group]))
        for group, values in zip(groups, _row(df, picks)):
            for b, value in zip(group, values):
                found[b.column][b.rank] = value
    return found, counts


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], sizes: list | None = None
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, nulls left out; None where all is null. ``sizes`` as in ``_select``."""
    df = narrow(df, columns) if columns else df

    def places(n: int) -> list[float]:
        return [(n - 1) * p for p in probabilities] if n else []

    def ranks(column: str, n: int) -> list[int]:
        return [k for at in places(n) for k in (math.floor(at), math.ceil(at))]

    values, counts = _select(df, columns, ranks, None, sizes)
    result = {}
    for column in columns:
        if not counts[column]:
            result[column] = [None] * len(probabilities)
            continue
        row = []
        for at in places(counts[column]):
            low, high = values[column][math.floor(at)], values[column][math.ceil(at)]
            row.append(low + (high - low) * (at - math.floor(at)))
        result[column] = [float(x) for x in row]
    return result


def filled_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float]
) -> tuple[dict[str, float | None], dict[str, list[float] | None]]:
    """Median of each column, and its quantiles once nulls are filled with the median; None for a column without values.

    Filled rows are the ``n`` sorted values with the median put ``gaps`` times before the upper middle one. So a rank below that
    place is a rank among the values, one beyond it is ``gaps`` less, and one between is the median itself: all ranks are known
    from the counts, and one search serves the median and the quantiles.
    """
    if not columns:
        return {}, {}
    df = narrow(df, columns)
    rows, *sizes = _row(df, [F.count(F.lit(1)), *[e for c in columns for e in (F.count(c), F.min(c), F.max(c))]])

    def source(rank: int, n: int) -> int | None:
        middle = math.ceil((n - 1) * 0.5)
        return rank if rank < middle else None if rank < middle + rows - n else rank - (rows - n)

    def ranks(column: str, n: int) -> list[int]:
        if not n:
            return []
        ends = [k for p in probabilities for k in (math.floor((rows - 1) * p), math.ceil((rows - 1) * p))]
        own = [source(k, n) for k in ends]
        return [math.floor((n - 1) * 0.5), math.ceil((n - 1) * 0.5), *[k for k in own if k is not None]]

    values, counts = _select(df, columns, ranks, None, sizes)

    def between(low: float, high: float, at: float) -> float:
        return float(low + (high - low) * (at - math.floor(at)))

    medians, quantiles = {}, {}
    for c in columns:
        n = counts[c]
        if not n:
            medians[c] = quantiles[c] = None
            continue
        at = (n - 1) * 0.5
        medians[c] = between(values[c][math.floor(at)], values[c][math.ceil(at)], at)
        quantiles[c] = []
        for p in probabilities:
            at = (rows - 1) * p
            ends = [source(k, n) for k in (math.floor(at), math.ceil(at))]
            low, high = (medians[c] if k is None else float(values[c][k]) for k in ends)
            quantiles[c].append(between(low, high, at))
    return medians, quantiles


def _row(df: DataFrame, expressions: list[Column]) -> list:
    """The single row of an aggregate."""
    return list(df.agg(*[e.alias(f"x{k}") for k, e in enumerate(expressions)]).first())


def _narrow(df: DataFrame, brackets: list[_Bracket]) -> None:
    # brackets of a column that are still the same share one sketch of their values
    together: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        together.setdefault((b.column, b.low, b.high), []).append(b)
    sketches = []
    for group in together.values():
        shares = []
        for b in group:
            centre, reach = (b.rank - b.below + 0.5) / b.inside, 2.0 / ACCURACY
            shares += [max(0.0, centre - reach), min(1.0, centre + reach)]
        sketches.append(F.percentile_approx(group[0].member(), shares, ACCURACY))
    found = zip(together.values(), _row(df, sketches))
    limits = {id(b): edges[2 * k : 2 * k + 2] for group, edges in found for k, b in enumerate(group)}
    limits = [limits[id(b)] for b in brackets]
    counts = []
    for b, (low, high) in zip(brackets, limits):
        c = F.col(b.column)
        counts += [F.count_if(c < F.lit(low)), F.count_if(c.between(F.lit(low), F.lit(high)))]
    numbers = _row(df, counts)
    for k, (b, (low, high)) in enumerate(zip(brackets, limits)):
        below, inside = numbers[2 * k], numbers[2 * k + 1]
        if below <= b.rank < below + inside and inside < b.inside:
            b.low, b.high, b.below, b.inside = low, high, below, inside
        else:
            b.stuck = True


def _by_value_counts(df: DataFrame, b: _Bracket) -> Any:
    """For a bracket that does not shrink: rank its distinct values by distributed totals."""
    values = df.select(b.member().alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    ranked = running_totals(values, [], "v", ["n"])
    at = b.rank - b.below
    return ranked.where((F.col("n_before") <= at) & (F.col("n_before") + F.col("n") > at)).first()["v"]
