"""Crosstabs, independence tests and correlations."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.joins import attach
from tabulon.functions.ranks import average_ranks
from tabulon.session import materialize, materialize_sized, more_partitions


MOST_COLUMNS = 10_000
VALUES_AT_ONCE = 1_000_000  # of all columns, ranked by one task


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence | None = None) -> DataFrame:
    """Counts of ``rows`` against ``columns``; absent pairs are 0, rows with a null on either side are left out.

    The values of ``columns`` are found if they are not given (at most 10,000); one beside those given is an error of the
    query, which counts such rows in the same pass.
    """
    df = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    if values is None:
        values = sorted(r[0] for r in df.select(columns).distinct().limit(MOST_COLUMNS + 1).collect())
        if len(values) > MOST_COLUMNS:
            raise ValueError(f"{columns!r} has more than {MOST_COLUMNS} values")
    if not values:
        return df.select(rows).distinct()
    names = [f"{columns}_{v}" for v in values]
    counts = df.groupBy(rows).agg(
        *[F.count_if(F.col(columns) == v).alias(name) for v, name in zip(values, names)], F.count_if(~F.col(columns).isin(*values)).alias("_other")
    )
    beside = F.raise_error(F.lit(f"{columns!r} has values beside {list(values)}")).cast("long")
    first, *others = [F.col(name) for name in names]
    return counts.select(rows, F.when(F.col("_other") > 0, beside).otherwise(first).alias(names[0]), *others)


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Independence test of two columns: (statistic, dof), Yates-corrected if dof is 1.

    With E = row total · column total / N, the sum of (O-E)²/E over all cells, empty ones too,
    equals N·(sum of O²/(row total · column total) - 1): only cells that occur are formed.
    """
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = materialize(pairs.groupBy(a, b).agg(F.count("*").alias("_o")))
    # a hot key has many cells, whatever the number of rows behind each
    row_totals = cells.groupBy(a).agg(F.sum("_o").cast("double").alias("_r"), F.count("*").alias("_cells"))
    col_totals = cells.groupBy(b).agg(F.sum("_o").cast("double").alias("_c"), F.count("*").alias("_cells"))
    n = cells.agg(F.sum("_o").cast("double")).scalar()
    joined = attach(attach(cells, row_totals, [a], size_col="_cells"), col_totals, [b], size_col="_cells")
    sums = joined.agg(
        F.sum(F.col("_o").cast("double") / F.col("_r") * F.col("_o") / F.col("_c")).alias("ratio"),
        F.max(F.abs(F.col("_o") - F.col("_r") * F.col("_c") / n)).alias("deviation"),
    )
    n_a, n_b = (cells.agg(F.count_distinct(c)).scalar() for c in (a, b))
    sums = sums.withColumn("dof", (n_a - 1) * (n_b - 1))
    plain = n * (F.col("ratio") - 1)
    # the four cells of a 2x2 table deviate by the same |O-E|; the correction lowers it by 1/2
    shrink = 1 - F.least(F.lit(0.5), F.col("deviation")) / F.col("deviation")
    corrected = F.when(F.col("deviation") > 0, plain * shrink * shrink).otherwise(F.lit(0.0))
    return sums.select(F.when(F.col("dof") == 1, corrected).otherwise(plain).alias("statistic"), "dof")


def chi_square_test(df: DataFrame, a: str, b: str) -> dict[str, float]:
    found = chi_square(df, a, b).first()
    return {"statistic": found.statistic, "dof": found.dof, "p_value": chi_square_p(found.statistic, found.dof)}


def chi_square_p(statistic: float, dof: int) -> float:
    """Upper tail of the chi-square distribution (regularised incomplete gamma function)."""
    if dof <= 0 or statistic <= 0:
        return 1.0
    s, x = dof / 2.0, statistic / 2.0
    scale = math.exp(-x + s * math.log(x) - math.lgamma(s))
    if x < s + 1:  # power series of the lower tail
        term = total = 1.0 / s
        k = s
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * scale)
    tiny = 1e-300  # continued fraction of the upper tail
    b = x + 1 - s
    c, d = 1 / tiny, 1 / b
    h = d
    for k in range(1, 100_000):
        factor = -k * (k - s)
        b += 2
        d = factor * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + factor / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return min(1.0, h * scale)


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_a, column_b, correlation) over the rows where both are present, in one pass."""
    return _pair_correlations(df, [(a, b, F.col(a), F.col(b)) for a, b in combinations(columns, 2)])


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation with average ties over the rows where both columns are present.

    Equal rows are counted first and numbered. The values of all columns are ranked together in long form, (row, column, value), by
    distributed running totals over the distinct ones, meet their ranks there, and come back to their rows in one shuffle;
    no rows are sorted as a whole. A column is ranked again only for partners whose gaps shorten its row set. A task counts
    about ``VALUES_AT_ONCE`` values, however many there are.
    """
    columns = list(columns)
    pairs = list(combinations(columns, 2))
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    counts = rows.groupBy(*columns).agg(F.count("*").alias("_w")).withColumn("_row", F.monotonically_increasing_id())
    rows, different = materialize_sized(counts)
    weight = F.col("_w")

    def size(*present: str) -> Column:
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in present])
        return F.coalesce(F.sum(F.when(complete, weight)), F.lit(0))

    found = rows.agg(*[size(c) for c in columns], *[size(a, b) for a, b in pairs]).first()
    n = dict(zip([*[(c, c) for c in columns], *pairs], found))
    n |= {(b, a): k for (a, b), k in n.items()}
    # columns with gaps in the same rows need not be told apart as partners
    stand_in: dict[str, str] = {}
    for c in columns:
        stand_in[c] = next((d for d in stand_in if n[c, d] == n[c, c] == n[d, d]), c)

    def ranking(column: str, partner: str) -> tuple[str, str]:
        return (column, column) if n[column, partner] == n[column, column] else (column, stand_in[partner])

    rankings: dict[tuple[str, str], str] = {}
    for a, b in pairs:
        for column, partner in (ranking(a, b), ranking(b, a)):
            turn = sum(c == column for c, p in rankings if (c, p) != (column, partner))
            rankings.setdefault((column, partner), f"_rank{turn}")
    # the long rows, which are shuffled and sorted, carry numbers in the place of names
    place = {c: k for k, c in enumerate(columns)}
    turns = sorted(set(rankings.values()))
    turn_of = {name: k for k, name in enumerate(turns)}
    entries = [
        F.struct(
            F.lit(place[column]).alias("column"),
            F.lit(turn_of[name]).alias("ranking"),
            F.when(F.col(partner).isNotNull(), F.col(column)).alias("v"),
            weight,
        )
        for (column, partner), name in rankings.items()
    ]
    tasks = -(-different * len(entries) // VALUES_AT_ONCE)
    with more_partitions(df.sparkSession, tasks) as at_once:
        # values are counted in the map stage, whose tables grow with what a task reads; a stored table has large splits
        rows = rows.repartition(at_once, "_row") if tasks > 1 else rows
        long = rows.select(F.inline(F.array(*entries))).where("v is not null")
        counted = long.groupBy("column", "ranking", "v").agg(F.sum("_w").alias("n"))
        ranks = average_ranks(counted, ["column", "ranking"], "v", "n").groupBy("column", "v")
        rank_of = [F.max(F.when(F.col("ranking") == turn_of[name], F.col("avg_rank"))).alias(name) for name in turns]
        table, values = materialize_sized(ranks.agg(*rank_of, F.max("n").alias("_n")))
        placed = rows.select("_row", "_w", F.inline(F.array(*[F.struct(F.lit(place[c]).alias("column"), F.col(c).alias("v")) for c in columns])))
        met = attach(placed.where("v is not null"), table, ["column", "v"], size_col="_n", stored_rows=values)
        own = [F.max(F.when(F.col("column") == place[c], F.col(name))).alias(f"{c}{name}") for (c, _), name in rankings.items()]
        ranked = met.groupBy("_row").agg(F.first("_w").alias("_w"), *own)

        def centred(column: str, partner: str) -> Column:
            mean = (n[column, partner] + 1) / 2.0  # of average ranks, whatever the ties
            return F.col(f"{column}{rankings[ranking(column, partner)]}") - F.lit(mean)

        parts = []
        for k, (a, b) in enumerate(pairs):
            x, y = centred(a, b), centred(b, a)
            both = x.isNotNull() & y.isNotNull()
            xy, xx, yy = (F.sum(F.when(both, weight * p)) for p in (x * y, x * x, y * y))
            value = F.when((xx > 0) & (yy > 0), xy / (F.sqrt(xx) * F.sqrt(yy)))
            parts.append(F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), value.alias("correlation")).alias(f"c{k}"))
        wide = ranked.agg(*parts)
        return materialize(wide.select(F.inline(F.array(*wide.columns))))


def _pair_correlations(df: DataFrame, pairs: list[tuple[str, str, Column, Column]]) -> DataFrame:
    parts = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.corr(x, y).alias("correlation")).alias(f"c{k}")
        for k, (a, b, x, y) in enumerate(pairs)
    ]
    wide = df.agg(*parts)
    return wide.select(F.inline(F.array(*wide.columns)))
