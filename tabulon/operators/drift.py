"""Drift of features and of the target between a reference table and a later one."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.ranks import running_totals
from tabulon.operators.cleaning import require_columns
from tabulon.session import materialize

ALPHA = 0.05
TERMS = 100


def kolmogorov_tail(x: Column) -> Column:
    """P(K > x) of the Kolmogorov distribution: 2 Σ (-1)^(k-1) exp(-2 k² x²), in its other form near 0."""
    terms = F.sequence(F.lit(1), F.lit(TERMS))

    def far_term(k: Column) -> Column:
        return F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x)

    def near_term(k: Column) -> Column:
        return F.exp(-((2 * k - 1) * (2 * k - 1)) * F.lit(math.pi**2 / 8) / (x * x))

    far = F.aggregate(terms, F.lit(0.0), lambda total, k: total + far_term(k))
    near = F.aggregate(terms, F.lit(0.0), lambda total, k: total + near_term(k))
    near = F.lit(1.0) - near * F.lit(math.sqrt(2 * math.pi)) / x
    return F.when(x <= 0, F.lit(1.0)).when(x < 0.5, near).otherwise(F.greatest(F.lit(0.0), far))


def ks_drift(df: DataFrame, current: Column, columns: Sequence[str], alpha: float = ALPHA) -> DataFrame:
    """(feature, n_reference, n_current, statistic, p_value, drifted) per column: two-sample Kolmogorov-Smirnov test of
    the rows where ``current`` is true against those where it is false; rows where it is null are left out.

    The statistic is the largest gap between the two empirical distributions over all values, ties included, and exact:
    each distinct value is counted once per side, the running counts of both sides come from one range-partitioned pass over
    those, and the gap is taken between whole numbers. The p-value is that of the limiting distribution. Null and NaN are left out;
    a column without values on one side has no statistic and has not drifted.
    """
    columns = list(columns)
    require_columns(df, columns)
    sided = df.select(current.cast("boolean").alias("_current"), *[F.col(c).cast("double").alias(c) for c in columns]).where("_current is not null")
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("_v")) for c in columns]
    long = sided.select("_current", F.inline(F.array(*entries))).where("_v is not null and not isnan(_v)")
    sides = {"_reference": ~F.col("_current"), "_new": F.col("_current")}
    counted = long.groupBy("feature", "_v").agg(*[F.count_if(c).alias(name) for name, c in sides.items()])
    walked = materialize(running_totals(counted, ["feature"], "_v", list(sides)))
    totals = walked.groupBy("feature").agg(F.sum("_reference").alias("n_reference"), F.sum("_new").alias("n_current"))
    exact = "decimal(38,0)"

    def reached(name: str, other: str) -> Column:
        return (F.col(f"{name}_before") + F.col(name)).cast("decimal(19,0)") * F.col(other).cast("decimal(18,0)")

    gap = F.abs(reached("_reference", "n_current") - reached("_new", "n_reference")).cast(exact)
    largest = walked.join(F.broadcast(totals), "feature").groupBy("feature", "n_reference", "n_current").agg(F.max(gap).alias("gap"))  # a row a column
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    n, m = (F.coalesce(c, F.lit(0).cast("long")) for c in ("n_reference", "n_current"))
    size = F.col("n_reference").cast("double") * F.col("n_current")
    found = names.join(largest, "feature", "left").select(
        "feature", n.alias("n_reference"), m.alias("n_current"), F.when(size > 0, F.col("gap").cast("double") / size).alias("statistic")
    )
    effective = F.sqrt(F.col("n_reference").cast("double") * F.col("n_current") / (F.col("n_reference") + F.col("n_current")))
    found = found.withColumn("p_value", F.when(F.col("statistic").isNotNull(), kolmogorov_tail(F.col("statistic") * effective)))
    return found.withColumn("drifted", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


def reference_shares(df: DataFrame, target: str) -> DataFrame:
    """(class, share) of the rows with a class: what ``share_drift`` compares with, stored with the model's other tables."""
    require_columns(df, [target])
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("class")).agg(F.count("*").alias("n"))
    return counts.select("class", (F.col("n") / counts.agg(F.sum("n")).scalar()).alias("share"))


def share_drift(df: DataFrame, batch: str, target: str, reference: DataFrame) -> DataFrame:
    """(batch, class, n, share, reference_share, difference, distance) of each class in each batch.

    A class that a batch or the reference lacks has share 0 there and its row all the same. ``distance`` is the batch's
    total variation distance from the reference: half the sum of all differences without sign. Rows without class are left out,
    a batch that has no others is not reported. The rows are aggregated once, to one row per batch and class.
    """
    require_columns(df, [batch, target])
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(batch).alias("batch"), F.col(target).alias("class")).agg(F.count("*").alias("n"))
    per_batch = counts.groupBy("batch").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("class", "n"))).alias("seen"))
    known = reference.agg(F.map_from_entries(F.collect_list(F.struct("class", "share")))).scalar()  # as many as a model has labels
    classes = F.array_union(F.map_keys("known"), F.map_keys("seen"))

    def compared(c: Column) -> Column:
        n = F.coalesce(F.try_element_at("seen", c), F.lit(0).cast("long"))
        expected = F.coalesce(F.try_element_at("known", c), F.lit(0.0))
        share = n / F.col("total")
        return F.struct(c.alias("class"), n.alias("n"), share.alias("share"), expected.alias("reference_share"), (share - expected).alias("difference"))

    rows = per_batch.withColumn("known", known).select("batch", F.transform(classes, compared).alias("rows"))
    distance = F.aggregate("rows", F.lit(0.0), lambda total, r: total + F.abs(r["difference"])) / 2
    return rows.select("batch", distance.alias("distance"), F.inline("rows")).select(
        "batch", "class", "n", "share", "reference_share", "difference", "distance"
    )
