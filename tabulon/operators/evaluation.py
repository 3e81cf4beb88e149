"""Metrics of scored tables. Columns: true label, predicted label, probability array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.ranks import running_totals
from tabulon.operators.cleaning import require_columns

EPSILON = 2.220446049250313e-16


def probability_of(labels: Sequence, label: Column, probabilities: Column) -> Column:
    """Element of the probability array that belongs to the row's label."""
    return F.get(probabilities, (F.array_position(F.array(*[F.lit(v) for v in labels]), label) - 1).cast("int"))


def _unknown(true: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"no probability for the value of {true!r}: "), F.coalesce(F.col(true).cast("string"), F.lit("null"))))


def log_loss(df: DataFrame, labels: Sequence, true: str, probabilities: str) -> DataFrame:
    """Mean of -ln p(true label), p kept away from 0 and 1. A true label that is unknown or null is an error."""
    p = probability_of(labels, F.col(true), F.col(probabilities))
    p = F.when(p.isNull(), _unknown(true).cast("double")).otherwise(p)
    kept = F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1 - EPSILON))
    return df.agg((-F.avg(F.ln(kept))).alias("log_loss"))


def outcome_counts(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """(truth, predicted, n): everything below needs only these few rows."""
    require_columns(df, [true, predicted])
    if (df.schema[true].dataType.typeName() == "string") != (df.schema[predicted].dataType.typeName() == "string"):
        raise ValueError("true and predicted labels are not of the same kind")
    return df.groupBy(F.col(true).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion(df: DataFrame, labels: Sequence, true: str, predicted: str) -> DataFrame:
    """One row per true label, one column ``pred_<label>`` per predicted label, zeros kept."""
    all_labels = F.array(*[F.lit(v) for v in labels])
    grid = df.sparkSession.range(1).select(F.explode(all_labels).alias("truth"))
    grid = grid.select("truth", F.lit(labels[0]).alias("predicted"), F.lit(0).cast("long").alias("n"))
    counts = outcome_counts(df, true, predicted).unionByName(grid).where(F.col("truth").isin(*labels))
    return counts.groupBy("truth").agg(
        *[F.coalesce(F.sum(F.when(F.col("predicted") == v, F.col("n"))), F.lit(0)).alias(f"pred_{v}") for v in labels]
    )


def per_class_scores(counts: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support) from outcome counts, 0/0 being 0."""
    both = F.array(
        F.struct(
            F.col("truth").alias("label"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("called"),
            F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("predicted").alias("label"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("called"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    sums = (
        counts.select(F.inline(both))
        .groupBy("label")
        .agg(*[F.sum(c).cast("double").alias(c) for c in ("support", "called", "hits")])
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return sums.select(
        "label",
        ratio(F.col("hits"), F.col("called")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("called") + F.col("support")).alias("f1"),
        F.col("support").cast("long").alias("support"),
        "hits",
    )


def _weighted(column: str) -> Column:
    return F.sum(F.col(column) * F.col("support")) / F.sum("support")


def label_metrics(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Accuracy and support-weighted F1, precision and recall in one row."""
    scores = per_class_scores(outcome_counts(df, true, predicted))
    return scores.agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        _weighted("f1").alias("f1"),
        _weighted("precision").alias("precision"),
        _weighted("recall").alias("recall"),
    )


def classification_report(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted averages.

    Every class adds its share to its own row and to the three summary rows, so that one pass
    over the few class scores gives them all.
    """
    columns = ("precision", "recall", "f1")

    def share(label: Column, weight: Column, *values: Column):
        parts = [(v * weight).alias(f"_{c}") for c, v in zip(columns, values)]
        return F.struct(label.alias("label"), weight.alias("_weight"), *parts, F.col("support").alias("support"))

    own = [F.col(c) for c in columns]
    one, support = F.lit(1.0), F.col("support").cast("double")
    hit_rate = F.when(support > 0, F.col("hits") / support).otherwise(F.lit(0.0))
    shares = F.array(
        share(F.col("label").cast("string"), one, *own),
        share(F.lit("accuracy"), support, hit_rate, hit_rate, hit_rate),
        share(F.lit("macro avg"), one, *own),
        share(F.lit("weighted avg"), support, *own),
    )
    scores = per_class_scores(outcome_counts(df, true, predicted))
    return (
        scores.select(F.inline(shares))
        .groupBy("label")
        .agg(*[(F.sum(f"_{c}") / F.sum("_weight")).alias(c) for c in columns], F.sum("support").alias("support"))
    )


def auc_one_vs_one(df: DataFrame, labels: Sequence, true: str, probabilities: str) -> DataFrame:
    """Mean area under the ROC curve over class pairs, weighted by how many rows a pair has.

    For a pair (a, b) the area is the mean of ranking a over b by p_a and b over a by p_b. Each
    score column is aggregated by distinct score with one counter per true class; with
    the counts of smaller scores (distributed running totals) every pair's area follows from
    one sum, so a row is shuffled once per class, not once per pair, and ties count half. A true
    label that is unknown or null is an error.
    """
    k = len(labels)
    place = F.coalesce(F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(true)), F.lit(0))
    code = F.when(place > 0, place - 1).otherwise(_unknown(true).cast("long"))
    scores = df.select(code.alias("y"), F.posexplode(probabilities).alias("a", "score"))
    counters = [f"n{b}" for b in range(k)]
    counted = scores.groupBy("a", "score").agg(*[F.count_if(F.col("y") == b).alias(f"n{b}") for b in range(k)])
    totals = running_totals(counted, ["a"], "score", counters)
    own = F.get(F.array(*counters), F.col("a"))
    wins = [F.sum(own * (F.col(f"n{b}_before") + F.col(f"n{b}") / F.lit(2.0))).alias(f"w{b}") for b in range(k)]
    sizes = [F.sum(c).cast("double").alias(c) for c in counters]
    per_score = totals.groupBy("a").agg(*wins, *sizes)
    against = F.posexplode(F.array(*[F.struct(F.col(f"w{b}").alias("w"), F.col(f"n{b}").alias("n")) for b in range(k)]))
    pairs = (
        per_score.select("a", F.get(F.array(*counters), F.col("a")).alias("n_a"), against.alias("b", "other"))
        .where("a <> b")
        .select(
            F.least("a", "b").alias("first"),
            F.greatest("a", "b").alias("second"),
            F.when(F.col("n_a") * F.col("other.n") > 0, F.col("other.w") / (F.col("n_a") * F.col("other.n"))).alias("auc"),
            (F.col("n_a") + F.col("other.n")).alias("rows"),
        )
    )
    by_pair = pairs.groupBy("first", "second").agg(F.avg("auc").alias("auc"), F.max("rows").alias("rows"))
    weight = F.when(F.col("auc").isNotNull(), F.col("rows"))
    return by_pair.agg((F.sum(F.col("auc") * weight) / F.sum(weight)).alias("roc_auc"))


def auc_binary(df: DataFrame, flag: str, score: str) -> DataFrame:
    """Probability that a flagged row scores above an unflagged one, ties counting half."""
    counted = (
        df.where(F.col(flag).isNotNull() & F.col(score).isNotNull())
        .groupBy(score)
        .agg(F.count_if(F.col(flag) == 1).alias("_pos"), F.count_if(F.col(flag) == 0).alias("_neg"))
    )
    totals = running_totals(counted, [], score, ["_neg"])
    wins = F.sum(F.col("_pos") * (F.col("_neg_before") + F.col("_neg") / F.lit(2.0)))
    return totals.agg((wins / (F.sum("_pos").cast("double") * F.sum("_neg"))).alias("auc"))


def evaluate(df: DataFrame, labels: Sequence, true: str, predicted: str, probabilities: str | None) -> dict[str, float]:
    """All metrics, rounded to 4 digits; those that need probabilities are left out without them.

    The other metrics ride along as scalar subqueries, so that Spark runs them side by side.
    """
    found = label_metrics(df, true, predicted)
    if probabilities:
        found = found.select(
            "*",
            log_loss(df, labels, true, probabilities).scalar().alias("log_loss"),
            auc_one_vs_one(df, labels, true, probabilities).scalar().alias("roc_auc"),
        )
    return {name: round(value, 4) for name, value in found.first().asDict().items() if value is not None}


def batch_accuracy(df: DataFrame, batch: str, true: str, predicted: str) -> DataFrame:
    hit = (F.col(true) == F.col(predicted)).cast("double")
    return df.groupBy(batch).agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))
