"""Model and rule metrics as aggregates: exact AUC, confusion-based metrics, errors.

* ``rank_auc`` is the rank-sum AUC with ties averaged.  Rows first collapse to
  (score -> positives, negatives), so a score held by a third of the rows is
  one row a task before the shuffle.  The distinct scores fall into ranges
  (any bounds give the exact result, as equal scores share a range); a range's
  offset is the negatives of the ranges below, one row a range, and a window
  partitioned by range ranks inside it.  All sums are integers, so the result
  does not depend on partitioning.  Nothing is sampled or binned.
* ``class_metrics`` reads accuracy, precision, recall and the weighted F1 off
  one table of (actual, predicted) counts.
* ``error_metrics`` gives RMSE and MAE from one aggregate.

Rows without a score, label, actual or predicted value take no part.  A metric
that is undefined (one class only, no rows) is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.operators.scoring import default_buckets

_EXACT = "decimal(38,0)"


def _counts_of_scores(df: DataFrame, score: Column, positive: Column, by: Sequence[str], weight: Column | None) -> DataFrame:
    rows = df.select(
        *by, score.cast("double").alias("_s"), positive.cast("boolean").alias("_y"), (F.lit(1) if weight is None else weight).cast("long").alias("_w")
    ).where(F.col("_s").isNotNull() & F.col("_y").isNotNull())
    hit = F.when(F.col("_y"), F.col("_w")).otherwise(0)
    return rows.groupBy(*by, "_s").agg(F.sum(hit).alias("_p"), F.sum(F.col("_w") - hit).alias("_q"))


def rank_auc(
    df: DataFrame,
    score: Column,
    positive: Column,
    by: Sequence[str] = (),
    weight: Column | None = None,
    buckets: int | None = None,
    bounds: Sequence[float] | None = None,
) -> DataFrame:
    """``*by, positives, negatives, auc``: one row a group of ``by`` (one row over all without).

    ``weight`` counts a row several times (already collapsed rows); ``bounds``
    are range bounds known beforehand, as from ``scoring.score_stats``.
    """
    by = list(by)
    counts = _counts_of_scores(df, score, positive, by, weight)
    if bounds is None:
        buckets = max(1, buckets or default_buckets(df))
        probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
        told = counts.agg(F.percentile_approx("_s", probs, 4 * buckets).alias("b")).first() if buckets > 1 else None
        bounds = (told["b"] or []) if told else []
    bounds = sorted({b for b in bounds if b == b})
    cut = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")
    placed = counts.withColumn("_r", F.size(F.filter(cut, lambda b: b < F.col("_s"))))
    # one row a range and group
    of_range = placed.groupBy(*by, "_r").agg(F.sum("_q").alias("_rq"))
    below = Window.partitionBy(*by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = of_range.select(*by, "_r", F.coalesce(F.sum("_rq").over(below), F.lit(0)).alias("_off"))
    offsets = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in [*by, "_r"]], "_off")
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in [*by, "_r"]]
    joined = placed.join(offsets, reduce(Column.__and__, same)).drop(*[f"_o_{c}" for c in [*by, "_r"]])
    inside = Window.partitionBy(*by, "_r").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.col("_off") + F.coalesce(F.sum("_q").over(inside), F.lit(0))
    # twice the pairs won, a tie counting as half a pair
    won = F.col("_p").cast(_EXACT) * (2 * F.col("_lower") + F.col("_q")).cast(_EXACT)
    summed = joined.withColumn("_lower", lower).groupBy(*by).agg(
        F.coalesce(F.sum("_p"), F.lit(0)).alias("positives"), F.coalesce(F.sum("_q"), F.lit(0)).alias("negatives"), F.sum(won.cast(_EXACT)).alias("_won")
    )
    pairs = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    auc = F.when(pairs > 0, F.col("_won").cast("double") / pairs)
    return summed.select(*by, "positives", "negatives", auc.alias("auc"))


def confusion_counts(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """``*by, actual, predicted, n``; rows without an actual or predicted value are left out."""
    n = F.count("*") if weight is None else F.sum(weight)
    known = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return known.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(n.alias("n"))


def class_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``*by, rows, accuracy, precision, recall, f1`` from confusion counts.

    Precision, recall and F1 are means over the actual classes, weighted by
    their rows; a class that is never predicted has precision 0.
    """
    by = list(by)
    # a row a class: classes, not rows, are joined and grouped from here on
    side = counts.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("n").alias("real"), F.lit(0).cast("long").alias("said")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("real"), F.col("n").alias("said")),
            )
        ).alias("c"),
        F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
    )
    # every count stands in both structs, so a hit is seen twice
    of_class = side.groupBy(*by, F.col("c.class").alias("class")).agg(
        F.sum("c.real").alias("real"), F.sum("c.said").alias("said"), (F.sum("hit") / 2).alias("hit")
    )
    share = F.when(F.col("said") > 0, F.col("hit") / F.col("said")).otherwise(0.0)
    found = F.when(F.col("real") > 0, F.col("hit") / F.col("real")).otherwise(0.0)
    f1 = F.when(F.col("real") + F.col("said") > 0, 2 * F.col("hit") / (F.col("real") + F.col("said"))).otherwise(0.0)
    total = F.sum("real")
    return of_class.groupBy(*by).agg(
        F.coalesce(total, F.lit(0)).alias("rows"),
        *[
            F.when(total > 0, F.sum(x * F.col("real")) / total).alias(name)
            for name, x in (("accuracy", found), ("precision", share), ("recall", found), ("f1", f1))
        ],
    )


def error_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """``*by, rows, rmse, mae`` over the rows with both values."""
    off = F.col(actual) - F.col(predicted)
    known = df.where(off.isNotNull())
    return known.groupBy(*by).agg(F.count("*").alias("rows"), F.sqrt(F.avg(off * off)).alias("rmse"), F.avg(F.abs(off)).alias("mae"))
