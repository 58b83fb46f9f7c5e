"""Table-wide scores: z-score and tie-aware percentile rank.

Both are defined over the whole table (not per partition or batch), so the
value of a row never depends on how the data is split.

* z-score: one aggregate pass gives mean and population sd; the two
  scalars come back to the driver and enter the plan as literals.
* percentile: exact average rank of ties, ``avg_rank / n * 100``, without
  a single-task global window.  Values are first collapsed to
  (value, count) so a value held by a third of the table is one row.  The
  distinct values are range-bucketed with bounds from ``approxQuantile``
  (equal values always share a bucket, so any bounds give exact ranks);
  per-bucket counts (one row per bucket) give each bucket's offset, and a
  window partitioned by bucket gives the rank inside it.  The rank table
  joins back to the rows on the value.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.operators.joins import skew_aware_join

MAX_BUCKETS = 4096


def zscore_stats(df: DataFrame, col: str) -> tuple[float | None, float | None]:
    """(mean, population sd) of the values of ``col``; NULL and NaN are
    omitted (a NaN row keeps a NaN z-score)."""
    x = F.col(col).cast("double")
    clean = F.when(~F.isnan(x), x)
    row = df.agg(F.avg(clean).alias("m"), F.stddev_pop(clean).alias("s")).first()
    return row["m"], row["s"]


def default_buckets(df: DataFrame, most: int = MAX_BUCKETS) -> int:
    """One bucket per shuffle partition, at most ``most``, so the quantile sketch and
    the split array stay small on a cluster with huge partition counts; any
    number gives the same ranks, a larger one more tasks."""
    return max(1, min(most, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))))


def score_stats(df: DataFrame, col: str, buckets: int | None = None) -> tuple:
    """(mean, population sd, bucket bounds) of ``col`` in ONE aggregate pass:
    the z-score statistics (NULL and NaN omitted) and ``percentile_approx``
    bounds for the percentile's buckets."""
    buckets = buckets or default_buckets(df)
    x = F.col(col).cast("double")
    clean = F.when(~F.isnan(x), x)
    aggs = [F.avg(clean).alias("m"), F.stddev_pop(clean).alias("s")]
    probs = [i / buckets for i in range(1, buckets)]
    if probs:
        aggs.append(F.percentile_approx(clean, F.array(*[F.lit(p) for p in probs]), 4 * buckets).alias("b"))
    row = df.agg(*aggs).first()
    bounds = list(row["b"] or []) if probs else []
    return row["m"], row["s"], bounds


def with_zscore(df: DataFrame, col: str, out: str, digits: int | None = None,
                stats: tuple | None = None) -> DataFrame:
    """Add ``(col - mean) / sd``; NULL when the value is NULL or sd is 0.
    ``stats`` = (mean, sd) when already computed (see ``score_stats``)."""
    mean, sd = stats if stats is not None else zscore_stats(df, col)
    if mean is None or sd is None or sd == 0:
        z = F.lit(None).cast("double")
    else:
        z = (F.col(col).cast("double") - F.lit(mean)) / F.lit(sd)
    if digits is not None:
        z = F.round(z, digits)
    return df.withColumn(out, z)


def percentile_table(df: DataFrame, col: str, out: str, buckets: int | None = None,
                     bounds: list | None = None) -> DataFrame:
    """(value, percentile) for every distinct non-null value of ``col``.
    ``bounds`` = precomputed bucket bounds (any bounds give exact ranks)."""
    buckets = max(1, buckets or default_buckets(df))
    x = "_pv"
    values = df.select(F.col(col).cast("double").alias(x)).where(F.col(x).isNotNull())

    if bounds is None:
        probs = [i / buckets for i in range(1, buckets)]
        bounds = values.approxQuantile(x, probs, 1.0 / (4 * buckets)) if probs else []
    bounds = sorted({b for b in bounds if b == b and b not in (float("inf"), float("-inf"))})
    splits = [float("-inf")] + bounds + [float("inf")]

    def bucketize(frame: DataFrame) -> DataFrame:
        if not bounds:
            return frame.withColumn("_b", F.lit(0.0))
        return Bucketizer(splits=splits, inputCol=x, outputCol="_b", handleInvalid="keep").transform(frame)

    # (value, count): a hot value is one row from here on.  Both uses below
    # share this grouping's exchange, so the values are read once.
    bucketed = bucketize(values.groupBy(x).agg(F.count(F.lit(1)).alias("_c")))
    # One row per bucket (a proven bound), so the global window over it is
    # tiny and broadcasting it is safe.
    per_bucket = bucketed.groupBy("_b").agg(F.sum("_c").alias("_bc"))
    ordered = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "_b",
        F.coalesce(F.sum("_bc").over(ordered), F.lit(0)).alias("_off"),
        F.sum("_bc").over(Window.partitionBy()).alias("_n"),
    )

    in_bucket = Window.partitionBy("_b").orderBy(x).rowsBetween(Window.unboundedPreceding, 0)
    ranked = bucketed.join(F.broadcast(offsets), "_b").withColumn("_le", F.sum("_c").over(in_bucket))
    # average rank of the tie group = first rank + (ties - 1) / 2
    avg_rank = (F.col("_off") + F.col("_le") - F.col("_c") + 1).cast("double") + (F.col("_c") - 1) / 2.0
    return ranked.select(F.col(x), (avg_rank / F.col("_n") * 100.0).alias(out))


def with_percentile(df: DataFrame, col: str, out: str, buckets: int | None = None,
                    hot_key_fraction: float | None = None, bounds: list | None = None) -> DataFrame:
    """Add the tie-aware percentile (0, 100] of ``col``; NULL stays NULL.

    The join back is on the value: a value held by a large share of the rows
    is split off by AQE's skew join, or explicitly with ``hot_key_fraction``
    (see ``joins.skew_aware_join``).  NULL rows take no part in the join, as
    they would all meet in one of its partitions."""
    table = percentile_table(df, col, out, buckets, bounds)
    keyed = df.withColumn("_pv", F.col(col).cast("double"))
    valued = skew_aware_join(
        keyed.where(F.col("_pv").isNotNull()), table, "_pv", "left", hot_key_fraction=hot_key_fraction
    )
    without = keyed.where(F.col("_pv").isNull()).withColumn(out, F.lit(None).cast("double"))
    return valued.unionByName(without).drop("_pv")
