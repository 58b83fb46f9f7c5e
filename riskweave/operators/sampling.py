"""Deterministic sampling and splitting keyed on a column.

``DataFrame.sample`` / ``randomSplit`` draw per partition, so the same seed
gives other rows after a repartition or a recomputed task.  Here a row's
draw is a hash of its key and a salt: the same on any cluster, in any
partitioning, and when a lost task is recomputed.  It is a narrow filter
(no shuffle) and stays in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCALE = float(2**32)


def unit_hash(key: str | Column, salt: str) -> Column:
    """A uniform draw in [0, 1) from the key: the first 32 bits of
    md5(key || ':' || salt).  NULL keys give NULL (never sampled)."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(_SCALE)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Rows whose draw is below ``fraction`` (Bernoulli without replacement)."""
    return df.where(unit_hash(key, f"sample{seed}") < fraction)


def split_label(key: str, weights: tuple[float, ...] = (0.8, 0.2), names: tuple[str, ...] = ("train", "test"),
                seed: int = 42) -> Column:
    """Label each row with the split its draw falls into."""
    total = float(sum(weights))
    u = unit_hash(key, f"split{seed}")
    edge, expr = 0.0, None
    for w, name in zip(weights[:-1], names[:-1]):
        edge += w / total
        expr = F.when(u < edge, F.lit(name)) if expr is None else expr.when(u < edge, F.lit(name))
    last = F.lit(names[-1])
    return last if expr is None else expr.otherwise(last)


def hash_split(df: DataFrame, key: str, weights: tuple[float, ...] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Disjoint splits with the given weights (like ``randomSplit``)."""
    names = tuple(f"s{i}" for i in range(len(weights)))
    labelled = df.withColumn("_split", split_label(key, weights, names, seed))
    return [labelled.where(F.col("_split") == n).drop("_split") for n in names]
