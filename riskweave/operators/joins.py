"""Equi-joins of a large fact table with a dimension, skew-aware.

Spark broadcasts the dimension when its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` (a checked bound), AQE re-plans with
real sizes after the shuffle map stage, and AQE's skew join splits an
oversized partition of the fact side at map-output boundaries.

A key that holds a large share of the fact rows (one customer with a third of
all claims) is split off beforehand, by default whenever the dimension is too
large to be broadcast whole:

1. one aggregate over the key column keeps the heavy hitters: a bounded,
   mergeable frequency summary (``approx_top_k``) beside the row count, both
   combined map-side, so no key is shuffled.  Every key with at least
   ``hot_key_fraction`` of the rows is in the summary;
2. the dimension rows of those keys are measured in bytes and, within
   ``broadcast_bytes``, broadcast to the hot fact rows, which are not shuffled;
3. every other row takes the normal shuffle join.

The two parts are disjoint by key, so their union is exactly the join, for
whatever keys the summary names (inner or left; for a left join, rows with a
NULL key stay in the shuffle part and keep their NULL columns).  Where the
session forbids broadcasts (threshold -1), or for a stream, the plain join is
left to AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

#: Share of the fact rows from which a key is split off by default.
HOT_KEY_FRACTION = 0.05
#: Entries of the frequency summary for each key that can reach the share; its
#: error, 3.5 / entries of the rows, stays far under the share.
SUMMARY_ENTRIES = 64


def heavy_hitters(fact: DataFrame, key: str, fraction: float) -> list:
    """Keys that hold about ``fraction`` of the rows or more, in one pass (at most ``1 / fraction`` and a few)."""
    most = max(1, int(1 / fraction) + 1)
    entries = 1 << max(10, (SUMMARY_ENTRIES * most - 1).bit_length())
    told = fact.select(F.col(key).alias("_k")).where("_k IS NOT NULL").agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(_k, {most}, {min(entries, 1_000_000)})").alias("top")
    ).first()
    least = told["n"] * (fraction - 3.5 / entries)
    return [r["item"] for r in told["top"] or [] if told["n"] and r["count"] >= least]


def hot_keys(fact: DataFrame, key: str, hot_key_fraction: float) -> list:
    """The heavy hitters, smallest first."""
    return sorted(heavy_hitters(fact, key, hot_key_fraction))


def bytes_of(df: DataFrame) -> int:
    """Bytes of the rows' values: the lengths of texts, eight for any other value."""
    sizes: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        sizes.append(F.coalesce(F.octet_length(c), F.lit(0)) + 8 if isinstance(f.dataType, (StringType, BinaryType)) else F.lit(8))
    total = sizes[0]
    for s in sizes[1:]:
        total = total + s
    return int(df.agg(F.coalesce(F.sum(total.cast("long")), F.lit(0))).first()[0])


def broadcast_limit(df: DataFrame) -> int:
    """The session's bound on automatic broadcasts, in bytes (-1: none allowed)."""
    said = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(said)) if said != "-1" else -1


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a DataFrame's size (no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def skew_aware_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    hot_key_fraction: float | str | None = "auto",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """The join, with hot keys split off: at ``HOT_KEY_FRACTION`` if the dimension is
    too large to broadcast (``"auto"``), at a given share, or never (None)."""
    if how not in ("inner", "left") or not hot_key_fraction or fact.isStreaming or dim.isStreaming:
        return fact.join(dim, key, how)
    limit = broadcast_limit(fact)
    if hot_key_fraction == "auto":
        if limit < 0 or estimated_bytes(dim) <= limit:
            return fact.join(dim, key, how)
        hot_key_fraction = HOT_KEY_FRACTION
    keys = heavy_hitters(fact, key, hot_key_fraction)
    if not keys:
        return fact.join(dim, key, how)
    is_hot = F.col(key).isin(keys)
    hot_dim = dim.where(is_hot)
    if broadcast_bytes is None:
        broadcast_bytes = limit if limit >= 0 else 10 << 20
    if bytes_of(hot_dim) > broadcast_bytes:
        return fact.join(dim, key, how)
    hot = fact.where(is_hot).join(F.broadcast(hot_dim), key, how)
    not_hot = ~is_hot if how == "inner" else (~is_hot | F.col(key).isNull())
    cold = fact.where(not_hot).join(dim.where(~is_hot), key, how)
    return hot.unionByName(cold)
