"""Mergeable column sketches: one state a load, any union without a rescan.

``load_states`` reads a table once and gives, per load and column, the row
counts and two binary sketches: a HyperLogLog of the distinct values and, for
numeric columns, a KLL sketch of the quantiles.  States are ordinary rows (a
few KB each): they are stored with the load that made them, and the distinct
count, unique share or quantile bounds of any set of loads come from the
states alone.  Both sketches merge without loss, so a union of states answers
like one sketch over all rows.

Errors: a distinct estimate lies within ``distinct_error`` of the exact count
(three standard deviations); a KLL quantile's rank error is about 1.7 / k.
Quantile bounds only cut the exact percentile into ranges, so its result does
not depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the HyperLogLog's registers, and the KLL sketch's k.
LG_K, KLL_K = 12, 400
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative error of a distinct estimate that three standard deviations stay under."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def load_states(df: DataFrame, columns: Sequence[str], load: Column, lg_k: int = LG_K, kll_k: int = KLL_K) -> DataFrame:
    """``load, column, rows, nonnull, distinct_state, quantile_state``: a row a load and column.

    One scan; every state is built by a partial aggregate, so only sketches are
    shuffled.  NULL is no value; NaN takes no part in the quantiles.
    """
    kinds = dict(df.dtypes)
    aggs, parts = [F.count("*").alias("rows")], []
    for i, c in enumerate(columns):
        value = F.col(c) if kinds[c] in ("int", "bigint", "string", "binary") else F.col(c).cast("string")
        aggs += [F.count(c).alias(f"_n{i}"), F.hll_sketch_agg(value, lg_k).alias(f"_d{i}")]
        quantiles = F.lit(None).cast("binary")
        if kinds[c] in _NUMERIC:
            x = F.col(c).cast("double")
            aggs.append(F.kll_sketch_agg_double(F.when(~F.isnan(x), x), kll_k).alias(f"_q{i}"))
            quantiles = F.col(f"_q{i}")
        parts.append(
            F.struct(
                F.lit(c).alias("column"), F.col("rows"), F.col(f"_n{i}").alias("nonnull"), F.col(f"_d{i}").alias("distinct_state"),
                quantiles.alias("quantile_state"),
            )
        )
    states = df.groupBy(load.cast("string").alias("load")).agg(*aggs)
    return states.select("load", F.explode(F.array(*parts)).alias("_s")).select("load", "_s.*")


def distinct_counts(states: DataFrame) -> DataFrame:
    """``column, loads, rows, nonnull, estimate`` of the union of the states."""
    return states.groupBy("column").agg(
        F.count("*").alias("loads"), F.sum("rows").alias("rows"), F.sum("nonnull").alias("nonnull"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_state")).alias("estimate"),
    )


def unique_shares(states: DataFrame) -> DataFrame:
    """``column, share, low, high``: distinct by non-null values, and the range it lies in."""
    share = F.col("estimate") / F.col("nonnull")
    off = distinct_error()
    told = distinct_counts(states).where("nonnull > 0")
    return told.select("column", share.alias("share"), (share / (1 + off)).alias("low"), F.least(share / (1 - off), F.lit(1.0)).alias("high"))


def quantile_bounds(states: DataFrame, column: str, buckets: int) -> list[float]:
    """Up to ``buckets - 1`` bounds of equal shares of the column's values, from the states alone."""
    if buckets < 2:
        return []
    ranks = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    own = states.where((F.col("column") == column) & F.col("quantile_state").isNotNull() & (F.col("nonnull") > 0))
    merged = own.agg(F.kll_merge_agg_double("quantile_state").alias("q"), F.sum(F.kll_sketch_get_n_double("quantile_state")).alias("n"))
    row = merged.select(F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("q", ranks)).alias("b")).first()  # ``buckets`` numbers
    return sorted(set(row["b"] or []))
