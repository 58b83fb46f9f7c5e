"""Report queries over the layer tables: grouped counts, top-k, the
questions the analysts ask of the gold tables and views.

Top-k uses ``orderBy(...).limit(k)``, which plans as TakeOrderedAndProject:
each task keeps k rows, so no task ever holds a whole table.  Every order
has a unique tie-break so the k rows are well defined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.aggregates import count_where


def grouped_count(df: DataFrame, cols: list[str], out: str = "count") -> DataFrame:
    """Rows per group, most frequent first (group columns break ties)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out)).orderBy(F.col(out).desc(), *cols)


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def claims_by_policy(claims: DataFrame) -> DataFrame:
    """Bronze load check: claims per policy type."""
    return grouped_count(claims, ["policy_type"], "cnt")


def claims_by_state_top(enriched: DataFrame, k: int = 5) -> DataFrame:
    """Enriched claims per state, the k largest."""
    return grouped_count(enriched, ["state"], "claims").limit(k)


def top_by_amount(df: DataFrame, k: int, tie_break: list[str]) -> DataFrame:
    return top_k(df, [F.col("total_claim_amount").desc(), *tie_break], k)


def watchlist_by(watchlist: DataFrame, col: str) -> DataFrame:
    return grouped_count(watchlist, [col], "count")


def watchlist_top(watchlist: DataFrame, k: int = 10) -> DataFrame:
    """Largest watchlist claims (analyst columns)."""
    return top_k(
        watchlist.select("claim_id", "state", "policy_type", "claim_amount", "fraud_risk_score"),
        [F.col("claim_amount").desc(), F.col("claim_id").asc_nulls_last()],
        k,
    )


def status_count(watchlist: DataFrame, status: str = "PENDING") -> DataFrame:
    """Number of watchlist claims with one status (one row)."""
    return watchlist.agg(count_where(F.col("claim_status") == status).alias("claims"))


def policy_compare(kpi: DataFrame, policy_types: tuple[str, ...] = ("Auto", "Home")) -> DataFrame:
    """Claim counts and amounts for a few policy types, from the KPI table."""
    return (
        kpi.where(F.col("policy_type").isin(*policy_types))
        .groupBy("policy_type")
        .agg(
            F.sum("claim_count").alias("claim_count"),
            F.round(F.sum(F.col("total_claim_amount").cast("decimal(18,2)")), 2)
            .cast("double")
            .alias("total_claim_amount"),
        )
    )


def denied_vs_high_risk(kpi: DataFrame, state: str = "CA") -> DataFrame:
    """Denied and high-risk claim counts of one state (one row)."""
    return (
        kpi.where(F.col("state") == state)
        .groupBy("state")
        .agg(
            F.sum("claim_count").alias("claim_count"),
            F.sum("denied_claims").alias("denied_claims"),
            F.sum("high_risk_customer_claims").alias("high_risk_claims"),
        )
    )


def holiday_summary(silver_claims: DataFrame) -> DataFrame:
    """Claims on a federal holiday and mean months to the book end."""
    return silver_claims.agg(
        count_where(F.col("is_us_federal_holiday")).alias("holiday_claims"),
        F.round(F.avg("months_to_book_end"), 2).alias("avg_months_to_book_end"),
    )


def holiday_claims(silver_claims: DataFrame, limit: int | None = None) -> DataFrame:
    """Claims dated on a holiday; ``limit`` gives a peek of n rows."""
    out = silver_claims.where(F.col("is_us_federal_holiday")).select(
        "claim_id", "claim_date", "is_us_federal_holiday", "months_to_book_end", "claim_amount"
    )
    return out.limit(limit) if limit else out


def band_avg_percentile(silver_customers: DataFrame) -> DataFrame:
    return (
        silver_customers.groupBy("fraud_risk_band")
        .agg(F.round(F.avg("fraud_risk_percentile"), 2).alias("avg_pct"))
        .orderBy(F.col("avg_pct").desc(), "fraud_risk_band")
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer: (layer, rows).  Each count is a global aggregate
    (per-task partial counts, one final merge)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
             for name, df in layers.items()]
    return reduce(DataFrame.unionByName, parts)
