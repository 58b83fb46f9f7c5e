"""Gold aggregates, watchlist and reporting views over the enriched claims.

All aggregates are hash aggregates with a map-side partial step, so a hot
group (one state with a third of the claims) is reduced to one row per
task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.aggregates import count_where, money_avg, money_sum

# Watchlist rules.
WATCH_MIN_AMOUNT = 50000
WATCH_BAND = "HIGH"
WATCH_STATUSES = ("APPROVED", "PENDING", "IN REVIEW")
DENIED_STATUS = "DENIED"

WATCHLIST_COLUMNS = [
    "claim_id",
    "customer_id",
    "state",
    "policy_type",
    "claim_type",
    "claim_amount",
    "claim_status",
    "fraud_risk_score",
    "fraud_risk_band",
    "claim_date",
]


def _built_at(cols: list, built_at: Column | None) -> list:
    return cols + ([built_at.alias("gold_built_at")] if built_at is not None else [])


def kpi_by_state(
    enriched: DataFrame,
    high_band: str = WATCH_BAND,
    denied_status: str = DENIED_STATUS,
    built_at: Column | None = None,
) -> DataFrame:
    """``gold_claims_kpi_by_state``: one row per (state, policy_type).

    ``denied_claims`` compares with the tidied status (upper case), which is
    what silver stores.
    """
    aggs = [
        F.count(F.lit(1)).alias("claim_count"),
        money_sum("claim_amount").alias("total_claim_amount"),
        money_avg("claim_amount").alias("avg_claim_amount"),
        F.round(F.avg("fraud_risk_score"), 4).alias("avg_fraud_risk_score"),
        count_where(F.col("fraud_risk_band") == high_band).alias("high_risk_customer_claims"),
        count_where(F.col("claim_status") == denied_status).alias("denied_claims"),
    ]
    return enriched.groupBy("state", "policy_type").agg(*_built_at(aggs, built_at))


def monthly_trends(enriched: DataFrame, built_at: Column | None = None) -> DataFrame:
    """``gold_monthly_claim_trends``: one row per (claim_month, policy_type)."""
    aggs = [
        F.count(F.lit(1)).alias("claim_count"),
        money_sum("claim_amount").alias("total_claim_amount"),
        money_avg("claim_amount").alias("avg_claim_amount"),
    ]
    return enriched.groupBy("claim_month", "policy_type").agg(*_built_at(aggs, built_at))


def high_risk_watchlist(
    enriched: DataFrame,
    band: str = WATCH_BAND,
    min_amount: float = WATCH_MIN_AMOUNT,
    statuses: tuple[str, ...] = WATCH_STATUSES,
) -> DataFrame:
    """``gold_high_risk_watchlist``: high-band customers' large open or
    approved claims (a narrow filter; no shuffle)."""
    return enriched.where(
        (F.col("fraud_risk_band") == band)
        & (F.col("claim_amount") >= min_amount)
        & F.col("claim_status").isin(*statuses)
    ).select(*WATCHLIST_COLUMNS)


#: The two reporting views, each defined once: session views, catalog views and
#: the DataFrame functions below are this text over the relation named ``{table}``.
EXECUTIVE_VIEW = """
SELECT state,
  SUM(claim_count) AS total_claims,
  CAST(ROUND(SUM(CAST(total_claim_amount AS DECIMAL(28,8))), 2) AS DOUBLE) AS total_claim_amount,
  CAST(ROUND(AVG(CAST(avg_fraud_risk_score AS DECIMAL(18,4))), 4) AS DOUBLE) AS avg_fraud_risk_score,
  SUM(high_risk_customer_claims) AS high_risk_claims,
  SUM(denied_claims) AS denied_claims
FROM {table} GROUP BY state"""
REPORT_COLUMNS = [c for c in WATCHLIST_COLUMNS if c != "fraud_risk_band"]
WATCHLIST_VIEW = f"SELECT {', '.join(REPORT_COLUMNS)} FROM {{table}} ORDER BY claim_amount DESC, claim_id ASC NULLS LAST"


def executive_by_state(kpi: DataFrame) -> DataFrame:
    """``vw_executive_claims_by_state``: KPI rolled up to state.  The score
    is the unweighted mean of the per-policy means (the view's definition)."""
    return kpi.sparkSession.sql(EXECUTIVE_VIEW, table=kpi)


def watchlist_report(watchlist: DataFrame) -> DataFrame:
    """``vw_high_risk_claims_report``: analyst columns, largest claim first
    (claim_id breaks ties so the order is total)."""
    return watchlist.sparkSession.sql(WATCHLIST_VIEW, table=watchlist)
