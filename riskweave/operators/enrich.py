"""Silver enrichment: claims joined with their customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.joins import skew_aware_join

ENRICHED_COLUMNS = [
    "claim_id",
    "policy_id",
    "customer_id",
    "claim_date",
    "claim_month",
    "claim_amount",
    "claim_status",
    "policy_type",
    "claim_type",
    "age",
    "state",
    "fraud_risk_score",
    "fraud_risk_band",
]


def enrich_claims(
    claims: DataFrame,
    customers: DataFrame,
    key: str = "customer_id",
    processed_at: Column | None = None,
    hot_key_fraction: float | str | None = "auto",
) -> DataFrame:
    """``silver_claims_enriched``: inner join on ``key``.

    Claims without a matching customer drop out; a customer id repeated in
    ``customers`` repeats its claims (join semantics; the uniqueness
    expectation of the customers suite reports it).  Only the needed
    columns of each side enter the join, so the scans are pruned.
    """
    cl = claims.select(
        key, "claim_id", "policy_id", "claim_date", "claim_month", "claim_amount",
        "claim_status", "policy_type", "claim_type",
    )
    cu = customers.select(key, "age", "state", "fraud_risk_score", "fraud_risk_band")
    joined = skew_aware_join(cl, cu, key, hot_key_fraction=hot_key_fraction)
    cols = [F.col(c) for c in ENRICHED_COLUMNS]
    if processed_at is not None:
        cols.append(processed_at.alias("enriched_at"))
    return joined.select(*cols)
