"""Silver cleansing of the raw customers and claims tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.calendar import (
    DEFAULT_BOOK_END,
    is_us_federal_holiday,
    month_start,
    months_to_book_end,
)
from riskweave.functions.risk import HIGH_THRESHOLD, MEDIUM_THRESHOLD, risk_band
from riskweave.operators.scoring import score_stats, with_percentile, with_zscore

# Claim statuses kept by silver, exact case, tested before tidying.
VALID_CLAIM_STATUSES = ("Approved", "Pending", "Denied", "In Review")

SILVER_CUSTOMER_COLUMNS = [
    "customer_id",
    "age",
    "state",
    "fraud_risk_score",
    "fraud_risk_zscore",
    "fraud_risk_percentile",
    "fraud_risk_band",
]

SILVER_CLAIM_COLUMNS = [
    "claim_id",
    "policy_id",
    "customer_id",
    "claim_date",
    "claim_amount",
    "claim_status",
    "policy_type",
    "claim_type",
    "is_us_federal_holiday",
    "months_to_book_end",
    "claim_month",
]


def customers_base(
    customers: DataFrame,
    min_age: int = 18,
    max_age: int = 100,
    high: float = HIGH_THRESHOLD,
    medium: float = MEDIUM_THRESHOLD,
) -> DataFrame:
    """Filter and tidy customers, add the risk band (no table-wide scores).

    The age range is tested before the INT cast (so 100.0 passes, 17.9 fails);
    ``state`` must be non-null before trimming.
    """
    return (
        customers.where(F.col("customer_id").isNotNull() & F.col("state").isNotNull())
        .where(F.col("age").between(min_age, max_age))
        .withColumn("age", F.col("age").cast("int"))
        .withColumn("state", F.upper(F.trim(F.col("state"))))
        .withColumn("fraud_risk_score", F.col("fraud_risk_score").cast("double"))
        .withColumn("fraud_risk_band", risk_band("fraud_risk_score", high, medium))
    )


def silver_customers(
    customers: DataFrame,
    processed_at: Column | None = None,
    score_digits: int | None = None,
    percentile_buckets: int | None = None,
    hot_key_fraction: float | None = None,
    **base_kwargs,
) -> DataFrame:
    """``silver_customers``: cleansed customers with table-wide z-score and
    percentile of ``fraud_risk_score``.  ``processed_at`` (e.g.
    ``F.current_timestamp()``) adds ``silver_processed_at``.  A score held by
    ``hot_key_fraction`` of the rows is split off the percentile's join."""
    base = customers_base(customers, **base_kwargs)
    # one preparatory pass gives the z-score statistics and the bucket bounds
    mean, sd, bounds = score_stats(base, "fraud_risk_score", percentile_buckets)
    scored = with_zscore(base, "fraud_risk_score", "fraud_risk_zscore", digits=score_digits, stats=(mean, sd))
    scored = with_percentile(scored, "fraud_risk_score", "fraud_risk_percentile", buckets=percentile_buckets,
                             hot_key_fraction=hot_key_fraction, bounds=bounds)
    cols = [F.col(c) for c in SILVER_CUSTOMER_COLUMNS]
    if processed_at is not None:
        cols.append(processed_at.alias("silver_processed_at"))
    return scored.select(*cols)


def silver_claims(
    claims: DataFrame,
    statuses: tuple[str, ...] = VALID_CLAIM_STATUSES,
    book_end: str = DEFAULT_BOOK_END,
    processed_at: Column | None = None,
) -> DataFrame:
    """``silver_claims``: required keys present, positive amount, status in
    the allow-list (exact case, before ``upper(trim())``), plus holiday flag,
    months to the book end and the claim month."""
    cols = [
        F.col("claim_id"),
        F.col("policy_id"),
        F.col("customer_id"),
        F.col("claim_date"),
        F.col("claim_amount").cast("double").alias("claim_amount"),
        F.upper(F.trim(F.col("claim_status"))).alias("claim_status"),
        F.col("policy_type"),
        F.col("claim_type"),
        is_us_federal_holiday("claim_date").alias("is_us_federal_holiday"),
        months_to_book_end("claim_date", book_end).alias("months_to_book_end"),
        month_start("claim_date").alias("claim_month"),
    ]
    if processed_at is not None:
        cols.append(processed_at.alias("silver_processed_at"))
    return claims.where(
        F.col("claim_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("claim_date").isNotNull()
        & (F.col("claim_amount") > 0)
        & F.col("claim_status").isin(*statuses)
    ).select(*cols)
