"""Raw insurance inputs derived from the driver's TPC-H-style tables.

``customers`` comes from ``customer`` and ``claims`` from ``orders``: one
output row per input row, with deliberately dirty values (null ids and
states, untidy state text, out-of-range ages, null scores, negative
amounts, a status outside the allow-list, 10:00 times of day) so that
every cleansing rule has something to do.  Dates move 23 years forward
so they span 2018..2024 and meet the book end and the 2021 holiday change.

Both are plain projections of one Parquet scan each, so Catalyst prunes
the read to the columns used and pushes filters of later layers into the
scan where the column is a raw one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# State code by nation key modulo 10 (0..9), in order.
FIXTURE_STATE_BY_NATION_MOD = ["CA", "TX", "FL", "NY", "PA", "IL", "OH", "GA", "NC", "MI"]
# Policy type by the first character of o_orderpriority.
FIXTURE_POLICY_BY_PRIORITY = {"1": "Auto", "2": "Home", "3": "Health", "4": "Life"}
FIXTURE_POLICY_OTHER = "Travel"
# Claim type by order key modulo 4 (0..3), in order.
FIXTURE_CLAIM_TYPE_BY_MOD = ["Accident", "Theft", "Illness", "Damage"]

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lookup(key: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v)))
    return expr.otherwise(F.lit(default))


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ``customers``: customer_id, age, state, fraud_risk_score."""
    return customers_from(table(spark, sf_dir, "customer"))


def customers_from(c: DataFrame) -> DataFrame:
    """Raw customers from a ``customer`` DataFrame (batch or stream)."""
    key = F.col("c_custkey")
    st = _lookup(
        F.col("c_nationkey") % 10,
        dict(enumerate(FIXTURE_STATE_BY_NATION_MOD[:-1])),
        FIXTURE_STATE_BY_NATION_MOD[-1],
    )
    return c.select(
        key.alias("customer_id"),
        F.when(key % 60 == 1, F.lit(None).cast("int"))
        .otherwise((F.lit(12) + key % 95).cast("int"))
        .alias("age"),
        F.when(key % 40 == 3, F.lit(None).cast("string"))
        .when(key % 7 == 0, F.concat(F.lit("  "), F.lower(st), F.lit(" ")))
        .otherwise(st)
        .alias("state"),
        F.when(key % 50 == 0, F.lit(None).cast("double"))
        .otherwise((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0))
        .alias("fraud_risk_score"),
    )


def claims_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ``claims``: claim_id, policy_id, customer_id, claim_date,
    claim_amount, claim_status, policy_type, claim_type.

    ``claim_date`` is TIMESTAMP: the source's wall-clock time read in the
    session time zone (UTC in ``build_session``).
    """
    return claims_from(table(spark, sf_dir, "orders"))


def claims_from(o: DataFrame) -> DataFrame:
    """Raw claims from an ``orders`` DataFrame (batch or stream)."""
    key = F.col("o_orderkey")
    shifted = F.col("o_orderdate").cast("timestamp") + F.make_interval(years=F.lit(23))
    claim_date = F.when(key % 3 == 0, shifted + F.make_interval(hours=F.lit(10))).otherwise(shifted)
    status = (
        F.when(key % 20 == 19, F.lit("Cancelled"))
        .when(F.col("o_orderstatus") == "F", F.lit("Approved"))
        .when(F.col("o_orderstatus") == "O", F.lit("Pending"))
        .when(key % 2 == 0, F.lit("Denied"))
        .otherwise(F.lit("In Review"))
    )
    return o.select(
        F.when(key % 97 == 0, F.lit(None).cast("bigint")).otherwise(key).alias("claim_id"),
        (key * 10 + 1).alias("policy_id"),
        F.col("o_custkey").alias("customer_id"),
        claim_date.alias("claim_date"),
        F.when(key % 53 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("claim_amount"),
        status.alias("claim_status"),
        _lookup(F.substring("o_orderpriority", 1, 1), FIXTURE_POLICY_BY_PRIORITY, FIXTURE_POLICY_OTHER).alias(
            "policy_type"
        ),
        _lookup(key % 4, dict(enumerate(FIXTURE_CLAIM_TYPE_BY_MOD[:-1])), FIXTURE_CLAIM_TYPE_BY_MOD[-1]).alias(
            "claim_type"
        ),
    )
