"""Gold aggregates kept as partial states, merged with new and corrected rows.

A state is a table of one row a group with counts and exact DECIMAL sums, so
states add up in any order and can be subtracted without a trace: loading a
batch is ``state + state(batch)``, and correcting claims is ``- state(rows as
stored) + state(rows as corrected)``.  A change costs a scan of the changed
rows, not of the whole enriched table; the merged state is as large as the
gold table.  The finished columns are those of ``gold.kpi_by_state`` and
``gold.monthly_trends``, rounded once from the exact sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.aggregates import MONEY_PRECISION, MONEY_SCALE
from riskweave.operators.gold import DENIED_STATUS, WATCH_BAND

KPI_GROUP = ("state", "policy_type")
TREND_GROUP = ("claim_month", "policy_type")
#: A sum stays a sum of this type, so that adding and subtracting are exact.
_MONEY = f"decimal({MONEY_PRECISION + 10},{MONEY_SCALE})"
#: Scores are between 0 and 1 as a rule; 18 digits hold every one of a double's.
_SCORE = "decimal(38,18)"

_SUMS = {"n": "bigint", "amount": _MONEY, "amount_n": "bigint", "score": _SCORE, "score_n": "bigint", "high": "bigint", "denied": "bigint"}


def state_of(enriched: DataFrame, group: Sequence[str], band: str = WATCH_BAND, denied: str = DENIED_STATUS) -> DataFrame:
    """The state of the rows: one map-side combined aggregate."""
    money, score = F.col("claim_amount").cast(f"decimal({MONEY_PRECISION},{MONEY_SCALE})"), F.col("fraud_risk_score").cast("decimal(28,18)")
    made = {
        "n": F.count("*"), "amount": F.sum(money), "amount_n": F.count("claim_amount"), "score": F.sum(score), "score_n": F.count("fraud_risk_score"),
        "high": F.count_if(F.col("fraud_risk_band") == band), "denied": F.count_if(F.col("claim_status") == denied),
    }
    return enriched.groupBy(*group).agg(*[F.coalesce(made[c], F.lit(0)).cast(t).alias(c) for c, t in _SUMS.items()])


def merged(group: Sequence[str], added: Sequence[DataFrame], removed: Sequence[DataFrame] = ()) -> DataFrame:
    """The sum of states less the removed ones; a group without rows is gone."""

    def signed(state: DataFrame, sign: int) -> DataFrame:
        return state.select(*group, *[(F.col(c) * sign).cast(t).alias(c) for c, t in _SUMS.items()])

    every = reduce(DataFrame.unionByName, [*[signed(s, 1) for s in added], *[signed(s, -1) for s in removed]])
    return every.groupBy(*group).agg(*[F.sum(c).cast(t).alias(c) for c, t in _SUMS.items()]).where("n <> 0")


def changed(state: DataFrame, group: Sequence[str], stored: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The state after ``rows`` (new or corrected) take the place of the stored rows with their keys.

    A key that repeats among ``rows`` stays repeated; rows without a key replace nothing.
    """
    replaced = stored.join(rows.select(key).distinct(), key, "left_semi")
    return merged(group, [state, state_of(rows, group)], [state_of(replaced, group)])


def _mean(total: str, n: str, digits: int) -> Column:
    return F.when(F.col(n) > 0, F.round(F.col(total) / F.col(n), digits).cast("double"))


def _finished() -> list[Column]:
    return [
        F.col("n").alias("claim_count"),
        F.when(F.col("amount_n") > 0, F.round("amount", 2).cast("double")).alias("total_claim_amount"),
        _mean("amount", "amount_n", 2).alias("avg_claim_amount"),
    ]


def kpi(state: DataFrame) -> DataFrame:
    """``gold_claims_kpi_by_state`` from its state."""
    return state.select(
        *KPI_GROUP, *_finished(), _mean("score", "score_n", 4).alias("avg_fraud_risk_score"),
        F.col("high").alias("high_risk_customer_claims"), F.col("denied").alias("denied_claims"),
    )


def trends(state: DataFrame) -> DataFrame:
    """``gold_monthly_claim_trends`` from its state."""
    return state.select(*TREND_GROUP, *_finished())
