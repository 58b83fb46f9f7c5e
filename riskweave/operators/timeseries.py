"""Window features and simple forecasts over the monthly trend table.

The trend table is already aggregated (months x policy types: bounded by
the calendar, not by the claim volume), so per-policy windows hold a few
hundred rows each whatever the data size.  Lags and the moving average
share one window spec, so Spark plans a single sort and exchange for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trend_features(
    trends: DataFrame,
    value: str = "claim_count",
    partition: str = "policy_type",
    order: str = "claim_month",
    window_rows: int = 3,
) -> DataFrame:
    """Add ``prev_<value>``, ``prev2_<value>`` (LAG 1, 2) and
    ``rolling_avg_3m`` (mean over the current and the 2 preceding ROWS;
    partial frames at the start are kept)."""
    w = Window.partitionBy(partition).orderBy(order)
    return (
        trends.withColumn(f"prev_{value}", F.lag(value, 1).over(w))
        .withColumn(f"prev2_{value}", F.lag(value, 2).over(w))
        .withColumn("rolling_avg_3m", F.avg(value).over(w.rowsBetween(-(window_rows - 1), 0)))
    )


def month_spine(
    trends: DataFrame,
    value: str = "claim_count",
    partition: str = "policy_type",
    order: str = "claim_month",
) -> DataFrame:
    """Fill months missing inside each policy's first..last month with 0, so
    a row frame of 3 rows is 3 calendar months."""
    bounds = trends.groupBy(partition).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    spine = bounds.select(
        partition,
        F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH"))).alias(order),
    )
    return spine.join(trends, [partition, order], "left").fillna({value: 0})


def rolling_forecast(features: DataFrame, partition: str = "policy_type", order: str = "claim_month") -> DataFrame:
    """Next-month forecast per policy = the moving average of its latest month."""
    latest = F.max_by(F.struct(order, "claim_count", "rolling_avg_3m"), order)
    return features.groupBy(partition).agg(latest.alias("_l")).select(
        partition,
        F.col(f"_l.{order}").alias(order),
        F.col("_l.claim_count").alias("claim_count"),
        F.col("_l.rolling_avg_3m").alias("forecast_next_month_claim_count"),
    )


def monthly_total(features: DataFrame, value: str = "claim_count", order: str = "claim_month") -> DataFrame:
    """Total per month over all policies, with the time index t = 0..n-1.

    The global ordering window runs over the aggregated month table (one
    row per month), a bounded input.
    """
    totals = features.groupBy(order).agg(F.sum(value).alias(value))
    return totals.withColumn("t", F.row_number().over(Window.orderBy(order)) - 1)


def linear_trend_forecast(totals: DataFrame, value: str = "claim_count", digits: int | None = 6) -> DataFrame:
    """Least-squares line through (t, value); forecast at t = max(t) + 1.

    One row: n_months, slope, intercept, next_t, forecast_next_month.
    """
    y = F.col(value).cast("double")
    t = F.col("t").cast("double")
    fit = totals.agg(
        F.count(F.lit(1)).alias("n_months"),
        F.regr_slope(y, t).alias("slope"),
        F.regr_intercept(y, t).alias("intercept"),
        (F.max("t") + 1).alias("next_t"),
    )
    forecast = F.col("slope") * F.col("next_t") + F.col("intercept")
    out = fit.withColumn("forecast_next_month", forecast)
    if digits is not None:
        for c in ("slope", "intercept", "forecast_next_month"):
            out = out.withColumn(c, F.round(c, digits))
    return out
