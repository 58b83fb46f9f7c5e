"""Risk-band expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band thresholds and labels.
HIGH_THRESHOLD = 0.85
MEDIUM_THRESHOLD = 0.60
BANDS = ("LOW", "MEDIUM", "HIGH")


def risk_band(score: str | Column, high: float = HIGH_THRESHOLD, medium: float = MEDIUM_THRESHOLD) -> Column:
    """HIGH if score >= high, MEDIUM if >= medium, else LOW.

    A NULL score falls through to LOW; NaN sorts above every number in
    Spark, so it is HIGH.
    """
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s >= high, F.lit("HIGH")).when(s >= medium, F.lit("MEDIUM")).otherwise(F.lit("LOW"))
