"""Aggregate expressions with order-independent results.

A DOUBLE sum depends on the order partitions are merged in, and at
billions of rows it cannot even hold cents.  Money is therefore summed as
DECIMAL, which is exact and associative, so the result is the same on 8
threads or 1000 executors; it stays a partial (map-side) + final
aggregate like any other sum.  Amounts enter at ``MONEY_SCALE`` digits, far
below a cent, so that only the result is rounded, as in ROUND(SUM(x), 2).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


MONEY_PRECISION, MONEY_SCALE = 28, 8


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _money(c: str | Column) -> Column:
    return _c(c).cast(f"decimal({MONEY_PRECISION},{MONEY_SCALE})")


def money_sum(c: str | Column, digits: int = 2) -> Column:
    """Exact sum of an amount rounded once, half-up, to ``digits``, as DOUBLE."""
    return F.round(F.sum(_money(c)), digits).cast("double")


def money_avg(c: str | Column, digits: int = 2) -> Column:
    """Mean of an amount from its exact sum, rounded half-up to ``digits``, as DOUBLE.

    Nulls are skipped as in AVG.
    """
    return F.round(F.sum(_money(c)) / F.count(_c(c)), digits).cast("double")


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (BIGINT)."""
    return F.count_if(cond)
