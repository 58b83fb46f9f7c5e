"""Calendar column functions, all native Catalyst expressions.

Each function is written once as a Spark SQL expression template and used
two ways: as a ``Column`` (``F.expr``) from the DataFrame API, and as a SQL
function (``register_sql_functions``) whose body Spark inlines into the
plan.  Neither path leaves the JVM, so filters on these columns push down
and the expressions stay inside whole-stage codegen.  Arguments may be
DATE, TIMESTAMP or TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

DEFAULT_BOOK_END = "2024-12-31 00:00:00"
DEFAULT_BASE_YEAR = 2022


def _fixed_date_holiday(d: str) -> str:
    """US federal holidays on a fixed calendar date (before observance),
    as month * 100 + day.

    Fixed values: 1 Jan, 4 Jul, 11 Nov, 25 Dec; 19 Jun from 2021.
    """
    md = f"(month({d}) * 100 + dayofmonth({d}))"
    return f"({md} IN (101, 704, 1111, 1225) OR ({md} = 619 AND year({d}) >= 2021))"


def _weekday_rule_holiday(d: str) -> str:
    """US federal holidays defined as the n-th (or last) weekday of a month.

    Fixed values (dayofweek: 1 = Sunday, 2 = Monday, 5 = Thursday; the
    Monday rules as month * 10 + n): 3rd Monday of January (13, from 1986),
    3rd Monday of February (23), 1st Monday of September (91), 2nd Monday
    of October (102), last Monday of May (day >= 25), 4th Thursday of
    November.
    """
    nth = f"((dayofmonth({d}) + 6) div 7)"
    return (
        f"((dayofweek({d}) = 2 AND ((month({d}) * 10 + {nth} IN (13, 23, 91, 102)"
        f" AND (month({d}) <> 1 OR year({d}) >= 1986))"
        f" OR (month({d}) = 5 AND dayofmonth({d}) >= 25)))"
        f" OR (dayofweek({d}) = 5 AND month({d}) = 11 AND {nth} = 4))"
    )


def is_us_federal_holiday_sql(arg: str) -> str:
    """SQL text: true when the date of ``arg`` is a US federal holiday, its
    actual date or its observed date (a Saturday holiday is observed the
    Friday before, a Sunday holiday the Monday after; so 31 Dec counts when
    1 Jan is a Saturday).  NULL in, NULL out.  Rules hold from 1986 on.

    Kept compact on purpose: a small expression keeps the generated code of
    a wide projection under the JIT's method-size limit."""
    d = f"to_date({arg})"
    return (
        f"CASE WHEN {arg} IS NULL THEN CAST(NULL AS BOOLEAN) ELSE ("
        f"{_fixed_date_holiday(d)} OR {_weekday_rule_holiday(d)}"
        f" OR (dayofweek({d}) = 6 AND {_fixed_date_holiday(f'date_add({d}, 1)')})"
        f" OR (dayofweek({d}) = 2 AND {_fixed_date_holiday(f'date_sub({d}, 1)')})) END"
    )


def months_to_book_end_sql(arg: str, book_end: str = DEFAULT_BOOK_END) -> str:
    """SQL text: whole calendar months from ``arg`` to ``book_end``, truncated
    toward zero (negative after the book end).

    Start from the calendar-month difference; if adding it to ``arg`` (day
    clamped to the month's end, time kept) overshoots the book end, step one
    month back toward ``arg``.
    """
    end = f"TIMESTAMP_NTZ'{book_end}'"
    ts = f"CAST({arg} AS TIMESTAMP_NTZ)"
    cal = f"((year({end}) - year({ts})) * 12 + month({end}) - month({ts}))"
    shifted = f"timestampadd(MONTH, {cal}, {ts})"
    return (
        f"CASE WHEN {arg} IS NULL THEN CAST(NULL AS INT)"
        f" WHEN {ts} <= {end} AND {shifted} > {end} THEN {cal} - 1"
        f" WHEN {ts} > {end} AND {shifted} < {end} THEN {cal} + 1"
        f" ELSE {cal} END"
    )


def _name(c: str | Column) -> str:
    if isinstance(c, str):
        return f"`{c}`" if c.isidentifier() else c
    raise TypeError("pass the column name (or a SQL expression string)")


def is_us_federal_holiday(c: str) -> Column:
    return F.expr(is_us_federal_holiday_sql(_name(c)))


def months_to_book_end(c: str, book_end: str = DEFAULT_BOOK_END) -> Column:
    return F.expr(months_to_book_end_sql(_name(c), book_end))


def month_start(c: str | Column) -> Column:
    """First instant of the month (TIMESTAMP, in the session time zone)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("MONTH", col)


def month_ordinal(c: str | Column, base_year: int = DEFAULT_BASE_YEAR) -> Column:
    """``(year - base_year) * 12 + month``: a time index for month rows."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.year(col) - F.lit(base_year)) * 12 + F.month(col)


def register_sql_functions(spark: SparkSession, book_end: str = DEFAULT_BOOK_END) -> None:
    """Register ``is_us_federal_holiday(ts)`` and ``months_to_book_end(ts)``
    as session SQL functions (SQL bodies, inlined by the analyzer)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION is_us_federal_holiday(d TIMESTAMP_NTZ) "
        f"RETURNS BOOLEAN RETURN {is_us_federal_holiday_sql('d')}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION months_to_book_end(d TIMESTAMP_NTZ) "
        f"RETURNS INT RETURN {months_to_book_end_sql('d', book_end)}"
    )
