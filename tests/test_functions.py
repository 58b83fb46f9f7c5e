"""Calendar and risk functions: fixed cases and brute-force cross-checks."""

import calendar as pycal
import datetime as dt

import pytest
from dateutil.relativedelta import relativedelta
from pyspark.sql import functions as F

from riskweave.functions.calendar import (
    is_us_federal_holiday,
    month_ordinal,
    month_start,
    months_to_book_end,
    register_sql_functions,
)
from riskweave.functions.risk import risk_band


def _one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_risk_band_edges(spark):
    rows = [(None,), (float("nan"),), (0.85,), (0.60,), (0.59,), (0.9,)]
    got = _one(spark, rows, "s double", risk_band("s"))
    assert got == ["LOW", "HIGH", "HIGH", "MEDIUM", "LOW", "HIGH"]


def test_months_to_book_end_fixed_cases(spark):
    rows = [
        (dt.datetime(2019, 1, 31, 10, 0),),
        (dt.datetime(2026, 2, 28, 0, 0),),
        (dt.datetime(2025, 1, 15, 0, 0),),
        (dt.datetime(2024, 12, 31, 0, 0),),
        (None,),
    ]
    got = _one(spark, rows, "d timestamp_ntz", months_to_book_end("d"))
    assert got == [70, -13, 0, 0, None]


def _nth_weekday(year, month, weekday, n):
    days = [d for d in range(1, pycal.monthrange(year, month)[1] + 1) if dt.date(year, month, d).weekday() == weekday]
    return dt.date(year, month, days[n] if n >= 0 else days[n])


def python_federal_holidays(year: int) -> set:
    """Independent brute force: the holiday dates of one year (actual and
    observed), built from the calendar module."""
    out = set()
    for m, d in [(1, 1), (7, 4), (11, 11), (12, 25)] + ([(6, 19)] if year >= 2021 else []):
        day = dt.date(year, m, d)
        out.add(day)
        if day.weekday() == 5:
            out.add(day - dt.timedelta(days=1))
        if day.weekday() == 6:
            out.add(day + dt.timedelta(days=1))
    out |= {
        _nth_weekday(year, 1, 0, 2),   # 3rd Monday of January
        _nth_weekday(year, 2, 0, 2),   # 3rd Monday of February
        _nth_weekday(year, 5, 0, -1),  # last Monday of May
        _nth_weekday(year, 9, 0, 0),   # 1st Monday of September
        _nth_weekday(year, 10, 0, 1),  # 2nd Monday of October
        _nth_weekday(year, 11, 3, 3),  # 4th Thursday of November
    }
    # 1 Jan of next year on a Saturday is observed on 31 Dec of this year
    if dt.date(year + 1, 1, 1).weekday() == 5:
        out.add(dt.date(year, 12, 31))
    return out


def test_holiday_fixed_cases(spark):
    days = ["2021-12-31", "2021-12-24", "2021-06-18", "2021-06-19", "2020-06-19", "2024-11-28", "2024-11-21",
            "2024-01-15", "2024-05-27", "2024-09-02", "2024-10-14", "2024-02-19", "2022-06-20"]
    rows = [(dt.datetime.fromisoformat(d + " 10:00:00"),) for d in days] + [(None,)]
    got = _one(spark, rows, "d timestamp_ntz", is_us_federal_holiday("d"))
    assert got == [True, True, True, True, False, True, False, True, True, True, True, True, True, None]


def test_holiday_matches_brute_force_every_day(spark):
    start, end = dt.date(1990, 1, 1), dt.date(2035, 12, 31)
    df = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS d")
    got = {r.d for r in df.where(is_us_federal_holiday("d")).collect()}
    want = set().union(*(python_federal_holidays(y) for y in range(start.year - 1, end.year + 1)))
    want = {d for d in want if start <= d <= end}
    assert got == want


def test_holiday_accepts_date_timestamp_and_ntz(spark):
    df = spark.sql(
        "SELECT DATE'2024-07-04' AS a, TIMESTAMP'2024-07-04 23:00:00' AS b, TIMESTAMP_NTZ'2024-07-04 10:00:00' AS c"
    )
    r = df.select(is_us_federal_holiday("a"), is_us_federal_holiday("b"), is_us_federal_holiday("c")).first()
    assert list(r) == [True, True, True]


def test_months_match_relativedelta_brute_force(spark):
    end = dt.datetime(2024, 12, 31)
    probes = []
    d = dt.date(2019, 1, 1)
    while d <= dt.date(2026, 5, 31):
        probes += [dt.datetime(d.year, d.month, d.day, 0, 0), dt.datetime(d.year, d.month, d.day, 10, 0)]
        d += dt.timedelta(days=1)
    df = spark.createDataFrame([(p,) for p in probes], "d timestamp_ntz")
    got = {r.d: r.m for r in df.select("d", months_to_book_end("d").alias("m")).collect()}
    for p in probes:
        rd = relativedelta(end, p)
        assert got[p] == rd.years * 12 + rd.months, p


def test_sql_functions_registered(spark):
    register_sql_functions(spark)
    r = spark.sql(
        "SELECT is_us_federal_holiday(TIMESTAMP_NTZ'2021-12-31 00:00:00') AS h,"
        " months_to_book_end(TIMESTAMP_NTZ'2019-01-31 10:00:00') AS m"
    ).first()
    assert (r.h, r.m) == (True, 70)


def test_month_start_and_ordinal(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2023-05-17 10:30:00' AS d")
    r = df.select(month_start("d").alias("m"), month_ordinal("d").alias("o")).first()
    assert r.m.replace(tzinfo=None) == dt.datetime(2023, 5, 1) and r.o == 17


@pytest.mark.parametrize("ts", ["2024-03-01 00:00:00", "2024-02-29 23:59:59"])
def test_months_leap_day_neighbours(spark, ts):
    p = dt.datetime.fromisoformat(ts)
    rd = relativedelta(dt.datetime(2024, 12, 31), p)
    got = _one(spark, [(p,)], "d timestamp_ntz", months_to_book_end("d"))
    assert got == [rd.years * 12 + rd.months]


def test_functions_stay_native(spark, capsys):
    """No Python evaluation node in the plan of the calendar columns."""
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-04 10:00:00' AS d").select(
        is_us_federal_holiday("d").alias("h"), months_to_book_end("d").alias("m"), F.col("d"))
    df.explain()
    plan = capsys.readouterr().out
    assert "Project" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_months_accepts_date_and_ltz(spark):
    df = spark.sql("SELECT DATE'2019-01-31' AS a, TIMESTAMP'2019-01-31 10:00:00' AS b")
    r = df.select(months_to_book_end("a"), months_to_book_end("b")).first()
    want_a = relativedelta(dt.datetime(2024, 12, 31), dt.datetime(2019, 1, 31))
    want_b = relativedelta(dt.datetime(2024, 12, 31), dt.datetime(2019, 1, 31, 10))
    assert list(r) == [want_a.years * 12 + want_a.months, want_b.years * 12 + want_b.months] == [71, 70]
