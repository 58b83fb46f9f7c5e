"""Data-quality expectations, the suite runner, history and the gate.

A suite is a list of checks.  All row-level checks (not null, between, in
set) and the row count are answered by ONE aggregate over the table (one
scan, per-task partial counts); each uniqueness column takes one grouped
pass (value -> count, pre-aggregated map-side, so a value repeated a
billion times is one row per task before the shuffle).  The per-check
numbers are turned into result rows inside Spark (explode of an array of
per-check structs), so the
results are a DataFrame like any other; only the gate brings the few
result rows to the driver to decide pass/fail.

Result contract per check: success, element_count (all rows, nulls
included), unexpected_count (among non-null values), and
``dq_score = 1`` on success, else ``max(0, 1 - unexpected/element)`` when
both counts exist and element_count > 0, else 0.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.risk import BANDS
from riskweave.sources.files import append_table, read_table

# The ten valid state codes.
VALID_STATES = ("CA", "TX", "FL", "NY", "PA", "IL", "OH", "GA", "NC", "MI")

# The columns and types of the stored history.
DQ_RESULTS_SCHEMA = T.StructType(
    [
        T.StructField("execution_id", T.StringType(), False),
        T.StructField("execution_time", T.TimestampType(), False),
        T.StructField("target_table", T.StringType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("dq_score", T.DoubleType(), False),
        T.StructField("success", T.BooleanType(), False),
        T.StructField("element_count", T.LongType(), True),
        T.StructField("unexpected_count", T.LongType(), True),
    ]
)
RESULT_COLUMNS = [f.name for f in DQ_RESULTS_SCHEMA.fields]


class DataQualityError(RuntimeError):
    """Raised by the gate when a check fails (after results are stored).
    ``failed`` lists the failed check names, ``samples`` maps them to up to 5
    unexpected values (checks on the whole table have none)."""

    def __init__(self, message: str, failed: list | None = None, samples: dict | None = None):
        super().__init__(message)
        self.failed = list(failed or [])
        self.samples = dict(samples or {})


class EmptySourceError(DataQualityError):
    """Raised by the gate when the source has no rows (nothing is stored)."""


# ---- checks ----------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    name: str
    column: str | None = None

    def bad(self) -> Column | None:
        """Predicate of an unexpected (non-null) value; None if not row-level."""
        return None


@dataclass(frozen=True)
class NotNull(Check):
    def bad(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Between(Check):
    min_value: float | None = None
    max_value: float | None = None
    strict_min: bool = False
    strict_max: bool = False

    def bad(self) -> Column:
        c = F.col(self.column)
        ok = F.lit(True)
        if self.min_value is not None:
            ok = ok & ((c > self.min_value) if self.strict_min else (c >= self.min_value))
        if self.max_value is not None:
            ok = ok & ((c < self.max_value) if self.strict_max else (c <= self.max_value))
        return c.isNotNull() & ~ok


@dataclass(frozen=True)
class InSet(Check):
    values: tuple = ()

    def bad(self) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & ~c.isin(*self.values)


@dataclass(frozen=True)
class Unique(Check):
    """Every non-null value appears once; each row of a repeated value is
    unexpected."""


@dataclass(frozen=True)
class UniqueProportion(Check):
    """distinct / non-null count within [min_value, max_value].

    Exact by default (one grouped pass).  ``approx=True`` uses a
    HyperLogLog++ sketch (relative sd ``rsd``) inside the single row-level
    aggregate: no shuffle of values at all, for very large key columns.
    """

    min_value: float | None = None
    max_value: float | None = None
    approx: bool = False
    rsd: float = 0.01


@dataclass(frozen=True)
class RowCount(Check):
    min_value: int | None = None
    max_value: int | None = None


@dataclass
class Suite:
    target_table: str
    checks: list[Check] = field(default_factory=list)


def enriched_suite(target_table: str = "silver_claims_enriched") -> Suite:
    """Seven checks on the enriched claims (labels are fixed values)."""
    return Suite(
        target_table,
        [
            NotNull("claim_id not null", "claim_id"),
            NotNull("customer_id not null", "customer_id"),
            Between("claim_amount positive", "claim_amount", min_value=0, strict_min=True),
            Between("fraud_risk_score in [0,1]", "fraud_risk_score", min_value=0, max_value=1),
            InSet("state valid", "state", values=VALID_STATES),
            InSet("fraud_risk_band valid", "fraud_risk_band", values=BANDS),
            UniqueProportion("claim_id mostly unique", "claim_id", min_value=0.999),
        ],
    )


def customers_suite(target_table: str = "customers", min_rows: int = 95_000, max_rows: int = 105_000) -> Suite:
    """Six checks on the raw customers (labels are fixed values)."""
    return Suite(
        target_table,
        [
            NotNull("customer_id not null", "customer_id"),
            Unique("customer_id unique", "customer_id"),
            Between("age in range", "age", min_value=18, max_value=100),
            InSet("state valid", "state", values=VALID_STATES),
            Between("fraud_risk_score in [0,1]", "fraud_risk_score", min_value=0, max_value=1),
            RowCount("row count ~100k", min_value=min_rows, max_value=max_rows),
        ],
    )


# ---- runner ----------------------------------------------------------------

def _row_level(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """One aggregate for all row-level checks and row counts -> one row per check."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in checks:
        if c.bad() is not None:
            aggs.append(F.count_if(c.bad()).alias(f"_u{i}"))
        if isinstance(c, UniqueProportion):
            aggs.append(F.approx_count_distinct(c.column, c.rsd).alias(f"_d{i}"))
            aggs.append(F.count(c.column).alias(f"_nn{i}"))
    one = df.agg(*aggs)
    parts = []
    for i, c in checks:
        if isinstance(c, UniqueProportion):
            parts.append(_proportion_row(i, c, F.col(f"_d{i}"), F.col(f"_nn{i}")))
        elif isinstance(c, RowCount):
            ok = F.lit(True)
            if c.min_value is not None:
                ok = ok & (F.col("_n") >= c.min_value)
            if c.max_value is not None:
                ok = ok & (F.col("_n") <= c.max_value)
            parts.append(
                F.struct(
                    F.lit(i).alias("i"), F.lit(c.name).alias("check_name"), ok.alias("success"),
                    F.lit(None).cast("bigint").alias("element_count"),
                    F.lit(None).cast("bigint").alias("unexpected_count"),
                )
            )
        else:
            parts.append(
                F.struct(
                    F.lit(i).alias("i"), F.lit(c.name).alias("check_name"), (F.col(f"_u{i}") == 0).alias("success"),
                    F.col("_n").alias("element_count"), F.col(f"_u{i}").alias("unexpected_count"),
                )
            )
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def _uniqueness(df: DataFrame, column: str, checks: list[tuple[int, Check]]) -> DataFrame:
    """One grouped pass per column answers Unique and UniqueProportion."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("_c"))
    stats = per_value.agg(
        F.sum("_c").alias("_n"),
        F.coalesce(F.sum(F.when(F.col(column).isNotNull() & (F.col("_c") > 1), F.col("_c"))), F.lit(0)).alias("_dup"),
        F.count_if(F.col(column).isNotNull()).alias("_distinct"),
        F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col("_c"))), F.lit(0)).alias("_nonnull"),
    ).select(F.coalesce("_n", F.lit(0)).alias("_n"), "_dup", "_distinct", "_nonnull")
    parts = []
    for i, c in checks:
        if isinstance(c, Unique):
            parts.append(
                F.struct(
                    F.lit(i).alias("i"), F.lit(c.name).alias("check_name"), (F.col("_dup") == 0).alias("success"),
                    F.col("_n").alias("element_count"), F.col("_dup").alias("unexpected_count"),
                )
            )
        else:
            parts.append(_proportion_row(i, c, F.col("_distinct"), F.col("_nonnull")))
    return stats.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def _proportion_row(i: int, c: UniqueProportion, distinct: F.Column, nonnull: F.Column) -> F.Column:
    ratio = distinct / nonnull
    ok = nonnull > 0
    if c.min_value is not None:
        ok = ok & (ratio >= c.min_value)
    if c.max_value is not None:
        ok = ok & (ratio <= c.max_value)
    return F.struct(
        F.lit(i).alias("i"), F.lit(c.name).alias("check_name"), F.coalesce(ok, F.lit(False)).alias("success"),
        F.lit(None).cast("bigint").alias("element_count"),
        F.lit(None).cast("bigint").alias("unexpected_count"),
    )


def dq_score(success: Column, element: Column, unexpected: Column) -> Column:
    partial = F.greatest(F.lit(0.0), F.lit(1.0) - unexpected / element)
    return (
        F.when(success, F.lit(1.0))
        .when(element.isNotNull() & (element > 0) & unexpected.isNotNull(), partial)
        .otherwise(F.lit(0.0))
    )


def evaluate(df: DataFrame, suite: Suite) -> DataFrame:
    """Result rows of a suite: target_table, check_name, dq_score, success,
    element_count, unexpected_count (lazy; one row per check, suite order
    in column ``check_order``)."""
    indexed = list(enumerate(suite.checks))

    def grouped(c: Check) -> bool:
        return isinstance(c, Unique) or (isinstance(c, UniqueProportion) and not c.approx)

    row_level = [(i, c) for i, c in indexed if not grouped(c)]
    parts = [_row_level(df, row_level)] if row_level else []
    by_col: dict[str, list] = {}
    for i, c in indexed:
        if grouped(c):
            by_col.setdefault(c.column, []).append((i, c))
    parts += [_uniqueness(df, col, cs) for col, cs in by_col.items()]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(
        F.lit(suite.target_table).alias("target_table"),
        "check_name",
        dq_score(F.col("success"), F.col("element_count"), F.col("unexpected_count")).alias("dq_score"),
        "success",
        "element_count",
        "unexpected_count",
        F.col("i").alias("check_order"),
    )


def bad_values(df: DataFrame, checks: list[tuple[str, Column, str]], k: int) -> DataFrame:
    """``i, unexpected_count, sample`` of the (name, predicate, column) checks that
    have bad rows: ``sample`` is the k smallest distinct bad values, as text.

    One scan.  Only rows that fail a check leave the JVM; each task keeps k
    values a check, so no more than tasks x checks x k rows are shuffled,
    however many values are bad or repeat.
    """
    flags = [predicate.alias(f"b{i}") for i, (_, predicate, _) in enumerate(checks)]
    values = [F.when(predicate, F.col(column)).alias(f"v{i}") for i, (_, predicate, column) in enumerate(checks)]
    rows = df.select(*flags, *values).where(reduce(Column.__or__, [F.coalesce(F.col(f"b{i}"), F.lit(False)) for i in range(len(checks))]))
    kinds = [rows.schema[f"v{i}"].dataType.simpleString() for i in range(len(checks))]
    schema = ", ".join(["i int", "n bigint", *[f"v{i} {t}" for i, t in enumerate(kinds)]])
    n_checks, more = len(checks), k + 1  # a NaN sorts elsewhere in Arrow, so one value more

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = [0] * n_checks, [None] * n_checks
        names, types = [], []
        for batch in batches:
            names = batch.schema.names[n_checks:]
            types = [batch.schema.field(n).type for n in names]
            for i in range(n_checks):
                bad = batch.column(n_checks + i).filter(pc.fill_null(batch.column(i), False))
                if len(bad):
                    counts[i] += len(bad)
                    every = pc.unique(bad if best[i] is None else pa.concat_arrays([best[i], bad]))
                    best[i] = every.take(pc.sort_indices(every, null_placement="at_start")[:more])
        for i in range(n_checks):
            if counts[i]:
                m = len(best[i])
                values = [best[i] if j == i else pa.nulls(m, t) for j, t in enumerate(types)]
                columns = [pa.array([i] * m, pa.int32()), pa.array([counts[i]] + [0] * (m - 1), pa.int64()), *values]
                yield pa.record_batch(columns, names=["i", "n", *names])

    told = rows.mapInArrow(keep, schema)
    own = [f"v{i}" for i in range(len(checks))]
    distinct = told.groupBy("i", *own).agg(F.sum("n").alias("n"))
    order = Window.partitionBy("i").orderBy(*[F.col(v).asc_nulls_first() for v in own])  # a check's few values
    text = F.coalesce(*[F.col(v).cast("string") for v in own])
    ranked = distinct.withColumn("r", F.row_number().over(order)).select("i", "n", F.struct("r", text.alias("v")).alias("s"))
    return ranked.groupBy("i").agg(F.sum("n").alias("unexpected_count"), F.sort_array(F.collect_list("s")).alias("s")).select(
        "i", "unexpected_count", F.transform(F.slice("s", 1, k), lambda x: x["v"]).alias("sample")
    )


def _sampled(df: DataFrame, suite: Suite, k: int, failed: Collection[str] | None) -> list[tuple[DataFrame, list[int]]]:
    """(bad values, suite positions of its checks): the row-level checks together, and each uniqueness column."""
    wanted = [(i, c) for i, c in enumerate(suite.checks) if failed is None or c.name in failed]
    row_level = [(i, c) for i, c in wanted if c.bad() is not None]
    parts = []
    if row_level:
        parts.append((bad_values(df, [(c.name, c.bad(), c.column) for _, c in row_level], k), [i for i, _ in row_level]))
    for i, c in wanted:
        if isinstance(c, Unique):
            often = df.where(F.col(c.column).isNotNull()).groupBy(c.column).count().where(F.col("count") > 1)
            parts.append((bad_values(often, [(c.name, F.lit(True), c.column)], k), [i]))
    return parts


def unexpected_sample(df: DataFrame, suite: Suite, k: int = 5, failed: Collection[str] | None = None) -> DataFrame:
    """Up to ``k`` distinct unexpected values per check (smallest first, as
    text).  Checks that pass contribute no rows; with the names of the checks
    that ``failed``, only those are looked at.  One scan for all row-level
    checks, one grouped pass a uniqueness column."""
    parts = [df.sparkSession.createDataFrame([], "check_name string, unexpected_value string")]
    for told, places in _sampled(df, suite, k, failed):
        names = F.array(*[F.lit(suite.checks[i].name) for i in places])
        parts.append(told.select(F.get(names, F.col("i")).alias("check_name"), F.explode("sample").alias("unexpected_value")))
    return reduce(DataFrame.unionByName, parts)


def checked(df: DataFrame, suite: Suite, k: int = 5) -> list[dict]:
    """The suite's result rows with ``samples``, in suite order: counts and bad
    values of all row-level checks come from the same scan."""
    spark = df.sparkSession
    found: dict[int, tuple] = {}
    for told, places in _sampled(df, Suite(suite.target_table, [c for c in suite.checks if c.bad() is not None]), k, None):
        row_level = [i for i, c in enumerate(suite.checks) if c.bad() is not None]
        for r in told.collect():  # a row a check
            found[row_level[places[r["i"]]]] = (r["unexpected_count"], r["sample"])
    n = df.count()  # no column is read for it
    others = Suite(suite.target_table, [c for c in suite.checks if c.bad() is None])
    rest = iter(evaluate(df, others).orderBy("check_order").collect() if others.checks else [])
    rows, samples = [], {}
    for i, c in enumerate(suite.checks):
        if c.bad() is None:
            r = next(rest)
            rows.append((i, c.name, r["success"], r["element_count"], r["unexpected_count"]))
        else:
            bad, sample = found.get(i, (0, []))
            rows.append((i, c.name, bad == 0, n, bad))
            samples[c.name] = sample
    failing = [r[1] for r in rows if not r[2]]
    repeated = Suite(suite.target_table, [c for c in suite.checks if isinstance(c, Unique) and c.name in failing])
    for told, places in _sampled(df, repeated, k, None):
        for r in told.collect():
            samples[repeated.checks[places[r["i"]]].name] = r["sample"]
    told = spark.createDataFrame(rows, "check_order int, check_name string, success boolean, element_count bigint, unexpected_count bigint")
    score = dq_score(F.col("success"), F.col("element_count"), F.col("unexpected_count"))
    scored = told.select("*", score.alias("dq_score")).orderBy("check_order").collect()
    return [{**r.asDict(), "target_table": suite.target_table, "samples": samples.get(r["check_name"], [])} for r in scored]


# ---- history and gate --------------------------------------------------------

def result_frame(spark: SparkSession, rows: list, execution_id: str, execution_time: _dt.datetime) -> DataFrame:
    data = [
        (execution_id, execution_time, r["target_table"], r["check_name"], float(r["dq_score"]), bool(r["success"]),
         r["element_count"], r["unexpected_count"])
        for r in rows
    ]
    return spark.createDataFrame(data, DQ_RESULTS_SCHEMA)


def persist_results(results: DataFrame, history_table: str | None = None, history_path: str | None = None) -> None:
    """Append to the history; partitioned by execution id, so re-running one
    execution replaces its rows instead of doubling them."""
    append_table(results.select(*RESULT_COLUMNS), name=history_table, path=history_path,
                 partition_by=["execution_id"])


def read_history(spark: SparkSession, history_table: str | None = None, history_path: str | None = None) -> DataFrame:
    return read_table(spark, history_table, history_path).select(*RESULT_COLUMNS)


def run_gate(
    df: DataFrame,
    suite: Suite,
    history_table: str | None = None,
    history_path: str | None = None,
    execution_id: str | None = None,
    execution_time: _dt.datetime | None = None,
    raise_on_failure: bool = True,
) -> list:
    """Check an empty source (raise, store nothing), run the suite, store one
    row per check, then raise if any check failed; the error carries up to 5
    unexpected values of each failed check."""
    spark = df.sparkSession
    execution_id = execution_id or str(uuid.uuid4())
    execution_time = execution_time or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if df.isEmpty():
        raise EmptySourceError(f"{suite.target_table} is empty")
    rows = checked(df, suite)  # one row per check
    persist_results(result_frame(spark, rows, execution_id, execution_time), history_table, history_path)
    failed = [r["check_name"] for r in rows if not r["success"]]
    if failed and raise_on_failure:
        samples = {r["check_name"]: r["samples"] for r in rows if not r["success"] and r["samples"]}
        message = f"{len(failed)} check(s) failed on {suite.target_table}: {failed}; unexpected values: {samples}"
        raise DataQualityError(message, failed, samples)
    return rows


def run_summary(history: DataFrame) -> DataFrame:
    """Checks per (target_table, execution_id) and when it ran, newest first."""
    return (
        history.groupBy("target_table", "execution_id")
        .agg(F.count(F.lit(1)).alias("checks"), F.min("execution_time").alias("ran_at"))
        .orderBy(F.col("ran_at").desc(), "target_table", "execution_id")
    )


def execution_results(history: DataFrame, execution_id: str) -> DataFrame:
    return history.where(F.col("execution_id") == execution_id).orderBy("check_name")
