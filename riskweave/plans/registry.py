"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables under ``sf_dir`` (through the fixture
views) and runs over them whole.  Processing-time columns (``*_at``) are
left out so results are reproducible.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import calendar
from riskweave.functions.calendar import month_ordinal
from riskweave.operators import gold, goldstate, learning, metrics, ml, quality, reports, sampling, scoring, sketches, timeseries
from riskweave.plans import jobs, medallion
from riskweave.plans.layers import Layers
from riskweave.session import scratch_dir
from riskweave.sources import files, fixtures, versions
from riskweave.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


_SESSION_STATE: dict = {}


def _cached(kind, spark, sf_dir, build):
    """Once-per-session state (trained models, a written history)."""
    k = (kind, spark.sparkContext.applicationId, id(spark), sf_dir)
    if k not in _SESSION_STATE:
        _SESSION_STATE[k] = build()
    return _SESSION_STATE[k]


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---- bronze -------------------------------------------------------------

@query("bronze_claims")
def _bronze_claims(spark, sf_dir):
    return Layers(spark, sf_dir).claims


@query("claims_by_policy")
def _claims_by_policy(spark, sf_dir):
    return reports.claims_by_policy(Layers(spark, sf_dir).claims)


# ---- silver -------------------------------------------------------------

@query("silver_customers")
def _silver_customers(spark, sf_dir):
    return Layers(spark, sf_dir).silver_customers


@query("silver_claims")
def _silver_claims(spark, sf_dir):
    return Layers(spark, sf_dir).silver_claims


@query("claims_enriched")
def _claims_enriched(spark, sf_dir):
    return Layers(spark, sf_dir).enriched


@query("claims_by_state_top5")
def _claims_by_state_top5(spark, sf_dir):
    return reports.claims_by_state_top(Layers(spark, sf_dir).enriched, 5)


@query("holiday_summary")
def _holiday_summary(spark, sf_dir):
    return reports.holiday_summary(Layers(spark, sf_dir).silver_claims)


@query("holiday_claims")
def _holiday_claims(spark, sf_dir):
    return reports.holiday_claims(Layers(spark, sf_dir).silver_claims)


@query("band_avg_percentile")
def _band_avg_percentile(spark, sf_dir):
    return reports.band_avg_percentile(Layers(spark, sf_dir).silver_customers)


@query("risk_band")
def _risk_band(spark, sf_dir):
    return Layers(spark, sf_dir).customers_base.select("customer_id", "fraud_risk_score", "fraud_risk_band")


@query("risk_zscore")
def _risk_zscore(spark, sf_dir):
    base = Layers(spark, sf_dir).customers_base.select("customer_id", "fraud_risk_score")
    return scoring.with_zscore(base, "fraud_risk_score", "fraud_risk_zscore", digits=6)


@query("risk_percentile")
def _risk_percentile(spark, sf_dir):
    base = Layers(spark, sf_dir).customers_base.select("customer_id", "fraud_risk_score")
    return scoring.with_percentile(base, "fraud_risk_score", "fraud_risk_percentile")


@query("is_holiday")
def _is_holiday(spark, sf_dir):
    return Layers(spark, sf_dir).claims.select(
        "claim_id", "claim_date", calendar.is_us_federal_holiday("claim_date").alias("is_us_federal_holiday"))


@query("months_to_book_end")
def _months_to_book_end(spark, sf_dir):
    return Layers(spark, sf_dir).claims.select(
        "claim_id", "claim_date", calendar.months_to_book_end("claim_date").alias("months_to_book_end"))


@query("sql_function_use")
def _sql_function_use(spark, sf_dir):
    """The calendar functions called from SQL (registered SQL functions)."""
    calendar.register_sql_functions(spark)
    view = f"raw_claims_{uuid.uuid4().hex[:8]}"
    Layers(spark, sf_dir).claims.createOrReplaceTempView(view)
    return spark.sql(
        f"SELECT claim_id, claim_date, is_us_federal_holiday(claim_date) AS is_us_federal_holiday,"
        f" months_to_book_end(claim_date) AS months_to_book_end FROM {view}"
    )


# ---- gold ---------------------------------------------------------------

@query("kpi_by_state")
def _kpi_by_state(spark, sf_dir):
    return Layers(spark, sf_dir).kpi


@query("kpi_top10")
def _kpi_top10(spark, sf_dir):
    return reports.top_by_amount(Layers(spark, sf_dir).kpi, 10, ["state", "policy_type"])


@query("monthly_trends")
def _monthly_trends(spark, sf_dir):
    return Layers(spark, sf_dir).trends


@query("high_risk_watchlist")
def _watchlist(spark, sf_dir):
    return Layers(spark, sf_dir).watchlist


@query("executive_by_state")
def _executive_by_state(spark, sf_dir):
    return Layers(spark, sf_dir).executive


@query("watchlist_report")
def _watchlist_report(spark, sf_dir):
    return gold.watchlist_report(Layers(spark, sf_dir).watchlist)


# ---- reports ------------------------------------------------------------

@query("top_states_by_amount")
def _top_states(spark, sf_dir):
    return reports.top_by_amount(Layers(spark, sf_dir).executive, 5, ["state"])


@query("watchlist_pending")
def _watchlist_pending(spark, sf_dir):
    return reports.status_count(Layers(spark, sf_dir).watchlist, "PENDING")


@query("policy_compare")
def _policy_compare(spark, sf_dir):
    return reports.policy_compare(Layers(spark, sf_dir).kpi, ("Auto", "Home"))


@query("watchlist_by_policy")
def _watchlist_by_policy(spark, sf_dir):
    return reports.watchlist_by(Layers(spark, sf_dir).watchlist, "policy_type")


@query("watchlist_by_state")
def _watchlist_by_state(spark, sf_dir):
    return reports.watchlist_by(Layers(spark, sf_dir).watchlist, "state")


@query("watchlist_top10")
def _watchlist_top10(spark, sf_dir):
    return reports.watchlist_top(Layers(spark, sf_dir).watchlist, 10)


@query("denied_vs_high_risk")
def _denied_vs_high_risk(spark, sf_dir):
    return reports.denied_vs_high_risk(Layers(spark, sf_dir).kpi, "CA")


@query("layer_counts")
def _layer_counts(spark, sf_dir):
    lay = Layers(spark, sf_dir)
    return reports.layer_counts(
        {
            "customers": lay.customers,
            "claims": lay.claims,
            "silver_customers": lay.customers_base,
            "silver_claims": lay.silver_claims,
            "silver_claims_enriched": lay.enriched,
            "gold_claims_kpi_by_state": lay.kpi,
            "gold_monthly_claim_trends": lay.trends,
            "gold_high_risk_watchlist": lay.watchlist,
        }
    )


@query("trend_month_ordinal")
def _trend_month_ordinal(spark, sf_dir):
    t = Layers(spark, sf_dir).trends
    return t.select("claim_month", "policy_type", "claim_count", month_ordinal("claim_month").alias("month_ordinal"))


@query("forecast_split")
def _forecast_split(spark, sf_dir):
    """Trend rows labelled holdout (last 3 distinct months) or train."""
    t = Layers(spark, sf_dir).trends
    months = F.broadcast(ml.holdout_months(t, 3).withColumn("_h", F.lit(True)))
    return t.join(months, "claim_month", "left").select(
        "claim_month", "policy_type", "claim_count",
        F.when(F.col("_h"), F.lit("holdout")).otherwise(F.lit("train")).alias("split"),
    )


@query("distinct_months")
def _distinct_months(spark, sf_dir):
    return Layers(spark, sf_dir).trends.select("claim_month").distinct().orderBy("claim_month")


# ---- windows and forecasts ------------------------------------------------

def _features(spark, sf_dir):
    return timeseries.trend_features(Layers(spark, sf_dir).trends)


@query("trend_lags")
def _trend_lags(spark, sf_dir):
    return _features(spark, sf_dir).select(
        "claim_month", "policy_type", "claim_count", "prev_claim_count", "prev2_claim_count"
    )


@query("rolling_avg_3m")
def _rolling_avg_3m(spark, sf_dir):
    return _features(spark, sf_dir).select("claim_month", "policy_type", "claim_count", "rolling_avg_3m")


@query("rolling_forecast")
def _rolling_forecast(spark, sf_dir):
    return timeseries.rolling_forecast(_features(spark, sf_dir))


@query("monthly_total")
def _monthly_total(spark, sf_dir):
    return timeseries.monthly_total(_features(spark, sf_dir))


@query("linear_trend_forecast")
def _linear_trend_forecast(spark, sf_dir):
    return timeseries.linear_trend_forecast(timeseries.monthly_total(_features(spark, sf_dir)))


# ---- sampling -------------------------------------------------------------

@query("hash_sample")
def _hash_sample(spark, sf_dir):
    return sampling.hash_sample(Layers(spark, sf_dir).enriched, "claim_id", 0.1, seed=42)


@query("hash_split")
def _hash_split(spark, sf_dir):
    sample = sampling.hash_sample(Layers(spark, sf_dir).enriched, "claim_id", 0.1, seed=42)
    return sample.select(
        "claim_id", "customer_id", "policy_type", "claim_amount",
        sampling.split_label("claim_id", (0.8, 0.2), ("train", "test"), seed=42).alias("split"),
    )


# ---- data quality ---------------------------------------------------------

def _dq(df, suite):
    return quality.evaluate(df, suite).drop("check_order")


@query("dq_enriched")
def _dq_enriched(spark, sf_dir):
    return _dq(Layers(spark, sf_dir).enriched, quality.enriched_suite())


@query("dq_customers")
def _dq_customers(spark, sf_dir):
    return _dq(Layers(spark, sf_dir).customers, quality.customers_suite())


@query("dq_unique_lineitem")
def _dq_unique_lineitem(spark, sf_dir):
    suite = quality.Suite(
        "lineitem",
        [
            quality.NotNull("l_orderkey not null", "l_orderkey"),
            quality.Unique("l_orderkey unique", "l_orderkey"),
            quality.UniqueProportion("l_orderkey mostly unique", "l_orderkey", min_value=0.999),
            quality.RowCount("row count", min_value=1),
        ],
    )
    return _dq(fixtures.table(spark, sf_dir, "lineitem"), suite)


@query("dq_unexpected_sample")
def _dq_unexpected_sample(spark, sf_dir):
    """Up to 5 unexpected values of each failed check, from one scan of the customers."""
    return quality.unexpected_sample(Layers(spark, sf_dir).customers, quality.customers_suite(), 5)


# ---- machine learning (no SQL oracle: rows-only checks) --------------------

def _classifiers(spark, sf_dir):
    return _cached("clf", spark, sf_dir, lambda: ml.train_classifiers(Layers(spark, sf_dir).enriched))


def _forecast(spark, sf_dir):
    return _cached("gbt", spark, sf_dir, lambda: ml.train_forecast(Layers(spark, sf_dir).trends))


@query("ml_claim_predictions")
def _ml_claim_predictions(spark, sf_dir):
    return ml.claim_predictions(_classifiers(spark, sf_dir), Layers(spark, sf_dir).enriched)


@query("confusion_matrix")
def _confusion_matrix(spark, sf_dir):
    preds = _ml_claim_predictions(spark, sf_dir)
    return ml.confusion(preds, "actual_policy_type", "predicted_policy_type", 8)


@query("denial_confusion")
def _denial_confusion(spark, sf_dir):
    preds = _ml_claim_predictions(spark, sf_dir)
    return ml.confusion(preds, "actual_denied", "predicted_denied")


@query("ml_metrics")
def _ml_metrics(spark, sf_dir):
    m = _classifiers(spark, sf_dir)
    rows = [(k, float(v)) for k, v in m.metrics.items()] + [
        ("train_rows", float(m.train_rows)), ("test_rows", float(m.test_rows))]
    return spark.createDataFrame(rows, "metric string, value double")


@query("ml_monthly_forecast")
def _ml_monthly_forecast(spark, sf_dir):
    return ml.forecast_rows(_forecast(spark, sf_dir))


@query("forecast_holdout")
def _forecast_holdout(spark, sf_dir):
    return _ml_monthly_forecast(spark, sf_dir).where(F.col("forecast_type") == "holdout").orderBy(
        "claim_month", "policy_type", "metric")


@query("forecast_summary")
def _forecast_summary(spark, sf_dir):
    return ml.forecast_summary(_ml_monthly_forecast(spark, sf_dir))


@query("forecast_metrics")
def _forecast_metrics(spark, sf_dir):
    fm = _forecast(spark, sf_dir)
    rows = [(label, float(v["rmse"]), float(v["mae"])) for label, v in fm.metrics.items()]
    return spark.createDataFrame(rows, "metric string, rmse double, mae double")


# ---- models' tables and metrics that SQL can state ----------------------------

@query("score_auc")
def _score_auc(spark, sf_dir):
    """How well the fraud score ranks denied claims: exact rank-sum AUC, ties averaged, per policy type."""
    enriched = Layers(spark, sf_dir).enriched
    return metrics.rank_auc(enriched, F.col("fraud_risk_score"), F.col("claim_status") == ml.DENIED_STATUS, by=["policy_type"])


@query("rule_metrics")
def _rule_metrics(spark, sf_dir):
    """The rule "a HIGH band claim is denied" measured like a model, per policy type."""
    said = Layers(spark, sf_dir).enriched.select(
        "policy_type",
        (F.col("claim_status") == ml.DENIED_STATUS).alias("denied"),
        (F.col("fraud_risk_band") == gold.WATCH_BAND).alias("flagged"),
    )
    return metrics.class_metrics(metrics.confusion_counts(said, "denied", "flagged", ["policy_type"]), ["policy_type"])


@query("ml_encoder")
def _ml_encoder(spark, sf_dir):
    """The fitted encoders of the claims models, as one table."""
    return ml.claim_features(Layers(spark, sf_dir).enriched)[1]


@query("ml_features")
def _ml_features(spark, sf_dir):
    """Every modelled claim's split, indexes, labels and assembled features (one column each)."""
    told, _ = ml.claim_features(Layers(spark, sf_dir).enriched)
    names = ml.CLAIM_INPUTS.features
    return told.select(*[c for c in told.columns if c != "features"], *[F.col("features")[i].alias(f"feature_{n}") for i, n in enumerate(names)])


@query("ml_node_predictions")
def _ml_node_predictions(spark, sf_dir):
    """The test claims' predictions from the stored node and encoder tables alone."""
    models, (features, encoder) = _classifiers(spark, sf_dir), ml.claim_features(Layers(spark, sf_dir).enriched)
    return ml.node_predictions(models, features.where(F.col("split") == "test"), encoder)


@query("forecast_actuals")
def _forecast_actuals(spark, sf_dir):
    """The holdout months' actual values in long form."""
    series = ml.trend_series()
    _, held = learning.split_holdout(series.frame(Layers(spark, sf_dir).trends), series, 3)
    return learning.unpivoted(held, series.values).select("claim_month", "policy_type", "metric", "actual_value", F.lit("holdout").alias("forecast_type"))


@query("forecast_forward_frame")
def _forecast_forward_frame(spark, sf_dir):
    """One row a policy type at the step after the last month, values and month unknown."""
    series = ml.trend_series()
    return learning.forward_frame(series.frame(Layers(spark, sf_dir).trends), series).withColumn("forecast_type", F.lit("forward"))


# ---- sources, sinks and the whole batch -------------------------------------

FIXED_TIME = dt.datetime(2025, 1, 1, 6, 0, 0)


@query("bronze_customers_csv")
def _bronze_customers_csv(spark, sf_dir):
    """Customers staged as CSV in the shared scratch folder, with another
    column and order, read back by header name (the bronze CSV load)."""
    path = scratch_dir(spark, "bronze-csv")
    (
        Layers(spark, sf_dir).customers
        .select("state", "customer_id", F.lit("x").alias("first_name"), "fraud_risk_score", "age")
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .mode("overwrite").csv(path)
    )
    return files.read_csv_by_name(spark, path, jobs.CUSTOMERS_SCHEMA).drop("first_name")


@query("medallion_run")
def _medallion_run(spark, sf_dir):
    """Run every layer into the shared scratch folder (gate before gold) and
    report the stored tables' row counts."""
    lay = Layers(spark, sf_dir)
    base = scratch_dir(spark, "medallion")
    medallion.run_medallion(spark, lay.customers, lay.claims, base_path=base, execution_time=FIXED_TIME)
    store = medallion.Store(spark, base_path=base)
    return reports.layer_counts({t: store.read(t) for t in medallion.BRONZE + medallion.SILVER + medallion.GOLD})


@query("silver_claims_stream")
def _silver_claims_stream(spark, sf_dir):
    base = scratch_dir(spark, "stream-silver")
    orders = incremental.file_stream(spark, f"{sf_dir}/orders.parquet")
    incremental.run_to_completion(incremental.silver_claims_stream(orders), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("enriched_stream")
def _enriched_stream(spark, sf_dir):
    base = scratch_dir(spark, "stream-enriched")
    orders = incremental.file_stream(spark, f"{sf_dir}/orders.parquet")
    customers = Layers(spark, sf_dir).customers_base
    incremental.run_to_completion(incremental.enriched_stream(orders, customers), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("monthly_trends_stream")
def _monthly_trends_stream(spark, sf_dir):
    """Gold monthly trends maintained by a stateful stream over the orders files."""
    base = scratch_dir(spark, "stream-trends")
    orders = incremental.file_stream(spark, f"{sf_dir}/orders.parquet")
    stream = incremental.trends_stream(orders, Layers(spark, sf_dir).customers_base)
    incremental.run_aggregate_to_versions(stream, f"{base}/gold_monthly_claim_trends", f"{base}/checkpoint")
    return versions.read_version(spark, f"{base}/gold_monthly_claim_trends")


def _history(spark, sf_dir):
    """The stored history after both suites ran through the gate (no raise).
    Like a history table, it is written once per session and input folder;
    the history queries read it."""

    def build():
        lay = Layers(spark, sf_dir)
        path = scratch_dir(spark, "dq-history")
        quality.run_gate(lay.enriched, quality.enriched_suite(), history_path=path,
                         execution_id="run-enriched", execution_time=FIXED_TIME, raise_on_failure=False)
        quality.run_gate(lay.customers, quality.customers_suite(), history_path=path,
                         execution_id="run-customers", execution_time=FIXED_TIME + dt.timedelta(minutes=5),
                         raise_on_failure=False)
        return path

    return quality.read_history(spark, history_path=_cached("dq-history", spark, sf_dir, build))


@query("dq_history")
def _dq_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query("dq_run_summary")
def _dq_run_summary(spark, sf_dir):
    return quality.run_summary(_history(spark, sf_dir))


@query("dq_history_recent")
def _dq_history_recent(spark, sf_dir):
    """The newest 12 stored check rows of one target table (newest first)."""
    hist = _history(spark, sf_dir).where(F.col("target_table") == "customers")
    return hist.select("execution_id", "execution_time", "check_name", "dq_score", "success").orderBy(
        F.col("execution_time").desc(), "check_name").limit(12)


@query("dq_gate")
def _dq_gate(spark, sf_dir):
    """Gate outcome per suite: PASSED, or FAILED with the failed check count
    (the failing suite's rows are stored before the gate raises)."""
    lay = Layers(spark, sf_dir)
    path = scratch_dir(spark, "dq-gate")
    out = []
    for df, suite in ((lay.enriched, quality.enriched_suite()), (lay.customers, quality.customers_suite())):
        try:
            quality.run_gate(df, suite, history_path=path, execution_time=FIXED_TIME)
            out.append((suite.target_table, "PASSED", 0))
        except quality.EmptySourceError:
            out.append((suite.target_table, "EMPTY", 0))
        except quality.DataQualityError as e:
            out.append((suite.target_table, "FAILED", len(e.failed)))
    return spark.createDataFrame(out, "target_table string, gate string, failed_checks bigint")


# ---- the survey's key names for the same operators ---------------------------

@query("bronze_customers")
def _bronze_customers(spark, sf_dir):
    return _bronze_customers_csv(spark, sf_dir)


@query("watchlist")
def _watchlist_alias(spark, sf_dir):
    return Layers(spark, sf_dir).watchlist


@query("load_audit_by_policy")
def _load_audit_by_policy(spark, sf_dir):
    """Bronze claims load audit: rows per policy type and the total
    (``is_total``), as one grouping-sets aggregate."""
    claims = Layers(spark, sf_dir).claims
    return claims.rollup("policy_type").agg(
        (F.grouping("policy_type") == 1).alias("is_total"), F.count(F.lit(1)).alias("cnt")
    )


@query("load_audit_customers")
def _load_audit_customers(spark, sf_dir):
    """Bronze customers load audit: rows, and rows without each column."""
    customers = Layers(spark, sf_dir).customers
    without = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("customer_id", "age", "state", "fraud_risk_score")]
    return customers.agg(F.count(F.lit(1)).alias("cnt"), *without)


# ---- rejects, incremental gold, stored sketches -------------------------------

@query("bronze_customers_rejects")
def _bronze_customers_rejects(spark, sf_dir):
    """Every fault of a customers CSV with bad values planted by rule, one row a fault."""
    path, key = scratch_dir(spark, "rejects"), F.col("customer_id")
    text = Layers(spark, sf_dir).customers.select(
        key.alias("row_no"),
        F.when(key % 23 == 0, "").when(key % 19 == 0, F.concat(F.lit("C"), key)).otherwise(key.cast("string")).alias("customer_id"),
        F.when(key % 13 == 0, "abc").otherwise(F.col("age").cast("string")).alias("age"),
        "state",
        F.when(key % 17 == 0, "n/a").otherwise(F.col("fraud_risk_score").cast("string")).alias("fraud_risk_score"),
    )
    writer = text.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(f"{path}/csv")
    _, rejected = files.split_csv(spark, f"{path}/csv", jobs.CUSTOMERS_SCHEMA, f"{path}/split", required=["customer_id"])
    row = F.get_json_object("raw", "$.row_no").cast("bigint").alias("row_no")
    return rejected.select(row, F.explode("rejects").alias("r")).select("row_no", F.col("r.column").alias("field"), "r.reason", "r.value")


@query("gold_incremental")
def _gold_incremental(spark, sf_dir):
    """KPIs kept as a partial state over two loads and one correction (every
    seventh claim doubled and denied), never rebuilt from the whole table."""
    enriched, table = Layers(spark, sf_dir).enriched, scratch_dir(spark, "gold-state")
    group, even = goldstate.KPI_GROUP, F.col("claim_id") % 2 == 0
    versions.write_version(goldstate.state_of(enriched.where(even), group), table)
    second = goldstate.state_of(enriched.where(~even), group)
    versions.write_version(goldstate.merged(group, [versions.read_version(spark, table), second]), table)
    corrected = enriched.where(F.col("claim_id") % 7 == 0).withColumns(
        {"claim_amount": F.col("claim_amount") * 2, "claim_status": F.lit(ml.DENIED_STATUS)}
    )
    after = goldstate.changed(versions.read_version(spark, table), group, enriched, corrected, "claim_id")
    versions.write_version(after, table)
    return goldstate.kpi(versions.read_version(spark, table))


def _score_states(spark, sf_dir):
    """Stored sketch states of four customer loads, written once per session and input folder."""

    def build():
        path = scratch_dir(spark, "score-states")
        load = F.concat(F.lit("load-"), F.col("customer_id") % 4)
        sketches.load_states(Layers(spark, sf_dir).customers_base, ["customer_id", "state", "fraud_risk_score"], load).write.parquet(path)
        return path

    return spark.read.parquet(_cached("score-states", spark, sf_dir, build))


@query("distinct_from_states")
def _distinct_from_states(spark, sf_dir):
    """Distinct values of the customers' columns from the loads' stored states, beside the
    exact count: ``within_bound`` says that they differ by no more than the stated error."""
    base = Layers(spark, sf_dir).customers_base
    exact = base.agg(*[F.countDistinct(c).alias(c) for c in ("customer_id", "state", "fraud_risk_score")])
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct_exact")) for c in exact.columns])
    told = sketches.distinct_counts(_score_states(spark, sf_dir)).join(exact.select(F.explode(names).alias("e")).select("e.*"), "column")
    near = F.abs(F.col("estimate") - F.col("distinct_exact")) <= sketches.distinct_error() * F.col("distinct_exact")
    return told.select(F.col("column").alias("field"), "loads", "rows", "nonnull", "distinct_exact", near.alias("within_bound"))


@query("percentile_from_states")
def _percentile_from_states(spark, sf_dir):
    """The exact risk percentile with ranges from the stored states: no pass for the bounds."""
    bounds = sketches.quantile_bounds(_score_states(spark, sf_dir), "fraud_risk_score", scoring.default_buckets(Layers(spark, sf_dir).customers))
    base = Layers(spark, sf_dir).customers_base.select("customer_id", "fraud_risk_score")
    return scoring.with_percentile(base, "fraud_risk_score", "fraud_risk_percentile", bounds=bounds)


# ---- content of the stored tables and views -----------------------------------

def _batch(spark, sf_dir):
    """The store of one whole batch, run once per session and input folder."""

    def build():
        lay = Layers(spark, sf_dir)
        base = scratch_dir(spark, "stored")
        medallion.run_medallion(spark, lay.customers, lay.claims, base_path=base, execution_time=FIXED_TIME)
        return base

    return medallion.Store(spark, base_path=_cached("batch", spark, sf_dir, build))


def _stored(table):
    def read(spark, sf_dir):
        stored = _batch(spark, sf_dir).read(table)
        return stored.drop(*[c for c in stored.columns if c.endswith("_at")])  # when it was written

    return read


for _name, _table in (
    ("stored_enriched", "silver_claims_enriched"),
    ("stored_kpi", "gold_claims_kpi_by_state"),
    ("stored_trends", "gold_monthly_claim_trends"),
    ("stored_watchlist", "gold_high_risk_watchlist"),
):
    query(_name)(_stored(_table))


@query("stored_silver_customers")
def _stored_silver_customers(spark, sf_dir):
    """The stored z-score is unrounded; like the layer's key, this one gives six digits."""
    stored = _stored("silver_customers")(spark, sf_dir)
    return stored.withColumn("fraud_risk_zscore", F.round("fraud_risk_zscore", 6))


@query("stored_executive_view")
def _stored_executive_view(spark, sf_dir):
    medallion.register_views(spark, _batch(spark, sf_dir))
    return spark.table("vw_executive_claims_by_state")


@query("stored_watchlist_view")
def _stored_watchlist_view(spark, sf_dir):
    medallion.register_views(spark, _batch(spark, sf_dir))
    return spark.table("vw_high_risk_claims_report")


def _catalog_views(spark, sf_dir):
    """A catalog database (its files in the shared scratch folder) with the gold tables and the two persistent views."""

    def build():
        lay, database = Layers(spark, sf_dir), f"rw_views_{uuid.uuid4().hex[:8]}"
        files.create_database(spark, database, scratch_dir(spark, database))
        store = medallion.Store(spark, database=database)
        store.write(lay.kpi, "gold_claims_kpi_by_state")
        store.write(lay.watchlist, "gold_high_risk_watchlist")
        jobs.views(store)
        return database

    return _cached("views", spark, sf_dir, build)


@query("catalog_executive_view")
def _catalog_executive_view(spark, sf_dir):
    return files.read_table(spark, f"{_catalog_views(spark, sf_dir)}.vw_executive_claims_by_state")


@query("catalog_watchlist_view")
def _catalog_watchlist_view(spark, sf_dir):
    return files.read_table(spark, f"{_catalog_views(spark, sf_dir)}.vw_high_risk_claims_report")


@query("dq_execution_results")
def _dq_execution_results(spark, sf_dir):
    """All stored rows of one execution."""
    return quality.execution_results(_history(spark, sf_dir), "run-customers")


@query("month_spine")
def _month_spine(spark, sf_dir):
    """Watchlist claims per month and policy type, months without any as 0."""
    months = Layers(spark, sf_dir).watchlist.groupBy(
        "policy_type", F.date_trunc("month", "claim_date").alias("claim_month")
    ).agg(F.count(F.lit(1)).alias("claim_count"))
    return timeseries.month_spine(months).select("claim_month", "policy_type", "claim_count")


@query("holiday_claims_sample")
def _holiday_claims_sample(spark, sf_dir):
    """A five-row peek at holiday claims (earliest first, a top-k)."""
    return reports.holiday_claims(Layers(spark, sf_dir).silver_claims).orderBy("claim_date", "claim_id").limit(5)


@query("dq_unique")
def _dq_unique(spark, sf_dir):
    suite = quality.Suite("customers", [quality.Unique("customer_id unique", "customer_id")])
    return _dq(Layers(spark, sf_dir).customers, suite)


@query("dq_unique_ratio")
def _dq_unique_ratio(spark, sf_dir):
    suite = quality.Suite("silver_claims_enriched",
                          [quality.UniqueProportion("claim_id mostly unique", "claim_id", min_value=0.999)])
    return _dq(Layers(spark, sf_dir).enriched, suite)


@query("dq_row_count")
def _dq_row_count(spark, sf_dir):
    suite = quality.Suite("customers", [quality.RowCount("row count ~100k", min_value=95_000, max_value=105_000)])
    return _dq(Layers(spark, sf_dir).customers, suite)


@query("dq_suite")
def _dq_suite(spark, sf_dir):
    """Both suites' result rows (7 + 6)."""
    return _dq_enriched(spark, sf_dir).unionByName(_dq_customers(spark, sf_dir))


@query("forecast_union")
def _forecast_union(spark, sf_dir):
    return _ml_monthly_forecast(spark, sf_dir)


def all_queries() -> dict[str, Query]:
    return dict(REGISTRY)


def reset(spark: SparkSession | None = None) -> None:
    """Release a session's cached layers, models and history (all when None)."""
    Layers.release(spark)
    for k in list(_SESSION_STATE):
        if spark is None or (k[1] == spark.sparkContext.applicationId and k[2] == id(spark)):
            del _SESSION_STATE[k]


__all__ = ["REGISTRY", "all_queries", "query", "reset"]
