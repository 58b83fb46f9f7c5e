"""Operators: edge cases of FIXTURES.md section 5 and partition independence."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from riskweave.operators import cleanse, enrich, gold, joins, quality, sampling, scoring, timeseries
from riskweave.plans.layers import Layers
from riskweave.session import scratch_dir


# ---- cleansing ------------------------------------------------------------------

def test_status_allow_list_before_trim(spark):
    rows = [(1, 10, 5, dt.datetime(2022, 3, 1), 10.0, s, "Auto", "Theft") for s in ("Approved", " Approved", "APPROVED")]
    claims = spark.createDataFrame(
        rows, "claim_id long, policy_id long, customer_id long, claim_date timestamp_ntz, claim_amount double,"
              " claim_status string, policy_type string, claim_type string")
    out = cleanse.silver_claims(claims).collect()
    assert [r.claim_status for r in out] == ["APPROVED"]


def test_customer_age_filter_before_cast(spark):
    rows = [(1, 100.0, "ca", 0.5), (2, 17.9, "TX", 0.5), (3, 18.0, None, 0.5), (None, 30.0, "NY", 0.5)]
    cu = spark.createDataFrame(rows, "customer_id long, age double, state string, fraud_risk_score double")
    out = cleanse.customers_base(cu).collect()
    assert [(r.customer_id, r.age, r.state) for r in out] == [(1, 100, "CA")]


# ---- table-wide scores ----------------------------------------------------------------

def test_percentile_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,), (None,)], "x double")
    got = sorted((r.x is None, r.x or 0, r.p) for r in scoring.with_percentile(df, "x", "p").collect())
    assert [g[2] for g in got] == [25.0, 62.5, 62.5, 100.0, None]


@pytest.mark.parametrize("parts,buckets", [(1, 1), (7, 3), (3, 16)])
def test_percentile_matches_pandas_any_partitioning(spark, parts, buckets):
    rnd = random.Random(parts * 31 + buckets)
    vals = [float(rnd.choice([rnd.randint(0, 50), 7])) for _ in range(3000)]  # 7 is a hot value
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double").repartition(parts)
    got = {r.id: r.p for r in scoring.with_percentile(df, "x", "p", buckets=buckets).collect()}
    s = pd.Series(vals)
    want = s.rank(method="average") / len(s) * 100.0
    assert all(abs(got[i] - want[i]) < 1e-9 for i in range(len(vals)))


def test_zscore_constant_column_is_null(spark):
    df = spark.createDataFrame([(0.5,), (0.5,), (None,)], "x double")
    assert [r.z for r in scoring.with_zscore(df, "x", "z").collect()] == [None, None, None]


def test_zscore_matches_population_formula(spark):
    vals = [0.1, 0.4, 0.4, 0.9, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    s = pd.Series([v for v in vals if v is not None])
    mean, sd = s.mean(), s.std(ddof=0)
    got = sorted((r.x, r.z) for r in scoring.with_zscore(df, "x", "z").collect() if r.x is not None)
    for x, z in got:
        assert abs(z - (x - mean) / sd) < 1e-12


# ---- joins and enrichment ----------------------------------------------------------------

def _claims(spark, ids_customers):
    rows = [(i, i * 10, c, dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 1), 100.0, "APPROVED", "Auto", "Theft")
            for i, c in ids_customers]
    return spark.createDataFrame(
        rows, "claim_id long, policy_id long, customer_id long, claim_date timestamp_ntz, claim_month timestamp_ntz,"
              " claim_amount double, claim_status string, policy_type string, claim_type string")


def _customers(spark, ids):
    return spark.createDataFrame([(c, 40, "CA", 0.9, "HIGH") for c in ids],
                                 "customer_id long, age int, state string, fraud_risk_score double,"
                                 " fraud_risk_band string")


def test_repeated_customer_id_fans_out_and_fails_uniqueness(spark):
    claims = _claims(spark, [(1, 7), (2, 7), (3, 8)])
    customers = _customers(spark, [7, 7, 8])
    assert enrich.enrich_claims(claims, customers).count() == 5
    res = {r.check_name: r for r in quality.evaluate(customers, quality.Suite(
        "c", [quality.Unique("u", "customer_id")])).collect()}
    assert not res["u"].success and res["u"].unexpected_count == 2


def test_hot_key_split_equals_plain_join(spark):
    pairs = [(i, 1 if i % 3 else i % 11) for i in range(1, 400)]  # customer 1 holds 2/3 of claims
    claims = _claims(spark, pairs)
    customers = _customers(spark, list(range(1, 11)))  # customer 0 has no row: its claims drop
    plain = sorted(map(tuple, enrich.enrich_claims(claims, customers).collect()))
    split = sorted(map(tuple, enrich.enrich_claims(claims, customers, hot_key_fraction=0.2).collect()))
    assert plain == split and len(plain) == 399 - sum(1 for _, c in pairs if c == 0)
    assert joins.hot_keys(claims, "customer_id", 0.2) == [1]


def test_denied_count_uses_tidied_status(spark):
    lay = Layers(spark, SF_CHECK)
    total = lay.kpi.agg(F.sum("denied_claims")).first()[0]
    assert total == 2048


# ---- data quality ----------------------------------------------------------------------

def test_dq_score_partial_and_no_counts(spark):
    df = spark.createDataFrame([(i if i >= 3 else -1,) for i in range(100)], "v long")
    suite = quality.Suite("t", [quality.Between("pos", "v", min_value=0),
                                quality.RowCount("rows", min_value=1000)])
    res = {r.check_name: r for r in quality.evaluate(df, suite).collect()}
    assert res["pos"].dq_score == pytest.approx(0.97) and not res["pos"].success
    assert res["rows"].dq_score == 0.0 and res["rows"].element_count is None


def test_gate_empty_source_stores_nothing(spark):
    path = scratch_dir(spark, "gate-empty")
    empty = spark.createDataFrame([], "claim_id long")
    with pytest.raises(quality.EmptySourceError):
        quality.run_gate(empty, quality.Suite("t", [quality.NotNull("nn", "claim_id")]), history_path=path)
    import os
    assert not os.path.exists(path.replace("file:", ""))


def test_gate_failure_stores_rows_then_raises(spark):
    path = scratch_dir(spark, "gate-fail")
    df = spark.createDataFrame([(1,), (None,)], "claim_id long")
    suite = quality.Suite("t", [quality.NotNull("nn", "claim_id"), quality.RowCount("rows", min_value=1)])
    with pytest.raises(quality.DataQualityError):
        quality.run_gate(df, suite, history_path=path, execution_id="e1")
    hist = quality.read_history(spark, history_path=path).collect()
    assert sorted((r.check_name, r.success) for r in hist) == [("nn", False), ("rows", True)]


def test_history_append_is_idempotent_per_execution(spark):
    path = scratch_dir(spark, "gate-idem")
    df = spark.createDataFrame([(1,), (2,)], "claim_id long")
    suite = quality.Suite("t", [quality.NotNull("nn", "claim_id")])
    t = dt.datetime(2025, 1, 1)
    quality.run_gate(df, suite, history_path=path, execution_id="same", execution_time=t)
    quality.run_gate(df, suite, history_path=path, execution_id="same", execution_time=t)
    quality.run_gate(df, suite, history_path=path, execution_id="other", execution_time=t)
    hist = quality.read_history(spark, history_path=path)
    assert hist.count() == 2
    assert [r.checks for r in quality.run_summary(hist).collect()] == [1, 1]


def test_lineitem_orderkey_ratio_check_fails(spark):
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet")
    suite = quality.Suite("lineitem", [quality.UniqueProportion("ratio", "l_orderkey", min_value=0.999)])
    r = quality.evaluate(li, suite).first()
    assert not r.success and r.dq_score == 0.0
    assert li.select("l_orderkey").distinct().count() == 14743


# ---- sampling -------------------------------------------------------------------------

def test_hash_sample_is_partition_independent(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    a = {r.k for r in sampling.hash_sample(df.repartition(1), "k", 0.1).collect()}
    b = {r.k for r in sampling.hash_sample(df.repartition(7), "k", 0.1).collect()}
    assert a == b and 1700 < len(a) < 2300


def test_hash_split_disjoint_and_complete(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    tr, te = sampling.hash_split(df, "k", (0.8, 0.2))
    a, b = {r.k for r in tr.collect()}, {r.k for r in te.collect()}
    assert not (a & b) and len(a | b) == 5000 and 3800 < len(a) < 4200


# ---- windows -----------------------------------------------------------------------------

def test_sparse_months_row_frame_vs_spine(spark):
    rows = [(dt.datetime(2022, m, 1), "Auto", c) for m, c in [(1, 3), (2, 6), (4, 9)]]
    t = spark.createDataFrame(rows, "claim_month timestamp_ntz, policy_type string, claim_count long")
    rows_frame = {r.claim_month.month: r.rolling_avg_3m for r in timeseries.trend_features(t).collect()}
    assert rows_frame[4] == pytest.approx(6.0)  # (3 + 6 + 9) / 3: March skipped
    dense = {r.claim_month.month: r.rolling_avg_3m
             for r in timeseries.trend_features(timeseries.month_spine(t)).collect()}
    assert dense[4] == pytest.approx(5.0) and dense[3] == pytest.approx(3.0)


def test_linear_trend_matches_polyfit(spark):
    import numpy as np
    counts = [10, 12, 15, 13, 18, 21]
    rows = [(dt.datetime(2022, i + 1, 1), "Auto", c) for i, c in enumerate(counts)]
    t = spark.createDataFrame(rows, "claim_month timestamp_ntz, policy_type string, claim_count long")
    r = timeseries.linear_trend_forecast(timeseries.monthly_total(timeseries.trend_features(t)), digits=None).first()
    slope, icpt = np.polyfit(range(len(counts)), counts, 1)
    assert r.slope == pytest.approx(slope) and r.forecast_next_month == pytest.approx(slope * 6 + icpt)


# ---- layers at the smoke scale ---------------------------------------------------------------

def test_fixture_sizes(spark):
    lay = Layers(spark, SF_SMALL)
    assert (lay.customers.count(), lay.customers_base.count(), lay.claims.count(), lay.enriched.count(),
            lay.watchlist.count()) == (150, 127, 1500, 1195, 107)
    assert lay.trends.count() == 374


def test_gold_kpi_columns(spark):
    kpi = gold.kpi_by_state(Layers(spark, SF_SMALL).enriched, built_at=F.lit(dt.datetime(2025, 1, 1)))
    assert kpi.columns == ["state", "policy_type", "claim_count", "total_claim_amount", "avg_claim_amount",
                           "avg_fraud_risk_score", "high_risk_customer_claims", "denied_claims", "gold_built_at"]


def test_approx_unique_ratio_needs_no_grouped_pass(spark, capsys):
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet")
    suite = quality.Suite("lineitem", [quality.UniqueProportion("ratio", "l_orderkey", min_value=0.999, approx=True)])
    res = quality.evaluate(li, suite)
    res.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") <= 1  # only the final merge of the one aggregate
    assert not res.first().success


def test_results_independent_of_shuffle_partitions(spark):
    """Every side-effect-free oracle key: same rows with 1 and 7 shuffle
    partitions (SURVEY section 5, item 3)."""
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from riskweave.plans.registry import all_queries

    import __spark_entry__ as E
    from plan_audit import ML, SIDE_EFFECTS

    keys = [k for k in all_queries() if k in E.oracle_sql() and k not in SIDE_EFFECTS and k not in ML]
    seen = {}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            Layers.release(spark)
            for k in keys:
                rows = sorted(map(repr, all_queries()[k](spark, SF_SMALL).collect()))
                seen.setdefault(k, []).append(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        Layers.release(spark)
    for k, (a, b) in seen.items():
        assert a == b, k


def test_csv_inferred_and_explicit_schema(spark):
    from riskweave.sources import files

    path = scratch_dir(spark, "csv")
    Layers(spark, SF_SMALL).customers.write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    inferred = files.read_csv(spark, path, infer_schema=True)
    assert dict(inferred.dtypes)["fraud_risk_score"] == "double" and inferred.count() == 150
    explicit = files.read_csv(spark, path, schema="customer_id BIGINT, age INT, state STRING, fraud_risk_score DOUBLE")
    assert explicit.where(F.col("state").startswith("  ")).count() > 0  # untidy text survives the round trip


def test_cluster_conf_sizes_partitions():
    from riskweave.session import cluster_conf

    conf = cluster_conf(shuffle_bytes=20 * 1024**4, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 81920
    assert cluster_conf(1024, 16)["spark.sql.shuffle.partitions"] == "32"


def test_aqe_splits_a_hot_customer_in_the_enrichment_join(spark):
    """Cluster-shaped plan (no broadcast): AQE's skew join splits the
    partition of a customer holding a third of the claims; rows unchanged."""
    import contextlib
    import io

    lay = Layers(spark, SF_CHECK)
    hot = lay.silver_claims.withColumn(
        "customer_id", F.when(F.col("claim_id") % 3 == 0, F.lit(10)).otherwise(F.col("customer_id")))
    want = sorted(map(tuple, enrich.enrich_claims(hot, lay.customers_base).collect()))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = enrich.enrich_claims(hot.repartition(8), lay.customers_base)  # 8 map tasks, as on a cluster
        got = sorted(map(tuple, df.collect()))
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == want
    assert "SortMergeJoin(skew=true)" in buf.getvalue()


def test_nan_scores(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (None,)], "x double")
    z = {(r.x if r.x == r.x else "nan"): r.z for r in scoring.with_zscore(df, "x", "z").collect()}
    assert z[1.0] == pytest.approx(-1.0) and z[2.0] == pytest.approx(1.0) and z["nan"] != z["nan"]
    p = {(r.x if r.x == r.x else "nan"): r.p for r in scoring.with_percentile(df, "x", "p", buckets=2).collect()}
    assert p[1.0] == pytest.approx(100 / 3) and p[2.0] == pytest.approx(200 / 3) and p["nan"] == 100.0
    assert p[None] is None


def test_catalog_history_keeps_other_runs_under_static_overwrite_default(spark):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        spark.sql("CREATE DATABASE IF NOT EXISTS rw_hist")
        df = spark.createDataFrame([(1,), (2,)], "claim_id long")
        suite = quality.Suite("t", [quality.NotNull("nn", "claim_id")])
        t = dt.datetime(2025, 1, 1)
        for run in ("a", "b", "a"):
            quality.run_gate(df, suite, history_table="rw_hist.dq", execution_id=run, execution_time=t)
        ids = sorted(r.execution_id for r in spark.table("rw_hist.dq").collect())
        assert ids == ["a", "b"]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_path_history_keeps_other_runs_under_static_overwrite_default(spark):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        path = scratch_dir(spark, "hist-static")
        df = spark.createDataFrame([(1,), (2,)], "claim_id long")
        suite = quality.Suite("t", [quality.NotNull("nn", "claim_id")])
        t = dt.datetime(2025, 1, 1)
        for run in ("a", "b", "a"):
            quality.run_gate(df, suite, history_path=path, execution_id=run, execution_time=t)
        ids = sorted(r.execution_id for r in quality.read_history(spark, history_path=path).collect())
        assert ids == ["a", "b"]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_money_aggregates_exact_and_null_safe(spark):
    from riskweave.functions import money_avg, money_sum

    rows = [("a", None), ("a", None), ("b", 1.005), ("b", 2.0), ("c", 0.1), ("c", 0.2), ("e", -1.005), ("e", -2.0)]
    df = spark.createDataFrame(rows + [("d", 10.004)] * 1000, "g string, x double")
    got = {r.g: (r.avg, r.s) for r in df.groupBy("g").agg(money_avg("x").alias("avg"),
                                                          money_sum("x").alias("s")).collect()}
    assert got["a"] == (None, None)
    assert got["b"] == (1.5, 3.01)           # the mean 1.5025 and the sum 3.005 are rounded once
    assert got["e"] == (-1.5, -3.01)
    assert got["d"] == (10.0, 10004.0)       # parts of a cent add up
    assert got["c"] == (0.15, 0.3)           # exact: no 0.30000000000000004


def test_percentile_with_hot_value_split(spark):
    vals = [7.0] * 500 + [float(i) for i in range(300)] + [None] * 20
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    plain = {r.id: r.p for r in scoring.with_percentile(df, "x", "p", buckets=4).collect()}
    split = {r.id: r.p for r in scoring.with_percentile(df, "x", "p", buckets=4, hot_key_fraction=0.2).collect()}
    assert plain == split and len(split) == len(vals)
    assert sum(p is None for p in split.values()) == 20


def test_silver_customers_all_null_scores(spark):
    rows = [(1, 30.0, "CA", None), (2, 40.0, "TX", None)]
    cu = spark.createDataFrame(rows, "customer_id long, age double, state string, fraud_risk_score double")
    out = cleanse.silver_customers(cu).collect()
    assert [(r.fraud_risk_zscore, r.fraud_risk_percentile, r.fraud_risk_band) for r in out] == [(None, None, "LOW")] * 2


def test_month_spine_on_timestamp_layer(spark):
    t = Layers(spark, SF_SMALL).trends
    dense = timeseries.month_spine(t)
    assert dict(dense.dtypes)["claim_month"] == "timestamp"
    assert dense.count() >= t.count()
    assert dense.join(t, ["policy_type", "claim_month"], "left_anti").where("claim_count != 0").count() == 0


def test_cluster_conf_keys_are_valid_session_settings(spark):
    from riskweave.session import cluster_conf

    conf = cluster_conf(shuffle_bytes=10 * 1024**4, total_cores=4000)
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)  # raises on an unknown or static key
            assert spark.conf.get(k) == v
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
