"""Bounded samples, sketches, heavy hitters, incremental gold, CSV rejects, versioned tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from riskweave.operators import gold, goldstate, joins, quality, scoring, sketches
from riskweave.plans import medallion
from riskweave.plans.layers import Layers
from riskweave.session import scratch_dir
from riskweave.sources import files, versions
from riskweave.streaming import incremental


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- samples in the suite's pass ---------------------------------------------------

def test_samples_are_the_smallest_distinct_bad_values(spark):
    rng = random.Random(1)
    rows = [(None if i % 5 == 0 else i, float(rng.choice([-3, -3, -2, float("nan"), 1, 9, 8, 7, 6, 5, 4.5])), rng.choice(["b", "a", "c", None, "ok"])) for i in range(300)]
    rows += [(1, None, "ok"), (1, 2.0, "ok")]
    df = spark.createDataFrame(rows, "id long, x double, s string").repartition(7)
    suite = quality.Suite("t", [
        quality.NotNull("id", "id"), quality.Between("x", "x", min_value=0, max_value=4), quality.InSet("s", "s", values=("ok",)),
        quality.Unique("once", "id"), quality.RowCount("rows", min_value=1), quality.UniqueProportion("mostly", "id", min_value=0.5),
    ])
    want = {"id": [None], "x": ["-3.0", "-2.0", "4.5", "5.0"], "s": ["a", "b", "c"], "once": ["1"]}
    got = {}
    for r in quality.unexpected_sample(df, suite, 4).collect():
        got.setdefault(r["check_name"], []).append(r["unexpected_value"])
    assert got == want
    told = quality.checked(df, suite, 4)
    assert {r["check_name"]: r["samples"] for r in told if r["samples"]} == want
    plain = quality.evaluate(df, suite).orderBy("check_order").collect()
    for a, b in zip(told, plain):
        assert [a[c] for c in ("check_name", "success", "element_count", "unexpected_count", "dq_score")] == [
            b[c] for c in ("check_name", "success", "element_count", "unexpected_count", "dq_score")]
    everything = quality.unexpected_sample(df, suite, 100, failed=["x"]).collect()
    assert [r["unexpected_value"] for r in everything][-1] == "NaN" and {r["check_name"] for r in everything} == {"x"}


def test_samples_scan_once_and_shuffle_few_rows(spark):
    customers = spark.read.parquet(f"{SF_CHECK}/customer.parquet")
    suite = quality.Suite("c", [quality.Between("a", "c_acctbal", max_value=-10**6), quality.NotNull("b", "c_custkey"), quality.InSet("n", "c_nationkey", values=(99,))])
    df = quality.unexpected_sample(customers, suite, 5)
    assert plan_of(df).count("FileScan") == 1
    told, _ = quality._sampled(customers.repartition(4), suite, 5, None)[0]
    task_rows = told._jdf.queryExecution().toRdd().toDebugString()  # planned and runnable
    assert task_rows
    assert {r["check_name"] for r in df.collect()} == {"a", "n"}
    assert quality.unexpected_sample(customers.limit(0), suite, 5).count() == 0


# ---- sketches -------------------------------------------------------------------------

def test_union_of_states_answers_like_one_sketch(spark):
    df = spark.range(40_000).select(
        F.pmod(F.xxhash64("id"), F.lit(9000)).alias("k"), F.when(F.col("id") % 10 > 5, None).when(F.col("id") % 10 > 2, 0.5).otherwise(F.rand(3)).alias("x"),
        F.lit(None).cast("string").alias("none"), F.to_date(F.lit("2024-01-01")).alias("d"), (F.col("id") % 7).alias("load"),
    ).persist()
    path = scratch_dir(spark, "states")
    for i in range(7):  # each load by itself, its state stored with it
        sketches.load_states(df.where(F.col("load") == i), ["k", "x", "none", "d"], F.col("load")).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    whole = sketches.load_states(df, ["k", "x", "none", "d"], F.lit("all"))
    got = {r["column"]: r for r in sketches.distinct_counts(stored).collect()}
    one = {r["column"]: r for r in sketches.distinct_counts(whole).collect()}
    for c in ("k", "x", "none", "d"):
        assert got[c]["estimate"] == one[c]["estimate"] and got[c]["rows"] == one[c]["rows"] == 40_000 and got[c]["loads"] == 7
        exact = df.select(F.countDistinct(c)).first()[0]
        assert abs(got[c]["estimate"] - exact) <= sketches.distinct_error() * exact
    shares = {r["column"]: r for r in sketches.unique_shares(stored).collect()}
    assert shares["k"]["low"] <= 9000 / 40_000 <= shares["k"]["high"] and "none" not in shares
    bounds = sketches.quantile_bounds(stored, "x", 8)
    assert 1 < len(bounds) <= 7 and sketches.quantile_bounds(stored, "none", 8) == [] and sketches.quantile_bounds(stored, "x", 1) == []
    assert sketches.distinct_counts(sketches.load_states(df.limit(0), ["k"], F.lit("x"))).count() == 0
    df.unpersist()


def test_percentile_from_stored_states_is_exact_and_even(spark):
    """60 % NULL, 30 % equal scores: exact, without a pass for the bounds, and no range holds much."""
    rows = [(i, None if i % 10 < 6 else 0.5 if i % 10 < 9 else (i * 7919 % 5000) / 5000) for i in range(5000)]
    df = spark.createDataFrame(rows, "id bigint, score double").repartition(4)
    states = sketches.load_states(df, ["score"], F.col("id") % 3)
    bounds = sketches.quantile_bounds(states, "score", 8)
    got = {r["id"]: r["p"] for r in scoring.with_percentile(df, "score", "p", bounds=bounds).collect()}
    want = {r["id"]: r["p"] for r in scoring.with_percentile(df, "score", "p", buckets=5).collect()}
    assert got == want
    # equal values collapse before they are placed: distinct scores a range, so tasks of the ranking window
    placed = df.where("score IS NOT NULL").select("score").distinct().select(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("score"))).alias("r"))
    sizes = [r["count"] for r in placed.groupBy("r").count().collect()]
    assert max(sizes) <= 0.6 * sum(sizes)


# ---- heavy hitters ----------------------------------------------------------------------

def fact_and_dim(spark, n=6000):
    fact = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 900).cast("bigint").alias("k"))
    dim = spark.range(1000).select(F.col("id").alias("k"), F.rpad(F.col("id").cast("string"), 300, "x").alias("wide"))
    return fact, dim


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_customer_is_split_without_a_parameter(spark, how):
    fact, dim = fact_and_dim(spark)
    assert joins.heavy_hitters(fact, "k", 0.05) == [7] == joins.hot_keys(fact, "k", 0.2)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = sorted(map(repr, fact.join(dim, "k", how).collect()))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8000")  # the dimension is larger, a customer's row is not
        joined = joins.skew_aware_join(fact, dim, "k", how)
        assert "Union" in plan_of(joined) and "BroadcastHashJoin" in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert sorted(map(repr, joined.collect())) == want
        # a hot row beyond the limit in bytes is not broadcast
        assert "Union" not in plan_of(joins.skew_aware_join(fact, dim, "k", how, broadcast_bytes=200))
        assert "Union" not in plan_of(joins.skew_aware_join(fact, dim, "k", how, hot_key_fraction=None))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Union" not in plan_of(joins.skew_aware_join(fact, dim, "k", how))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Union" not in plan_of(joins.skew_aware_join(fact, dim, "k", how))  # small enough to broadcast whole


def test_heavy_hitters_of_even_and_empty_keys(spark):
    assert joins.heavy_hitters(spark.range(5000).withColumnRenamed("id", "k"), "k", 0.05) == []
    assert joins.heavy_hitters(spark.range(0).withColumnRenamed("id", "k"), "k", 0.05) == []
    text = spark.range(300).select(F.when(F.col("id") < 100, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert joins.heavy_hitters(text, "k", 0.3) == ["hot"]
    assert joins.bytes_of(spark.createDataFrame([("abc", 1, None)], "a string, b int, c string")) == 11 + 8 + 8


# ---- incremental gold ---------------------------------------------------------------------

def test_loads_and_a_correction_equal_a_rebuild(spark):
    enriched = Layers(spark, SF_CHECK).enriched
    even = F.col("claim_id") % 2 == 0
    corrected = enriched.where("claim_id % 11 = 0").withColumns({"claim_amount": F.col("claim_amount") / 3, "state": F.lit("ZZ"), "claim_status": F.lit("DENIED")})
    rebuilt = enriched.where("claim_id % 11 <> 0").unionByName(corrected)
    for group, finish, whole in ((goldstate.KPI_GROUP, goldstate.kpi, gold.kpi_by_state), (goldstate.TREND_GROUP, goldstate.trends, gold.monthly_trends)):
        state = goldstate.merged(group, [goldstate.state_of(enriched.where(even), group), goldstate.state_of(enriched.where(~even), group)])
        assert sorted(map(tuple, finish(state).collect())) == sorted(map(tuple, whole(enriched).collect()))
        after = finish(goldstate.changed(state, group, enriched, corrected, "claim_id"))
        assert after.columns == whole(rebuilt).columns
        assert sorted(map(tuple, after.collect())) == sorted(map(tuple, whole(rebuilt).collect()))


def test_state_edge_cases(spark):
    schema = "claim_id long, state string, policy_type string, claim_amount double, fraud_risk_score double, fraud_risk_band string, claim_status string"
    old = spark.createDataFrame([(1, "CA", "Auto", 10.005, None, "LOW", "X"), (2, None, "Auto", None, 0.5, "HIGH", "DENIED")], schema)
    state = goldstate.state_of(old, goldstate.KPI_GROUP)
    told = {r["state"]: r for r in goldstate.kpi(state).collect()}
    assert (told["CA"]["total_claim_amount"], told["CA"]["avg_fraud_risk_score"]) == (10.01, None)
    assert (told[None]["total_claim_amount"], told[None]["avg_claim_amount"], told[None]["denied_claims"]) == (None, None, 1)
    moved = spark.createDataFrame([(1, "TX", "Auto", 1.0, 0.25, "LOW", "X"), (9, "TX", "Auto", 2.0, 0.25, "LOW", "X")], schema)
    after = {r["state"]: r["claim_count"] for r in goldstate.kpi(goldstate.changed(state, goldstate.KPI_GROUP, old, moved, "claim_id")).collect()}
    assert after == {None: 1, "TX": 2}  # the old group has no row left, so it is gone
    assert goldstate.kpi(goldstate.state_of(old.limit(0), goldstate.KPI_GROUP)).count() == 0


# ---- CSV rejects ------------------------------------------------------------------------------

def test_rejects_and_accepted_add_up(spark, tmp_path):
    lines = [
        "customer_id,note,age,state,fraud_risk_score", "1,a,34,CA,0.5", "2,b,old,TX,high", "C3,c,20,NY,0.1", ",d,20,NY,0.1", "5,e,20", "6,f,20,NY,0.1,more",
        "7,,,,", '8,"x, y",40, tx ,1e-1',
    ]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    schema = "customer_id BIGINT, age INT, state STRING, fraud_risk_score DOUBLE"
    good, bad = files.split_csv(spark, str(tmp_path / "in.csv"), schema, scratch_dir(spark, "split"), required=["customer_id"])
    assert sorted(map(tuple, good.collect())) == [(1, 34, "CA", 0.5), (7, None, None, None), (8, 40, " tx ", 0.1)]
    told = {tuple((r["column"], r["reason"], r["value"]) for r in row["rejects"]) for row in bad.collect()}
    assert told == {
        (("age", "not int", "old"), ("fraud_risk_score", "not double", "high")), (("customer_id", "not bigint", "C3"),),
        (("customer_id", "no value", None),), ((None, "number of fields", "5,e,20"),), ((None, "number of fields", "6,f,20,NY,0.1,more"),),
    }
    assert good.count() + bad.count() == len(lines) - 1
    with pytest.raises(ValueError, match="height"):
        files.split_csv(spark, str(tmp_path / "in.csv"), "height INT", scratch_dir(spark, "split"))
    (tmp_path / "clean.csv").write_text("customer_id,age,state,fraud_risk_score\n1,2,CA,0.5\n")
    good, bad = files.split_csv(spark, str(tmp_path / "clean.csv"), schema, scratch_dir(spark, "split"))
    assert (good.count(), bad.count()) == (1, 0)


# ---- versioned tables ----------------------------------------------------------------------------

def test_a_killed_write_leaves_the_old_table(spark):
    path = scratch_dir(spark, "versioned")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path)
    old = spark.range(100).withColumn("x", F.lit("old"))
    assert versions.write_version(old, path) == 0
    dying = spark.range(100_000).repartition(4).withColumn("x", F.when(F.col("id") == 99_000, F.raise_error(F.lit("killed"))).otherwise("new"))
    with pytest.raises(Exception, match="killed"):
        versions.write_version(dying, path)
    assert versions.versions(spark, path) == [0] and versions.read_version(spark, path).where("x = 'old'").count() == 100
    number = versions.write_version(spark.range(7).withColumn("x", F.lit("new")), path)
    assert versions.read_version(spark, path).count() == 7 and versions.read_version(spark, path, 0).count() == 100
    assert versions.versions(spark, path) == [0, number]
    spark.sql("CREATE DATABASE IF NOT EXISTS rw_versions")
    assert versions.replace_view(spark, "rw_versions.t", path) == number and spark.table("rw_versions.t").count() == 7
    assert 0 in versions.prune(spark, path, keep=1) and versions.versions(spark, path) == [number]


def test_stream_sink_switches_whole_versions(spark, monkeypatch):
    base = scratch_dir(spark, "versioned-stream")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.where("o_orderkey % 2 = 0").coalesce(1).write.parquet(f"{base}/in")
    customers = Layers(spark, SF_SMALL).customers_base

    def run():
        stream = incremental.trends_stream(incremental.file_stream(spark, f"{base}/in"), customers)
        incremental.run_aggregate_to_versions(stream, f"{base}/t", f"{base}/ck")

    run()
    first = sorted(map(tuple, versions.read_version(spark, f"{base}/t").collect()))
    orders.where("o_orderkey % 2 = 1").coalesce(1).write.mode("append").parquet(f"{base}/in")
    whole, write = sorted(map(tuple, Layers(spark, SF_SMALL).trends.collect())), versions.write_version

    def killed(batch, path, number, fmt):
        broken = batch.withColumn("claim_count", F.when(F.col("claim_count") >= 0, F.raise_error(F.lit("killed")).cast("long")))
        return write(broken, path, number, fmt)

    monkeypatch.setattr(versions, "write_version", killed)
    with pytest.raises(Exception):
        run()
    assert sorted(map(tuple, versions.read_version(spark, f"{base}/t").collect())) == first != whole
    monkeypatch.setattr(versions, "write_version", write)
    run()  # the batch is replayed under its own number
    assert sorted(map(tuple, versions.read_version(spark, f"{base}/t").collect())) == whole
    assert versions.versions(spark, f"{base}/t") == [0, 1]


def test_medallion_replaces_versioned_tables(spark):
    lay, base = Layers(spark, SF_SMALL), scratch_dir(spark, "medallion-versioned")
    for day in (1, 2):
        medallion.run_medallion(spark, lay.customers, lay.claims, base_path=base, execution_time=dt.datetime(2025, 1, day), versioned=True)
    store = medallion.Store(spark, base_path=base, versioned=True)
    assert store.read("silver_claims_enriched").count() == 1195
    assert versions.versions(spark, store.path("silver_claims_enriched")) == [0, 1]
    medallion.register_views(spark, store)
    assert spark.table("vw_executive_claims_by_state").count() == 10
    assert store.read("data_quality_check").count() == 16


# ---- listings ----------------------------------------------------------------------------------------

def test_catalog_scan_and_listings(spark):
    files.create_database(spark, "rw_listed")
    files.write_table(spark.range(9), name="rw_listed.t")
    assert files.read_table(spark, "rw_listed.t").count() == 9
    assert "rw_listed" in files.list_databases(spark) and "t" in files.list_tables(spark, "rw_listed")
    assert files.read_table(spark, "rw_listed.t").limit(5).count() == 5  # an unordered peek


def test_several_partitions_are_replaced_in_one_statement(spark):
    files.create_database(spark, "rw_parts")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        rows = [(1, "a", 1), (2, "a", 2), (3, "b", 1)]
        files.append_table(spark.createDataFrame(rows, "x int, p string, q int"), name="rw_parts.t", partition_by=["p", "q"])
        files.append_table(spark.createDataFrame([(9, "a", 2), (8, "c", 1)], "x int, p string, q int"), name="rw_parts.t", partition_by=["p", "q"])
        assert sorted(map(tuple, spark.table("rw_parts.t").collect())) == [(1, "a", 1), (3, "b", 1), (8, "c", 1), (9, "a", 2)]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_scratch_folders_are_released(spark, monkeypatch):
    import os

    from riskweave import session

    monkeypatch.setattr(session, "_scratch", {})
    paths = [scratch_dir(spark, "released") for _ in range(2)]
    spark.range(3).write.parquet(paths[0])
    assert session.release_scratch(spark) == 1 and not os.path.exists(paths[0].replace("file:", ""))
    assert session.release_scratch(spark) == 0
