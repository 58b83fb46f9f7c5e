"""Encoder tables, node tables, metrics and series against brute force, Spark ML and DuckDB."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from riskweave.operators import encoding, learning, metrics, ml, trees
from riskweave.plans.layers import Layers


# ---- metrics --------------------------------------------------------------------

def pairs_auc(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    if not pos or not neg:
        return None
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("parts,buckets", [(1, 1), (5, 3), (3, 40)])
def test_rank_auc_counts_every_pair(spark, parts, buckets):
    rng = random.Random(parts)
    rows = [("a", rng.choice([0.5, rng.randint(0, 20) / 20]), rng.random() < 0.3) for _ in range(400)]
    rows += [("one class", 0.1, True), ("one class", 0.2, True), (None, 0.3, True), (None, 0.2, False), (None, 0.3, False)]
    df = spark.createDataFrame([*rows, ("a", None, True), ("a", 0.7, None)], "g string, s double, y boolean").repartition(parts)
    got = {r["g"]: r for r in metrics.rank_auc(df, F.col("s"), F.col("y"), ["g"], buckets=buckets).collect()}
    for g in ("a", "one class", None):
        own = [(s, y) for k, s, y in rows if k == g]
        want = pairs_auc(own)
        assert got[g]["auc"] == (None if want is None else pytest.approx(want, abs=1e-12))
        assert (got[g]["positives"], got[g]["negatives"]) == (sum(y for _, y in own), sum(not y for _, y in own))
    every = metrics.rank_auc(df, F.col("s"), F.col("y"), buckets=buckets).collect()
    assert len(every) == 1 and every[0]["auc"] == pytest.approx(pairs_auc([(s, y) for _, s, y in rows]))
    collapsed = df.groupBy("s", "y").agg(F.count("*").alias("w"))
    assert metrics.rank_auc(collapsed, F.col("s"), F.col("y"), weight=F.col("w")).first()["auc"] == every[0]["auc"]


def test_rank_auc_of_a_hot_score_and_of_no_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 0.5).otherwise(F.col("id") / 3000.0).alias("s"), (F.col("id") % 7 == 0).alias("y"))
    want = pairs_auc([(r["s"], r["y"]) for r in df.collect()])
    assert metrics.rank_auc(df, F.col("s"), F.col("y"), buckets=16).first()["auc"] == pytest.approx(want, abs=1e-12)
    none = metrics.rank_auc(df.limit(0), F.col("s"), F.col("y"), buckets=4).collect()
    assert [tuple(r) for r in none] == [(0, 0, None)]


def test_class_and_error_metrics_equal_the_evaluators(spark):
    rng = random.Random(4)
    rows = [(float(rng.randint(0, 3)), float(rng.choice([0, 1, 1, 4])), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, prediction double, x double")
    told = metrics.class_metrics(metrics.confusion_counts(df, "label", "prediction")).first()
    for name, spark_name in (("accuracy", "accuracy"), ("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")):
        want = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=spark_name).evaluate(df)
        assert told[name] == pytest.approx(want, abs=1e-12), name
    off = metrics.error_metrics(df, "label", "x").first()
    for name in ("rmse", "mae"):
        assert off[name] == pytest.approx(RegressionEvaluator(labelCol="label", predictionCol="x", metricName=name).evaluate(df))
    nothing = metrics.class_metrics(metrics.confusion_counts(df.limit(0), "label", "prediction")).first()
    assert (nothing["rows"], nothing["accuracy"]) == (0, None)


def test_training_metrics_equal_the_evaluators(spark):
    enriched = Layers(spark, SF_CHECK).enriched
    models = ml.train_classifiers(enriched, num_trees=4, max_depth=4)
    rows = learning.labelled_sample(ml.classifier_frame(enriched), "claim_id", 0.1, 42)
    scored = models.transform(rows.where("split = 'test'"))
    exact = BinaryClassificationEvaluator(labelCol="is_denied", rawPredictionCol="denial_raw", numBins=0).evaluate(scored)
    assert models.metrics["denial_auc"] == pytest.approx(exact, abs=1e-9)
    for metric in ("accuracy", "f1"):
        want = MulticlassClassificationEvaluator(labelCol="policy_label", predictionCol="policy_prediction", metricName=metric).evaluate(scored)
        assert models.metrics[f"policy_{metric}"] == pytest.approx(want)
    assert models.test_rows == scored.count()


# ---- encoders as tables ---------------------------------------------------------------

def test_encoder_tables_equal_the_fitted_indexers(spark):
    enriched = Layers(spark, SF_CHECK).enriched
    models = ml.train_classifiers(enriched, num_trees=2, max_depth=2)
    told, _ = ml.claim_features(enriched)
    rows = learning.labelled_sample(ml.classifier_frame(enriched), "claim_id", 0.1, 42)
    by_model = models.labels["policy"].transform(models.features.transform(rows)).select(
        "claim_id", "split", "state_idx", "claim_type_idx", "policy_label", "is_denied", vector_to_array("features").alias("features")
    )
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, by_model.collect()))


def test_unseen_null_and_tied_categories(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    encoder = encoding.fit_categories(train, ["x"])
    assert [tuple(r) for r in encoder.orderBy("position").collect()] == [("x", "c", 0.0, 2), ("x", "a", 1.0, 1), ("x", "b", 2.0, 1)]
    rows = spark.createDataFrame([(1, "a"), (2, "new"), (3, None), (4, "c")], "id int, x string")
    kept = encoding.encode(rows, encoder, {"x": "i"}, "keep").orderBy("id").collect()
    assert [r["i"] for r in kept] == [1.0, 3.0, 3.0, 0.0]
    assert [r["i"] for r in encoding.encode(rows, encoder, {"x": "i"}, "skip").orderBy("id").collect()] == [1.0, 0.0]
    back = encoding.decode(encoding.encode(rows, encoder, {"x": "i"}), encoder, "x", "i", "y").orderBy("id").collect()
    assert [r["y"] for r in back] == ["a", None, None, "c"]
    with pytest.raises(ValueError):
        encoding.encode(rows, encoder, {"x": "i"}, "drop")
    joined = rows.withColumn("n", F.lit(2.0)).select("id", encoding.assemble(["n", "id"]).alias("f")).first()
    assert joined["f"] == [2.0, 1.0]


# ---- models as node tables --------------------------------------------------------------

DUCK_WALK = """
WITH RECURSIVE walk AS (
  SELECT r.id, r.features, n.tree, n.weight, 0 AS at FROM rows r, (SELECT DISTINCT tree, weight FROM nodes) n
  UNION ALL
  SELECT w.id, w.features, w.tree, w.weight,
    CASE WHEN (CASE WHEN n.categories IS NULL THEN w.features[n.feature + 1] <= n.threshold
                    ELSE list_contains(n.categories, w.features[n.feature + 1]) END) THEN n.go_left ELSE n.go_right END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.at WHERE n.feature IS NOT NULL),
ends AS (SELECT w.id, w.weight, n.value, n.votes FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.at WHERE n.feature IS NULL)
"""


def in_duck(nodes, rows, sql):
    con = duckdb.connect()
    con.register("nodes_frame", nodes.toArrow())
    con.register("rows_frame", rows.toArrow())
    con.execute("CREATE TABLE nodes AS SELECT * FROM nodes_frame")
    con.execute("CREATE TABLE rows AS SELECT * FROM rows_frame")
    return dict(con.execute(DUCK_WALK + sql).fetchall())


def test_forest_nodes_score_like_the_model_in_duckdb_and_in_spark(spark):
    enriched = Layers(spark, SF_CHECK).enriched
    models = ml.train_classifiers(enriched, num_trees=7, max_depth=5)
    told, encoder = ml.claim_features(enriched)
    test = told.where("split = 'test'")
    rows = learning.labelled_sample(ml.classifier_frame(enriched), "claim_id", 0.1, 42).where("split = 'test'")
    want = {r["claim_id"]: r for r in models.predictions(rows).collect()}
    nodes = trees.node_table(models.forests["denial"])
    assert nodes.where("categories IS NOT NULL").count() > 0 and trees.depth_of(nodes) == 5
    yes = in_duck(nodes, test.select(F.col("claim_id").alias("id"), "features"), "SELECT id, avg(votes[2]) FROM ends GROUP BY id")
    assert set(yes) == set(want)
    for k, share in yes.items():
        assert share == pytest.approx(want[k]["predicted_denied_probability"], abs=1e-9)
    got = {r["claim_id"]: r for r in ml.node_predictions(models, test, encoder).collect()}
    assert set(got) == set(want)
    for k, r in got.items():
        assert r["predicted_denied_probability"] == pytest.approx(want[k]["predicted_denied_probability"], abs=1e-9)
    same = sum(got[k]["predicted_policy_type"] == want[k]["predicted_policy_type"] for k in got)
    assert same >= 0.999 * len(got)  # a tie of two classes may fall either way in the last bit


def test_boosted_nodes_score_like_the_model(spark):
    models = ml.train_forecast(Layers(spark, SF_CHECK).trends, max_iter=6, max_depth=3)
    model = models.models["claim_count"]
    scored = model.transform(models.frame).select(
        F.xxhash64("claim_month", "policy_type").alias("id"), vector_to_array("_claim_count_features").alias("features"), "_claim_count"
    )
    want = {r["id"]: r["_claim_count"] for r in scored.collect()}
    nodes = trees.node_table(model.stages[-1])
    assert nodes.select("tree").distinct().count() == 6
    got = in_duck(nodes, scored.select("id", "features"), "SELECT id, sum(weight * value) FROM ends GROUP BY id")
    here = {r["id"]: r["prediction"] for r in trees.score_regression(scored, "id", "features", nodes, trees.depth_of(nodes)).collect()}
    for k, v in want.items():
        assert got[k] == pytest.approx(v) and here[k] == pytest.approx(v)
    with pytest.raises(ValueError):
        trees.tree_values(scored, "id", "features", nodes, 3, max_nodes=2)
    models.release()


# ---- series --------------------------------------------------------------------------------

def test_series_metrics_and_summary_recomputed_in_duckdb(spark):
    models = ml.train_forecast(Layers(spark, SF_CHECK).trends, max_iter=4, max_depth=2)
    out = ml.forecast_rows(models)
    assert out.columns == ["claim_month", "policy_type", "metric", "actual_value", "predicted_value", "forecast_type"]
    con = duckdb.connect()
    con.register("f", out.toPandas())
    for metric, rmse, mae in con.execute(
        "SELECT metric, sqrt(avg((actual_value - predicted_value) ** 2)), avg(abs(actual_value - predicted_value)) FROM f"
        " WHERE forecast_type = 'holdout' GROUP BY metric"
    ).fetchall():
        assert models.metrics[metric] == {"rmse": pytest.approx(rmse), "mae": pytest.approx(mae)}
    want = con.execute(
        "SELECT forecast_type, metric, policy_type, round(avg(actual_value), 2), round(avg(predicted_value), 2) FROM f GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"
    ).fetchall()
    got = [tuple(r) for r in ml.forecast_summary(out).collect()]
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want):
        assert g[4] == pytest.approx(w[4], abs=0.011) and (g[3] is None) == (w[3] is None or w[3] != w[3])
    models.release()
    assert not models.frame.is_cached


def test_confusion_recomputed_in_duckdb(spark):
    enriched = Layers(spark, SF_CHECK).enriched
    preds = ml.claim_predictions(ml.train_classifiers(enriched, num_trees=3, max_depth=3), enriched)
    con = duckdb.connect()
    con.register("p", preds.toPandas())
    want = con.execute(
        "SELECT actual_policy_type, predicted_policy_type, count(*) AS cnt FROM p GROUP BY 1, 2 ORDER BY cnt DESC, 1, 2 LIMIT 8"
    ).fetchall()
    assert [tuple(r) for r in ml.confusion(preds, "actual_policy_type", "predicted_policy_type", 8).collect()] == want


def test_general_names(spark):
    """The same operators on other columns: nothing of the claims is built in."""
    rows = [(i, float(i % 50), ["x", "y", "z"][i % 3], "u" if i % 50 > 25 else "v") for i in range(600)]
    df = spark.createDataFrame(rows, "k long, size double, kind string, side string")
    inputs = learning.Inputs("k", ("size",), ("kind",))
    targets = (learning.Target("which", "side"), learning.Target("is_u", "side", positive="u"))
    models = learning.train(df, inputs, targets, fraction=1.0, num_trees=3, max_depth=3, min_rows=10)
    assert models.metrics["which_accuracy"] > 0.95 and models.metrics["is_u_auc"] > 0.95
    series = learning.Series("at", "name", F.month("at"), ("v",))
    told = spark.createDataFrame([(dt.datetime(2024, m, 1), n, float(m)) for m in range(1, 9) for n in "ab"], "at timestamp, name string, v double")
    out = learning.train_series(told, series, max_iter=2, max_depth=2, holdout=2).forecast()
    assert {(r["forecast_type"], r["count"]) for r in out.groupBy("forecast_type").count().collect()} == {("holdout", 4), ("forward", 2)}
    with pytest.raises(learning.InsufficientDataError):
        learning.train_series(told.where("name = 'a'").limit(2), series)


def test_guard_releases_the_frame(spark):
    few = Layers(spark, SF_SMALL).trends.limit(5)
    few.collect()  # the layers below are cached by now
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(ml.InsufficientDataError):
        ml.train_forecast(few)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
