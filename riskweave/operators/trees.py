"""Fitted tree ensembles as node tables, scored by joins.

``node_table`` turns a fitted forest or boosted ensemble into rows
``tree, weight, node, feature, threshold, categories, go_left, go_right,
value, votes``: an inner node sends a row left if its feature is at most the
threshold, or is one of the categories; a leaf (``feature`` NULL) has the
value, and for a classifier the class shares (``votes``).  The table is an
ordinary stored table, so a stored model can be audited in SQL and scored
without the model object.

``tree_values`` walks all trees of a row level by level: each level is one
join on (tree, node) with the node table.  That table has at most trees x
2^(depth + 1) rows by the model's own parameters (a proven bound, checked
against ``max_nodes``), so it is broadcast and the walk needs no shuffle; the
trees' values meet in one grouped sum by the row's key, combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import scratch_dir

#: Largest node table that is broadcast (a node is a few numbers).
MAX_NODES = 4_000_000


def node_table(model, path: str | None = None) -> DataFrame:
    """The nodes of a fitted tree ensemble (read from the model's own saved form)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    path = path or scratch_dir(spark, "model")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "_meta", "weight").drop("_meta")
    leaf = F.col("leftChild") < 0
    ordered = F.col("split.numCategories") < 0
    test = F.col("split.leftCategoriesOrThreshold")
    shares = F.transform("impurityStats", lambda x: x / F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b))
    return nodes.join(weights, "treeID").select(
        F.col("treeID").alias("tree"),
        "weight",
        F.col("id").alias("node"),
        F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf & ordered, test[0]).alias("threshold"),
        F.when(~leaf & ~ordered, test).alias("categories"),
        F.when(~leaf, F.col("leftChild")).alias("go_left"),
        F.when(~leaf, F.col("rightChild")).alias("go_right"),
        F.col("prediction").alias("value"),
        shares.alias("votes"),
    )


def depth_of(nodes: DataFrame) -> int:
    """Levels below the roots, found level by level in the table (a number a level)."""
    level, depth = nodes.where("node = 0").select("tree", "go_left", "go_right"), 0
    while True:
        children = level.where("go_left IS NOT NULL").select("tree", F.explode(F.array("go_left", "go_right")).alias("child"))
        if children.isEmpty():
            return depth
        below = nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "go_left", "go_right")
        level = children.join(below, (F.col("tree") == F.col("_t")) & (F.col("child") == F.col("_n"))).select("tree", "go_left", "go_right")
        depth += 1


def tree_values(rows: DataFrame, key: str, features: str, nodes: DataFrame, depth: int, max_nodes: int = MAX_NODES) -> DataFrame:
    """``key, tree, weight, value, votes`` of the leaf that each row (``features``: an
    array of doubles) reaches in every tree."""
    if nodes.count() > max_nodes:
        raise ValueError(f"the model has over {max_nodes} nodes")
    step = F.broadcast(nodes.select(
        F.col("tree").alias("_t"), F.col("node").alias("_n"), "feature", "threshold", "categories", "go_left", "go_right",
    ))
    # a row a tree of the model
    trees = [F.struct(F.lit(r["tree"]).alias("tree"), F.lit(r["weight"]).alias("weight")) for r in nodes.where("node = 0").select("tree", "weight").collect()]
    now = rows.select(key, features, F.explode(F.array(*trees)).alias("_r")).select(key, features, "_r.tree", "_r.weight", F.lit(0).alias("at"))
    for _ in range(depth):
        x = F.get(F.col(features), F.col("feature"))
        left = F.when(F.col("categories").isNull(), x <= F.col("threshold")).otherwise(F.array_contains(F.col("categories"), x))
        ahead = F.when(F.col("feature").isNull(), F.col("at")).when(left, F.col("go_left")).otherwise(F.col("go_right"))
        met = now.join(step, (F.col("tree") == F.col("_t")) & (F.col("at") == F.col("_n")))
        now = met.select(key, features, "tree", "weight", ahead.alias("at"))
    ends = F.broadcast(nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "value", "votes"))
    return now.join(ends, (F.col("tree") == F.col("_t")) & (F.col("at") == F.col("_n"))).select(key, "tree", "weight", "value", "votes")


def score_regression(rows: DataFrame, key: str, features: str, nodes: DataFrame, depth: int) -> DataFrame:
    """``key, prediction``: the weighted sum of the trees' values (boosted ensembles)."""
    told = tree_values(rows, key, features, nodes, depth)
    return told.groupBy(key).agg(F.sum(F.col("weight") * F.col("value")).alias("prediction"))


def score_classes(rows: DataFrame, key: str, features: str, nodes: DataFrame, depth: int, classes: int) -> DataFrame:
    """``key, prediction, shares``: the class with the largest mean share (the first of equal ones)."""
    told = tree_values(rows, key, features, nodes, depth)
    summed = told.groupBy(key).agg(F.count("*").alias("_n"), *[F.sum(F.col("votes")[i]).alias(f"_v{i}") for i in range(classes)])
    shares = F.array(*[F.col(f"_v{i}") / F.col("_n") for i in range(classes)])
    best = F.array_position(F.col("shares"), F.array_max("shares")) - 1
    return summed.select(key, shares.alias("shares")).select(key, best.cast("double").alias("prediction"), "shares")
