"""Connected components of a table of links, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import NARROW, staged


def connected_components(links: DataFrame) -> DataFrame:
    """``id, label`` of every id in ``links`` (columns ``a, b``): the smallest id it reaches.

    Each round an id takes the smallest of itself and its neighbours, and then
    the end of that chain.  The links go on between the chains' ends, those
    inside a part are dropped and equal ones are one, so a link that is settled
    is not gone through again.  Every round is a written table; no links or
    labels come to the driver.
    """
    links, labels = staged(links.select("a", "b"), "links", NARROW), None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
        ends = chain_ends(staged(least, "labels", NARROW))
        labels = ends if labels is None else staged(_through(labels, ends), "labels", NARROW)
        for side in ("a", "b"):
            links = links.join(ends.select(F.col("id").alias(side), F.col("label").alias(f"_{side}")), side)
        links = links.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).where("a <> b").distinct()
        links = staged(links, "links", NARROW)
        if links.isEmpty():
            return labels


def chain_ends(steps: DataFrame) -> DataFrame:
    """``id, label`` with the last id that ``steps`` (``id, label``; label <= id) lead to; chains halve each time."""
    while True:
        target = steps.select(F.col("id").alias("label"), F.col("label").alias("next"))
        after = staged(steps.join(target, "label").select("id", F.col("label").alias("old"), F.col("next").alias("label")), "labels", NARROW)
        steps = after.select("id", "label")
        if after.where("old <> label").isEmpty():
            return steps


def _through(labels: DataFrame, ends: DataFrame) -> DataFrame:
    """``labels`` with each label replaced by its own in ``ends``, if it has one there."""
    target = ends.select(F.col("id").alias("label"), F.col("label").alias("next"))
    return labels.join(target, "label", "left").select("id", F.coalesce("next", "label").alias("label"))


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``id, label`` after more ``links``.

    Earlier links are not gone through again: the new ones are links between
    labels, and only those of different labels are followed.
    """
    of_a = labels.select(F.col("id").alias("_a"), F.col("label").alias("_x"))
    of_b = labels.select(F.col("id").alias("_b"), F.col("label").alias("_y"))
    ends = links.join(of_a, F.col("a") == F.col("_a"), "left").join(of_b, F.col("b") == F.col("_b"), "left")
    ends = ends.select(F.coalesce("_x", "a").alias("a"), F.coalesce("_y", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()
    joined = connected_components(ends)
    fresh = links.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(labels, "id", "left_anti")
    every = labels.select("id", "label").unionByName(fresh.select("id", F.col("id").alias("label")))
    return staged(_through(every, joined), "labels", NARROW)
