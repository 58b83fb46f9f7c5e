"""Links inside overlapping groups without their pairs: rounds of pivots.

Groups (``g, id``) hold members that may be linked.  Groups with equal members
are one, counted.  In a round every group that is still open, its members in
different components, names one pivot: the member with the most shared groups
of those it has not named yet.  Every member is then compared with the one
such pivot that it shares most groups with, so a round compares one pair a
member, whatever the groups' sizes.  Comparisons are on full sets; a pivot's
set is sent to as many tasks as its partners need.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import NARROW, WIDE, staged

#: Bytes of sets in one task's bucket, and partners of a pivot in it.
BUCKET_BYTES, PARTNERS = 32 << 20, 256


def stretches(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows equal in all columns, of rows ordered by them."""
    if not len(columns[0]):
        return []
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    edges = [*np.flatnonzero(new).tolist(), len(new)]
    return list(zip(edges[:-1], edges[1:]))


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def merged_groups(each: DataFrame) -> DataFrame:
    """``g, id, n, alike, degree`` of the groups ``g, id`` (a member once) of two
    members or more: groups with equal members are one, ``alike`` says how
    many; ``degree`` counts a member's groups, once for each other member."""
    named = each.groupBy("g").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")
    )
    named = named.where("n > 1").groupBy("n", "x", "y").agg(F.min("g").alias("g"), F.count("*").alias("alike"))
    met = staged(each.join(named.select("g", "n", "alike"), "g"), "pivot-groups", WIDE)
    degree = met.groupBy("id").agg(F.sum((F.col("n") - 1) * F.col("alike")).alias("degree"))
    return staged(met.join(degree, "id").select("g", "id", "n", "alike", "degree"), "pivot-groups", WIDE)


def labelled(met: DataFrame, labels: DataFrame) -> DataFrame:
    """The groups' rows with their component's ``label`` (a member without links: its own id)."""
    return met.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def open_groups(now: DataFrame) -> DataFrame:
    """``g`` of the groups whose members are in different components."""
    return now.groupBy("g").agg((F.min("label") != F.max("label")).alias("open")).where("open").select("g")


def pivot_pairs(met: DataFrame, labels: DataFrame, named: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(one pair ``a, b`` a member of an open group, the groups' pivots ``g, id``)."""
    now = labelled(met, labels)
    fresh = now if named is None else now.join(named, ["g", "id"], "left_anti")
    rank = F.struct("degree", F.xxhash64("id"), "id", "label")
    pivots = fresh.join(open_groups(now), "g", "left_semi").groupBy("g").agg(F.max(rank).alias("p"))
    pivots = staged(pivots.select("g", F.col("p.id").alias("pivot"), F.col("p.label").alias("its")), "pivots", NARROW)
    near = now.join(pivots, "g").where("label <> its").groupBy("id", "pivot").agg(F.sum("alike").alias("shared"))
    best = near.groupBy("id").agg(F.max(F.struct("shared", "pivot")).alias("p"))
    return staged(best.select(F.col("id").alias("a"), F.col("p.pivot").alias("b")), "pivot-pairs", NARROW), pivots.select("g", F.col("pivot").alias("id"))


def confirmed(maybe: DataFrame, sizes: DataFrame, sets: DataFrame, linked: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """The pairs ``a, b`` (b: the pivot) that are links by their full sets.

    ``sizes`` is ``id, size`` and ``sets`` is ``id, features`` (sorted
    little-endian uint64); ``linked(shared, size, size)`` decides.
    """
    shares = maybe.groupBy("b").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("shares"))
    dealt = maybe.join(shares, "b").select("a", "b", "shares", F.pmod(F.xxhash64("a"), "shares").cast("int").alias("share"))
    dealt = staged(dealt, "pivot-pairs", NARROW)
    pivot = dealt.select("b", "share").distinct().select(F.col("b").alias("id"), "b", "share", F.lit(True).alias("pivot"))
    wanted = dealt.select(F.col("a").alias("id"), "b", "share", F.lit(False).alias("pivot")).unionByName(pivot)
    load = wanted.join(sizes.select("id", "size"), "id").agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-8 * load // BUCKET_BYTES))
    rows = wanted.join(sets, "id").withColumn("bucket", F.pmod(F.xxhash64("b", "share"), F.lit(buckets)))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("b", "ascending"), ("share", "ascending"), ("pivot", "descending")])
        ids, b, share = (numbers(table, c) for c in ("id", "b", "share"))
        own = table["features"].to_pylist()
        out = []
        for low, high in stretches(b, share):
            centre = np.frombuffer(own[low], "<u8")
            size = np.array([len(x) // 8 for x in own[low + 1 : high]], np.int64)
            flat = np.frombuffer(b"".join(own[low + 1 : high]), "<u8")
            hit = centre[np.minimum(np.searchsorted(centre, flat), len(centre) - 1)] == flat
            shared = np.add.reduceat(hit, np.cumsum(size) - size, dtype=np.int64)
            good = linked(shared, size, np.int64(len(centre)))
            out.append(np.stack([ids[low + 1 : high][good], np.full(good.sum(), b[low])]))
        a, b = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        return pa.table({"a": pa.array(a.astype(np.int64)), "b": pa.array(b.astype(np.int64))})

    return staged(rows.groupBy("bucket").applyInArrow(compare, "a bigint, b bigint"), "pivot-links")
