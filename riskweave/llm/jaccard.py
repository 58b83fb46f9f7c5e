"""Exact n-gram Jaccard join with PartEnum signatures, and its components.

A document's set is its distinct word n-grams (64-bit hashes); documents with
equal sets are one class, and only classes are joined.  Sets with Jaccard
similarity 3/4 or more have a symmetric difference of at most (|A|+|B|)/7.

Size bands grow by 4/3, so a partner lies in the same or the next band; a set
emits signatures at its own level and the next one.  A level partitions the
feature domain by a hash into n1 parts of n2 cells.  If n1 (k2 + 1) exceeds
the distance, some part differs in at most k2 cells, so enumerating the
subsets of n2 - k2 cells of every part gives the two sets a common signature
(the hash of the subset's content).  Large bands use n2 = 3, k2 = 1; middle
ones n2 = 1, k2 = 0; small ones one cell a feature.

Empty subsets would make unrelated sets meet, and so do frequent signatures
(a passage that many documents share).  A part is live in a set if all its
signatures have content and are not frequent.  If the live parts times
(k2 + 1) exceed the distance, the set can do without its other signatures:
any partner shares a live part with it.  A set with too few live parts keeps
its frequent signatures, and with still too few its empty ones, so no link is
lost.  Frequencies are exact counts.  To keep a signature that a large share
of all documents has out of the exchange altogether, a list of the most
common ones is drawn from a bounded hash sample (``sample_docs``); the same
rule makes the result independent of what is on it.

Signatures are brought together in hash buckets as numpy blocks.  Classes
that share one form a group.  Groups are not expanded into pairs: rounds of
pivots (``pivots.py``) compare one pair a class and round and contract the
links to components.  Then all members that are still in different components
are compared: pair by pair in small groups, and in large ones by products of
0/1 matrices over blocks of a whole family of groups.  A comparison first
bounds the intersection by the cell counts of both sets, which rules out most
pairs, and then takes the whole sets; both are exact.

Edge cases: a null or empty text has an empty set and is linked with nothing;
with fewer than n words the whole sequence is the only feature; repeated rows
fall into one class; a component without any key has a null id; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import (
    NARROW, SLICE_BYTES, WIDE, join_small, mix64, plain, shingle_sets, slices, staged, text_bytes, text_sizes, words,
)
from riskweave.llm import pivots
from riskweave.llm.components import connected_components, extended

#: Bands up to this size use one cell a feature; from LARGE on, subsets are enumerated.
SMALL, LARGE = 64, 1024


@dataclass(frozen=True)
class Level:
    """How sets of one band and the band below are partitioned."""

    number: int
    largest: int
    parts: int  # 0: one cell a feature
    cells: int = 1
    spare: int = 0  # k2


@lru_cache(maxsize=None)
def level(number: int) -> Level:
    low, high = 1, 1  # band 0
    for _ in range(number):
        low = high + 1
        high = low * 4 // 3
    if high <= SMALL:
        return Level(number, high, 0)
    if high < LARGE:
        return Level(number, high, -(-2 * high // 5))
    return Level(number, high, -(-high // 5), 3, 1)


def band(size: int) -> int:
    number = 0
    while level(number).largest < size:
        number += 1
    return number


_STEP = np.uint64(0x9E3779B97F4A7C15)


def signatures(features: np.ndarray, at: Level, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(rare, common) signatures that a set emits at a level (sorted ``common``
    list), and how many of its live parts it can do without."""
    size = len(features)
    distance = (size + min(size * 4 // 3, at.largest)) // 7
    none = np.zeros(0, np.uint64)
    if distance == 0:  # only equal sets are that close, and they are one class
        return none, none, 0
    salt = mix64(np.array([at.number + 1], np.uint64))[0]
    if at.parts == 0:
        found = mix64(features ^ salt)[:, None]
        filled = np.ones(found.shape, bool)
    else:
        mixed = mix64(features + salt)
        n = at.parts * at.cells
        cell = (((mixed >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        starts = np.searchsorted(cell[order], np.arange(n))
        count = np.bincount(cell, minlength=n)
        content = np.zeros(n, np.uint64)
        full = count > 0
        content[full] = np.add.reduceat(mix64(mixed[order]), starts[full])
        content, count = content.reshape(-1, at.cells), count.reshape(-1, at.cells)
        found, filled = [], []
        for k, subset in enumerate(combinations(range(at.cells), at.cells - at.spare)):
            place = (np.arange(at.parts, dtype=np.uint64) * np.uint64(64) + np.uint64(k)) * _STEP + salt
            for c in subset:
                place = mix64(place + content[:, c])
            found.append(place)
            filled.append(count[:, subset].sum(axis=1) > 0)
        found, filled = np.stack(found, axis=1), np.stack(filled, axis=1)
    rare = ~is_in(found, common)
    needed = distance // (at.spare + 1) + 1
    if (live := int((filled & rare).all(axis=1).sum())) >= needed:
        return found[filled & rare], none, live - needed
    if int(filled.all(axis=1).sum()) >= needed:
        return found[filled & rare], found[filled & ~rare], -1
    return found[rare], found[~rare], -1


def is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(values.shape, bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _sets(batches: Iterator[pa.RecordBatch], column: int, n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for i, j in slices(text_sizes(batch.column(column)), SLICE_BYTES):
            part = batch.slice(i, j - i)
            data, offsets = text_bytes(part.column(column))
            yield part, shingle_sets(*words(data, offsets, lower=True), n)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def class_id(features: np.ndarray) -> int:
    return _signed(xxhash.xxh3_64_intdigest(features.tobytes()))


def cell_counts(features: np.ndarray) -> bytes:
    """How many features fall into each of about ``size`` cells (a power of
    two), a byte each; empty if a cell has more than a byte tells."""
    bits = max(0, len(features).bit_length() - 1)
    cell = (mix64(features) >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)
    count = np.bincount(cell, minlength=1 << bits)
    return count.astype(np.uint8).tobytes() if count.max(initial=0) < 256 else b""


def may_link(x: bytes, y: bytes, size_x: int, size_y: int) -> bool:
    """False only if the cell counts rule out 3/4 similarity."""
    most = min(size_x, size_y)
    if x and y:
        a, b = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
        n = min(len(a), len(b))
        most = int(np.minimum(a.reshape(n, -1).sum(axis=1), b.reshape(n, -1).sum(axis=1)).sum())
    return 100 * most >= 75 * (size_x + size_y - most)


def document_sets(docs: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """``key, tie, id, proof, size, cells`` of every row; ``id`` names its class,
    ``proof`` is a second digest of the set, ``cells`` are its cell counts."""
    rows = docs.select(plain(key).alias("key"), F.xxhash64(plain(text)).alias("tie"), plain(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, 2, n):
            yield pa.record_batch(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([class_id(x) for x in sets], pa.int64()),
                    pa.array([_signed(xxhash.xxh64_intdigest(x.tobytes(), 1)) for x in sets], pa.int64()),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([cell_counts(x) for x in sets], pa.binary()),
                ],
                names=["key", "tie", "id", "proof", "size", "cells"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, tie bigint, id bigint, proof bigint, size bigint, cells binary")


def common_signatures(docs: DataFrame, n: int, text: str, sample_docs: int, least: int, most: int) -> np.ndarray:
    """Signatures of at least ``least`` of about ``sample_docs`` sampled classes (``most`` of them at most)."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    place = F.pmod(F.xxhash64(plain(text), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = docs.select(plain(text).alias("text")).where(F.col("text").isNotNull() & (place < F.lit(share))).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for _, sets in _sets(batches, 0, n):
            every = [signatures(x, level(band(len(x)) + k), none)[0] for x in sets if len(x) for k in (0, 1)]
            found, count = np.unique(np.concatenate(every) if every else none, return_counts=True)
            yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(count)], names=["signature", "n"])

    counts = rows.mapInArrow(run, "signature bigint, n bigint").groupBy("signature").agg(F.sum("n").alias("n"))
    # at most ``most`` numbers
    found = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "signature").limit(most).toPandas()["signature"]
    return np.sort(found.to_numpy().astype(np.int64).view(np.uint64))


def groups(docs: DataFrame, n: int, text: str, common: np.ndarray, buckets: int, frequent: int) -> DataFrame:
    """Classes that share a signature (equal groups of a bucket once), as rows
    ``g, id, code, frequent``: ``code`` is 2 * (parts to spare) + level 0 or 1,
    ``frequent`` whether the group has more members than that.  A row without
    ``g`` counts, in ``frequent``, the frequent signatures that a class has in a bucket."""
    listed = docs.sparkSession.sparkContext.broadcast(common)
    rows = docs.select(plain(text).alias("text")).where(F.col("text").isNotNull())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for _, sets in _sets(batches, 0, n):
            once = {class_id(x): x for x in sets if len(x)}
            ids, codes, rare, hot = [], [], [], []
            for own, x in once.items():
                b = band(len(x))
                for k in (0, 1):
                    r, h, spare = signatures(x, level(b + k), listed.value)
                    ids.append(own)
                    codes.append(2 * spare + k)
                    rare.append(r)
                    hot.append(h)
            ids, codes = np.array(ids, np.int64), np.array(codes, np.int32)
            out = {"bucket": [], "common": [], "ids": [], "codes": [], "counts": [], "signatures": []}

            def add(bucket: int, is_common: bool, owner: np.ndarray, values: np.ndarray) -> None:
                at, count = np.unique(owner, return_counts=True)
                for name, x in zip(out, (bucket, is_common, ids[at], codes[at], count.astype(np.int32), values)):
                    out[name].append(x if np.isscalar(x) else x.tobytes())

            for lists, is_common in ((rare, False), (hot, True)):
                every = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
                owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                if not len(every):
                    continue
                if is_common:  # known to be shared; they need not meet
                    turn += 1
                    add(turn % buckets, True, owner, every)
                    continue
                bucket = (((every >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.diff(bucket[order])) + 1
                for at in np.split(order, edges):
                    # the bucket stands for the high bits; a clash of the low ones costs a comparison
                    add(int(bucket[at[0]]), False, owner[at], every[at].astype(np.uint32))
            yield pa.record_batch(
                [pa.array(x, t) for x, t in zip(out.values(), (pa.int32(), pa.bool_(), *[pa.binary()] * 4))], names=list(out)
            )

    blocks = rows.mapInArrow(emit, "bucket int, common boolean, ids binary, codes binary, counts binary, signatures binary")

    def meet(table: pa.Table) -> pa.Table:
        out = []
        for is_common in (False, True):
            part = table.filter(pa.compute.equal(table["common"], is_common))
            if not part.num_rows:
                continue
            joined = [b"".join(part[c].to_pylist()) for c in ("ids", "codes", "counts", "signatures")]
            count = np.frombuffer(joined[2], "<i4")
            ids = np.repeat(np.frombuffer(joined[0], "<i8"), count)
            codes = np.repeat(np.frombuffer(joined[1], "<i4"), count)
            if is_common:
                known = np.frombuffer(joined[3], "<i8")
                out.append((known, ids, codes, np.zeros(len(ids), np.int32), np.ones(len(ids), bool)))
                continue
            values = np.frombuffer(joined[3], "<u4")
            order = np.lexsort((ids, values))
            values, ids, codes = values[order], ids[order], codes[order]
            keep = np.ones(len(values), bool)  # a class once a signature
            keep[1:] = (values[1:] != values[:-1]) | (ids[1:] != ids[:-1])
            values, ids, codes = values[keep], ids[keep], codes[keep]
            start = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
            length = np.diff(np.concatenate([start, [len(values)]]))
            start, length = start[length > 1], length[length > 1]
            if not len(start):
                continue
            member = np.repeat(np.arange(len(start)), length)
            place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length - start, length)
            often = (length > frequent)[member]
            at = place[often]
            if len(at):
                order = at[np.lexsort((codes[at], ids[at]))]
                new = np.ones(len(order), bool)
                new[1:] = (ids[order][1:] != ids[order][:-1]) | (codes[order][1:] != codes[order][:-1])
                first = np.flatnonzero(new)
                many = np.diff(np.concatenate([first, [len(order)]])).astype(np.int32)
                none = np.zeros(len(first), bool)
                out.append((np.zeros(len(first), np.int64), ids[order][first], codes[order][first], many, none))
            # equal member lists have equal sums of scrambled ids; one of them is enough
            name = np.add.reduceat(mix64(ids[place].view(np.uint64)), np.cumsum(length) - length)
            chosen = np.zeros(len(start), bool)
            chosen[np.unique(name, return_index=True)[1]] = True
            own = chosen[member]
            out.append((name[member[own]].view(np.int64), ids[place[own]], codes[place[own]], often[own].astype(np.int32), np.ones(own.sum(), bool)))
        g, ids, codes, often, real = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
        return pa.table(
            {
                "g": pa.array(g, pa.int64(), mask=~real.astype(bool)),
                "id": pa.array(ids, pa.int64()),
                "code": pa.array(codes.astype(np.int32)),
                "frequent": pa.array(often.astype(np.int32)),
            }
        )

    return blocks.groupBy("bucket").applyInArrow(meet, "g bigint, id bigint, code int, frequent int")


def memberships(met: DataFrame) -> DataFrame:
    """``g, id``: the groups' members, without the frequent groups that a class can do without."""
    had = met.where("g IS NULL").groupBy("id", "code").agg(F.sum("frequent").alias("n"))
    needs = had.where(F.col("n") > F.floor(F.col("code") / 2)).select("id", "code")
    rare = met.where("g IS NOT NULL AND frequent = 0").select("g", "id")
    kept = met.where("g IS NOT NULL AND frequent = 1").join(needs, ["id", "code"], "left_semi").select("g", "id")
    return rare.unionByName(kept).distinct()


def class_sets(ids: DataFrame, members: DataFrame, docs: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """``id, features`` (sorted little-endian uint64) of the classes in ``ids``, from one row of each."""
    one = ids.join(members, "id").groupBy("id").agg(F.min(F.struct("key", "tie")).alias("k"))
    rows = docs.select(plain(key).alias("key"), F.xxhash64(plain(text)).alias("tie"), plain(text).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in _sets(batches, 0, n):
            yield pa.record_batch(
                [pa.array([class_id(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())],
                names=["id", "features"],
            )

    chosen = join_small(rows, one.select("k.key", "k.tie"), ["key", "tie"]).select("text")
    return staged(chosen.mapInArrow(whole, "id bigint, features binary").dropDuplicates(["id"]), "features", WIDE)


def similar_rows(x: list[np.ndarray], y: list[np.ndarray], columns: int = 1 << 14) -> np.ndarray:
    """Which sets of x are similar enough to which of y, by products of 0/1
    matrices over ``columns`` features at a time."""
    shared = np.zeros((len(x), len(y)), np.float32)
    flat_x, flat_y = np.concatenate(x), np.concatenate(y)
    both = np.intersect1d(flat_x, flat_y)
    row_x, row_y = (np.repeat(np.arange(len(z)), [len(v) for v in z]) for z in (x, y))
    at_x, at_y = np.searchsorted(both, flat_x), np.searchsorted(both, flat_y)
    in_x, in_y = is_in(flat_x, both), is_in(flat_y, both)
    for low in range(0, len(both), columns):
        width = min(columns, len(both) - low)
        sides = []
        for z, row, at, inside in ((x, row_x, at_x, in_x), (y, row_y, at_y, in_y)):
            here = inside & (at >= low) & (at < low + width)
            side = np.zeros((len(z), width), np.float32)
            side[row[here], at[here] - low] = 1
            sides.append(side)
        shared += sides[0] @ sides[1].T
    sizes = np.add.outer([len(v) for v in x], [len(v) for v in y])
    return 100 * shared >= 75 * (sizes - shared)


def family_links(large: DataFrame, sets_of: Callable[[DataFrame], DataFrame], block: int = 256) -> DataFrame:
    """Links ``a, b`` between different components inside families.

    ``large``: ``g, id, label`` of the groups.  A family is what the groups
    connect; all its members are compared with those outside its largest
    component, in blocks of about ``block`` by ``block`` sets, so a task's
    size does not depend on the family's.
    """
    least = large.groupBy("g").agg(F.min("id").alias("a"))
    family = connected_components(large.join(least, "g").where("id <> a").select("a", F.col("id").alias("b")).distinct())
    own = staged(large.select("id", "label").distinct().join(family.withColumnRenamed("label", "family"), "id"), "family", NARROW)
    of_label = own.groupBy("family", "label").agg(F.count("*").alias("m"))
    shape = of_label.groupBy("family").agg(F.max(F.struct("m", "label")).alias("top"), F.sum("m").alias("m"))
    shape = shape.select(
        "family",
        F.col("top.label").alias("top"),
        F.ceil(F.col("m") / block).cast("int").alias("n_x"),
        F.ceil((F.col("m") - F.col("top.m")) / block).cast("int").alias("n_y"),
    ).where("n_y > 0")
    told = own.join(shape, "family").join(sets_of(own.select("id")), "id")

    def dealt(rows: DataFrame, mine: str, other: str) -> DataFrame:
        deal = F.pmod(F.xxhash64("id"), F.col(f"n_{mine}")).cast("int").alias(mine)
        every = F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)).alias(other)
        # names of its own, as both sides come from one table
        return rows.select("family", "id", "label", "features", deal, every).select(
            F.col("family").alias(f"family_{mine}"), "id", "label", "features", F.col("x").alias(f"x_{mine}"), F.col("y").alias(f"y_{mine}")
        )

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        close = similar_rows(*([np.frombuffer(v, "<u8") for v in side["features"]] for side in (left, right)))
        close &= np.not_equal.outer(left["label"].to_numpy(), right["label"].to_numpy())
        at_x, at_y = np.nonzero(close)
        a, b = left["id"].to_numpy()[at_x], right["id"].to_numpy()[at_y]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    x, y = dealt(told, "x", "y"), dealt(told.where("label <> top").toDF(*told.columns), "y", "x")
    blocks = x.groupBy("family_x", "x_x", "y_x").cogroup(y.groupBy("family_y", "x_y", "y_y"))
    return blocks.applyInPandas(compare, "a bigint, b bigint").distinct()


def similar_enough(shared: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 100 * shared >= 75 * (x + y - shared)


class ClassSets:
    """The whole sets of classes, each fetched from the documents once, when it is first needed."""

    def __init__(self, members: DataFrame, docs: DataFrame, n: int, key: str, text: str) -> None:
        self.source, self.tables = (members, docs, n, key, text), []

    def of(self, ids: DataFrame) -> DataFrame:
        """``id, features`` of (at least) the classes in ``ids``."""
        new = ids.distinct()
        for known in self.tables:
            new = new.join(known.select("id"), "id", "left_anti")
        new = staged(new, "wanted", NARROW)
        if not self.tables or not new.isEmpty():
            self.tables.append(class_sets(new, *self.source))
        return reduce(DataFrame.unionByName, self.tables)


def linked(pairs: DataFrame, shape: DataFrame, sets: ClassSets) -> DataFrame:
    """The pairs ``a, b`` (b: the pivot) of classes whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            sizes = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            keep = [may_link(cells, others, n, m) for cells, others, (n, m) in zip(x, y, sizes)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    beside = pairs
    for side in ("a", "b"):
        told = shape.select(F.col("id").alias(side), F.col("size").alias(f"size_{side}"), F.col("cells").alias(f"cells_{side}"))
        beside = beside.join(told, side)
    beside = beside.where(75 * F.greatest("size_a", "size_b") <= 100 * F.least("size_a", "size_b"))
    beside = beside.select("a", "b", "cells_a", "cells_b", "size_a", "size_b")
    return confirmed(staged(beside.mapInArrow(run, "a bigint, b bigint"), "pairs", WIDE), shape, sets)


def confirmed(maybe: DataFrame, shape: DataFrame, sets: ClassSets) -> DataFrame:
    own = sets.of(maybe.select(F.explode(F.array("a", "b")).alias("id")))
    return pivots.confirmed(maybe, shape, own, similar_enough)


def open_pairs(rows: DataFrame, bucket_rows: int = 20_000) -> DataFrame:
    """``a, b``: the pairs of different components inside the small groups ``g, id,
    label, size, cells`` that the sizes and cell counts do not rule out."""
    buckets = max(1, -(-rows.count() // bucket_rows))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("g")
        g, ids, label, size = (pivots.numbers(table, c) for c in ("g", "id", "label", "size"))
        cells, found = table["cells"].to_pylist(), set()
        for low, high in pivots.stretches(g):
            fit = np.triu(np.not_equal.outer(label[low:high], label[low:high]), 1)
            least, most = np.minimum.outer(size[low:high], size[low:high]), np.maximum.outer(size[low:high], size[low:high])
            for i, j in (np.argwhere(fit & (75 * most <= 100 * least)) + low).tolist():
                pair = (int(min(ids[i], ids[j])), int(max(ids[i], ids[j])))
                if pair not in found and may_link(cells[i], cells[j], int(size[i]), int(size[j])):
                    found.add(pair)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("g"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame,
    n: int = 5,
    key: str = "doc_id",
    text: str = "text",
    frequent: int = 16,
    sample_docs: int = 20_000,
    common_least: int = 64,
    common_most: int = 200_000,
    rounds: int = 4,
    fruitful: float = 1 / 16,
    bucket_signatures: int = 2_000_000,
) -> DataFrame:
    """``key, tie, size, label, component`` of every row: set size, the component's
    name and its smallest key (``tie`` is a hash of the text).

    ``frequent`` parts groups whose open pairs are listed from those compared in
    blocks.  ``rounds`` of pivots at most, as long as ``fruitful`` of the pairs
    are links.  Neither changes the result.
    """
    members = staged(document_sets(docs, n, key, text), "sets")
    shape = members.groupBy("id").agg(
        F.min("key").alias("key"),
        F.min("size").alias("size"),
        F.min("cells").alias("cells"),
        (F.min("proof") != F.max("proof")).alias("clash"),
    )
    shape = staged(shape, "classes", WIDE)
    totals = shape.agg(F.sum("size").alias("n"), F.coalesce(F.max("clash"), F.lit(False)).alias("clash")).first()
    if totals["clash"]:
        raise ValueError("two different sets have the same 64-bit class id")
    buckets = max(1, -(-int(1.5 * (totals["n"] or 0)) // bucket_signatures))
    common = common_signatures(docs, n, text, sample_docs, common_least, common_most)
    met = staged(groups(docs, n, text, common, buckets, frequent), "groups")
    met = pivots.merged_groups(staged(memberships(met), "groups", WIDE))
    sets = ClassSets(members, docs, n, key, text)
    tested = docs.sparkSession.createDataFrame([], "a bigint, b bigint")
    labels = docs.sparkSession.createDataFrame([], "id bigint, label bigint")
    named = None
    for _ in range(rounds):
        pairs, now_named = pivots.pivot_pairs(met, labels, named)
        tried = pairs.count()
        if not tried:
            break
        found = linked(pairs, shape, sets)
        tested = tested.unionByName(pairs)
        many = found.count()
        if many:
            labels = extended(labels, found)
        named = now_named if named is None else named.unionByName(now_named)
        if many < fruitful * tried:
            break
    now = pivots.labelled(met.select("g", "id", "n"), labels)
    left = staged(now.join(pivots.open_groups(now), "g", "left_semi"), "unresolved", WIDE)
    # small groups: their members in different components, not yet compared
    small = left.where(F.col("n") <= frequent).select("g", "id", "label").join(shape.select("id", "size", "cells"), "id")
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = staged(open_pairs(small).join(done, ["a", "b"], "left_anti"), "pairs", WIDE)
    more = confirmed(rest, shape, sets)
    # large ones: whole families, in blocks
    large = left.where(F.col("n") > frequent).select("g", "id", "label")
    if not large.isEmpty():
        more = more.unionByName(family_links(large, lambda ids: sets.of(ids).join(ids.distinct(), "id", "left_semi")))
    more = staged(more, "links", NARROW)
    labels = extended(labels, more) if not more.isEmpty() else labels
    classes = shape.select("id", "key").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    of_label = classes.groupBy("label").agg(F.min("key").alias("component"))
    of_class = classes.select("id", "label").join(of_label, "label").select("id", "label", "component")
    return members.join(of_class, "id").select(
        F.col("key").alias(key),
        "tie",
        "size",
        "label",
        F.when(F.col("size") == 0, F.col("key")).otherwise(F.col("component")).alias("component"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings: int) -> DataFrame:
    """The rows, all columns, of one document of each component: its smallest
    key (of rows with that key, the one whose text has the smallest hash).
    Documents without words all stay; rows equal in key and text stay together."""
    columns = docs.columns
    found = near_duplicates(docs, key=key, text=text, **settings).withColumnRenamed(key, "_key")
    order = F.struct(F.col("_key").isNull().alias("null"), F.col("_key").alias("key"), F.col("tie").alias("tie"))
    first = found.where("size > 0").groupBy("label").agg(F.min(order).alias("k")).select("k.key", "k.tie")
    first = first.unionByName(found.where("size = 0").select(F.col("_key").alias("key"), "tie"))
    # by position, so that no column of the caller's meets one of ours
    numbered = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    own_key, own_text = (F.col(f"c{columns.index(c)}") for c in (key, text))
    kept = numbered.join(first, own_key.eqNullSafe(F.col("key")) & (F.xxhash64(own_text) == F.col("tie")), "left_semi")
    return kept.toDF(*columns)
