"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document's set is its distinct word n-grams (64-bit hashes); documents with
equal sets are one class.  Two permutations of a 32-bit feature domain give
all coordinates of a signature: ``sigma`` scrambles the set once, and
coordinate k is the least value of ``pi`` on the scrambled set shifted
circularly by k.  ``bands`` bands of ``rows`` coordinates each are hashed, and
classes that share a band's hash form a group.  At the threshold of 80 % and
40 bands of 6 a linked pair shares no band with probability 5e-6.

Groups are not expanded into pairs.  Groups with equal members are merged and
counted.  In a round every group that is still open (members in different
components) names the member with the most shared bands of those it has not
named yet, and every class is compared with the one such pivot that it shares
most bands with: one pair a class.  Links are contracted to components.  What
is open after the rounds is compared in blocks of a bounded number of members,
by one byte a coordinate: a pair whose agreement is 6.5 standard deviations
under the threshold's is no link (about 1e-10 of the links).  The pairs that
remain are compared on their full sets: pair by pair, or, in a block where
many remain, by products of 0/1 matrices, and then only links that join
components leave the block.  So every link that shares a band is found, and
every link was confirmed on the full sets.

A pivot's set is sent to as many tasks as its partners need, a large group is
dealt into blocks, and buckets of small groups hold a bounded number of rows.

Edge cases: a null or empty text has an empty set and is linked with nothing;
with fewer than n words the whole sequence is the only feature; texts of any
length are hashed whole, in slices; repeated rows fall into one class, and
rows that tie are all reported; a component without any key has a null id;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import SLICE_BYTES, join_small, mix64, plain, shingle_sets, slices, staged, text_bytes, text_sizes, words
from riskweave.llm import pivots
from riskweave.llm.components import extended
from riskweave.llm.pivots import merged_groups, numbers, stretches

#: Members that are compared with each other at once.
BLOCK = 512
#: Rows of small groups in one task's bucket.
BUCKET_ROWS = 20_000
#: Surviving pairs a member at which a block is compared as a whole.
DENSE = 8
#: Rounds of pivots, and the share of links among the compared pairs below which they end.
ROUNDS, FRUITFUL = 4, 1 / 16


@dataclass(frozen=True)
class Scheme:
    n: int = 4
    percent: int = 80
    bands: int = 40
    rows: int = 6

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> int:
        """Equal coordinates that no link has fewer of, but for 6.5 standard deviations."""
        p, k = self.percent / 100, self.coordinates
        return max(0, int(p * k - 6.5 * (p * (1 - p) * k) ** 0.5))

    def linked(self, shared: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return 100 * shared >= self.percent * (x + y - shared)

    def sizes_allow(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(x, y) >= self.percent * np.maximum(x, y)


def sigma(features: np.ndarray) -> np.ndarray:
    """Features in scrambled order on the 32-bit domain."""
    return (mix64(features ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


def pi(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit domain (every step is invertible); works in place."""
    y = x >> np.uint32(16)
    x ^= y
    x *= np.uint32(0x21F0AAAD)
    np.right_shift(x, np.uint32(15), out=y)
    x ^= y
    x *= np.uint32(0x735A2D97)
    np.right_shift(x, np.uint32(15), out=y)
    x ^= y
    return x


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of coordinates for each (non-empty) set."""
    out = np.empty((len(sets), coordinates), np.uint32)
    if not sets:
        return out
    size = np.array([len(x) for x in sets], np.int64)
    start = np.cumsum(size) - size
    scrambled = sigma(np.concatenate(sets))
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(pi(scrambled + np.uint32(k)), start)  # addition wraps: the circular shift
    return out


def band_hashes(signature: np.ndarray, scheme: Scheme) -> np.ndarray:
    """A 64-bit hash a band, different for each band's number."""
    part = signature.reshape(len(signature), scheme.bands, scheme.rows).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, scheme.bands + 1, dtype=np.uint64), part.shape[:2]).copy()
    for k in range(scheme.rows):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + part[:, :, k])
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def set_id(features: np.ndarray) -> int:
    return _signed(xxhash.xxh3_64_intdigest(features.tobytes()))


def _sets(batches: Iterator[pa.RecordBatch], column: int, n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for i, j in slices(text_sizes(batch.column(column)), SLICE_BYTES):
            part = batch.slice(i, j - i)
            yield part, shingle_sets(*words(*text_bytes(part.column(column)), lower=True), n)


def document_signatures(docs: DataFrame, scheme: Scheme, key: str, text: str) -> DataFrame:
    """``key, tie, id, proof, size, bands, sketch`` of every row: ``id`` names its
    class, ``proof`` is a second digest of the set, ``sketch`` one byte a coordinate."""
    rows = docs.select(plain(key).alias("key"), F.xxhash64(plain(text)).alias("tie"), plain(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, 2, scheme.n):
            at = [i for i, x in enumerate(sets) if len(x)]
            signature = signatures([sets[i] for i in at], scheme.coordinates)
            bands: list[list[int]] = [[] for _ in sets]
            sketch = [b""] * len(sets)
            low = signature.astype(np.uint8)
            for i, own, said in zip(at, band_hashes(signature, scheme).view(np.int64), low):
                bands[i], sketch[i] = own, said.tobytes()
            yield pa.record_batch(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([set_id(x) for x in sets], pa.int64()),
                    pa.array([_signed(xxhash.xxh64_intdigest(x.tobytes(), 1)) for x in sets], pa.int64()),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketch, pa.binary()),
                ],
                names=["key", "tie", "id", "proof", "size", "bands", "sketch"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, tie bigint, id bigint, proof bigint, size bigint, bands array<bigint>, sketch binary")


def band_groups(classes: DataFrame) -> DataFrame:
    """The groups of classes that share a band (see ``merged_groups``)."""
    return merged_groups(classes.select(F.explode("bands").alias("g"), "id"))


def whole_sets(met: DataFrame, members: DataFrame, docs: DataFrame, scheme: Scheme, key: str, text: str) -> DataFrame:
    """``id, features`` (sorted little-endian uint64) of the classes that met, from one row of each."""
    one = members.join(met.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min(F.struct("key", "tie")).alias("k"))
    rows = docs.select(plain(key).alias("key"), F.xxhash64(plain(text)).alias("tie"), plain(text).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in _sets(batches, 0, scheme.n):
            yield pa.record_batch(
                [pa.array([set_id(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], names=["id", "features"]
            )

    chosen = join_small(rows, one.select("k.key", "k.tie"), ["key", "tie"]).select("text")
    return staged(chosen.mapInArrow(whole, "id bigint, features binary").dropDuplicates(["id"]), "minhash-sets")


def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """The links among the pairs ``a, b`` (b: the pivot), by their full sets."""
    cut, least = scheme.sizes_allow, scheme.least_agreement

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (4, 5))
            keep = (x == y).sum(axis=1) >= least
            keep &= cut(batch.column(2).to_numpy(), batch.column(3).to_numpy())
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    beside = pairs
    for side in ("a", "b"):
        beside = beside.join(classes.select(F.col("id").alias(side), F.col("size").alias(f"size_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)
    beside = beside.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b")
    maybe = staged(beside.mapInArrow(run, "a bigint, b bigint"), "minhash-pairs")
    return pivots.confirmed(maybe, classes, sets, scheme.linked)


def block_rows(open_rows: DataFrame) -> DataFrame:
    """``bucket, g, x, y, side, id, label, size, sketch``: each open group's members, in every
    pair of blocks that they belong to."""
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = open_rows.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = other.select(
        "g", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).alias("side"),
        "id", "label", "size", "sketch", "parts",
    )
    buckets = max(1, -(-open_rows.count() // BUCKET_ROWS))
    place = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("g"), F.lit(buckets))).otherwise(F.xxhash64("g", "x", "y"))
    return rows.withColumn("bucket", place).drop("parts")


def open_pairs(open_rows: DataFrame, scheme: Scheme) -> DataFrame:
    """``a, b`` of the pairs in different components that may be linked; ``a``
    null: a dense block ``b, x, y`` (``b``: its group), to be compared as a whole."""
    least = scheme.least_agreement

    def survive(table: pa.Table) -> pa.Table:
        table = table.sort_by([("g", "ascending"), ("x", "ascending"), ("y", "ascending"), ("side", "ascending")])
        g, x, y, ids, label, size = (numbers(table, c) for c in ("g", "x", "y", "id", "label", "size"))
        side = table["side"].to_numpy().astype(bool)
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(len(g), -1)
        pairs, dense = [], []
        for low, high in stretches(g, x, y):
            one = x[low] == y[low]
            cut = high if one else low + int((~side[low:high]).sum())
            left, right = slice(low, cut), slice(low, high) if one else slice(cut, high)
            here = []
            for i in range(left.start, left.stop, 32):
                rows = slice(i, min(i + 32, left.stop))
                fit = np.not_equal.outer(label[rows], label[right]) & scheme.sizes_allow(size[rows, None], size[None, right])
                if one:
                    fit &= ids[rows, None] < ids[None, right]
                at, beside = np.nonzero(fit)
                agree = np.zeros(len(at), bool)
                for k in range(0, len(at), 1 << 14):
                    part = slice(k, k + (1 << 14))
                    agree[part] = (sketch[rows][at[part]] == sketch[right][beside[part]]).sum(axis=1) >= least
                here.append(np.stack([ids[rows][at[agree]], ids[right][beside[agree]]]))
            found = np.concatenate(here, axis=1) if here else np.zeros((2, 0), np.int64)
            if found.shape[1] > DENSE * (high - low):
                dense.append((g[low], x[low], y[low]))
            else:
                pairs.append(found)
        found = np.unique(np.concatenate(pairs, axis=1), axis=1) if pairs else np.zeros((2, 0), np.int64)
        a = [*np.minimum(*found).tolist(), *[None] * len(dense)]
        b = [*np.maximum(*found).tolist(), *[int(d[0]) for d in dense]]
        none = [None] * found.shape[1]
        return pa.table({
            "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
            "x": pa.array([*none, *[int(d[1]) for d in dense]], pa.int32()), "y": pa.array([*none, *[int(d[2]) for d in dense]], pa.int32()),
        })

    return staged(block_rows(open_rows).groupBy("bucket").applyInArrow(survive, "a bigint, b bigint, x int, y int"), "minhash-open")


def shared_counts(x: list[np.ndarray], y: list[np.ndarray], columns: int = 1 << 14) -> np.ndarray:
    """Sizes of the intersections of all sets of x and y, by products of 0/1 matrices."""
    shared = np.zeros((len(x), len(y)), np.float32)
    flat_x, flat_y = np.concatenate(x), np.concatenate(y)
    both = np.intersect1d(flat_x, flat_y)
    if not len(both):
        return shared
    told = []
    for z, flat in ((x, flat_x), (y, flat_y)):
        at = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        hit = both[at] == flat
        told.append((np.repeat(np.arange(len(z)), [len(v) for v in z])[hit], at[hit]))
    for low in range(0, len(both), columns):
        sides = []
        for z, (row, at) in zip((x, y), told):
            here = (at >= low) & (at < low + columns)
            side = np.zeros((len(z), min(columns, len(both) - low)), np.float32)
            side[row[here], at[here] - low] = 1
            sides.append(side)
        shared += sides[0] @ sides[1].T
    return shared


def dense_links(blocks: DataFrame, rows: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """Links ``a, b`` that join components, of the dense blocks ``g, x, y``."""
    mine = rows.drop("sketch", "bucket").join(blocks, ["g", "x", "y"], "left_semi").join(sets, "id")

    def compare(table: pa.Table) -> pa.Table:
        ids, label, size = (numbers(table, c) for c in ("id", "label", "size"))
        side = table["side"].to_numpy().astype(bool)
        own = [np.frombuffer(f, "<u8") for f in table["features"].to_pylist()]
        one = table["x"][0].as_py() == table["y"][0].as_py()
        left = np.arange(len(ids)) if one else np.flatnonzero(~side)
        right = left if one else np.flatnonzero(side)
        root = {v: v for v in label.tolist()}

        def find(v: int) -> int:
            while root[v] != v:
                root[v] = root[root[v]]
                v = root[v]
            return v

        out = []
        if len(left) and len(right):
            close = scheme.linked(shared_counts([own[i] for i in left], [own[i] for i in right]), size[left, None], size[None, right])
            for i, j in np.argwhere(close & np.not_equal.outer(label[left], label[right])).tolist():
                a, b = find(int(label[left[i]])), find(int(label[right[j]]))
                if a != b:
                    root[a] = b
                    out.append((int(ids[left[i]]), int(ids[right[j]])))
        return pa.table({"a": pa.array([p for p, _ in out], pa.int64()), "b": pa.array([q for _, q in out], pa.int64())})

    return staged(mine.groupBy("g", "x", "y").applyInArrow(compare, "a bigint, b bigint"), "minhash-links")


def near_duplicates(docs: DataFrame, scheme: Scheme = Scheme(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, tie, size, label, component`` of every row: set size, the component's
    name and its smallest key (``tie`` is a hash of the text)."""
    members = staged(document_signatures(docs, scheme, key, text), "minhash-members")
    classes = members.groupBy("id").agg(
        F.min("key").alias("key"),
        F.min("size").alias("size"),
        (F.min("proof") != F.max("proof")).alias("clash"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )
    classes = staged(classes, "minhash-classes")
    if classes.agg(F.max("clash")).first()[0]:
        raise ValueError("two different sets have the same 64-bit class id")
    members, told = members.select("key", "tie", "id", "size"), classes.select("id", "size", "sketch")
    met = band_groups(classes)
    sets = whole_sets(met, members, docs, scheme, key, text)
    tested = docs.sparkSession.createDataFrame([], "a bigint, b bigint")
    labels = docs.sparkSession.createDataFrame([], "id bigint, label bigint")
    named = None
    for _ in range(ROUNDS):
        pairs, now_named = pivots.pivot_pairs(met, labels, named)
        tried = pairs.count()
        if not tried:
            break
        found = confirmed(pairs, told, sets, scheme)
        n = found.count()
        if n:
            labels = extended(labels, found)
        named = now_named if named is None else named.unionByName(now_named)
        tested = tested.unionByName(pairs)
        if n < FRUITFUL * tried:
            break
    now = pivots.labelled(met.select("g", "id", "n"), labels)
    left = staged(now.join(pivots.open_groups(now), "g", "left_semi").join(told, "id"), "minhash-open")
    if not left.isEmpty():
        rest = open_pairs(left, scheme)
        pairs = rest.where("a IS NOT NULL").select("a", "b").distinct()
        done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        more = confirmed(staged(pairs.join(done, ["a", "b"], "left_anti"), "minhash-pairs"), told, sets, scheme)
        dense = rest.where("a IS NULL").select(F.col("b").alias("g"), "x", "y")
        if not dense.isEmpty():
            more = more.unionByName(dense_links(dense, block_rows(left), sets, scheme))
        if not more.isEmpty():
            labels = extended(labels, more)
    own = classes.select("id", "key").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    of_label = own.groupBy("label").agg(F.min("key").alias("component"))
    of_class = own.select("id", "label").join(of_label, "label")
    return members.join(of_class, "id").select(
        F.col("key").alias(key), "tie", "size", "label", F.when(F.col("size") == 0, F.col("key")).otherwise(F.col("component")).alias("component")
    )
