"""Merkle manifest of a dataset as a persistent path-copying tree.

Every row has a digest; per group the rows ascend by their key and are the
leaves of a binary tree (two consecutive nodes become the digest of their hex
texts, the last one alone if the count is odd), and the groups' subroots, in
group order, are the leaves of one more tree.  Digests are kept as 32 bytes.

The tree is cut into aligned blocks of ``2 ** block_levels`` nodes: one block
with all its levels is one stored row, and the blocks' tops are the next
stage's nodes, so a task holds one block whatever the table's size.

A row whose digest differs on delivery (``now``) is a version of the tree.  It
copies only the leaf's ancestors and shares every other node with the stored
tree: first the ancestors inside its block, then its block's top continues as
a changed node of the next stage, up to the root.  All versions meet in the
upper blocks, so a block is handed to as many tasks as its versions need.
Proofs go the other way: each stage's blocks pass the siblings above them down
to the next one, and only the leaves' blocks meet their rows.

Edge cases: null and empty values are told apart by the digest (``row_digest``);
a text of any length is one digest, made by Spark; the null group and null keys
come first; rows equal in group and key follow each other by their digest, and
rows equal in that too have equal leaves; a lone row is its group's subroot, a
lone group's subroot is the root, and a proof without siblings is the digest of
the empty text; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from binascii import hexlify
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from riskweave.llm.common import join_small, staged

SIZE = 32  # bytes of a digest


def row_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as ``-`` if null, else byte count, ``:``, text."""
    parts = []
    for v in values:
        said = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    return (n - 1).bit_length() if n > 1 else 0


def climb(leaves: bytes, levels: int) -> list[bytes]:
    """The digests of a block, level by level."""
    out = [leaves]
    for _ in range(levels):
        said = hexlify(out[-1])
        out.append(b"".join(sha256(said[i : i + 4 * SIZE]).digest() for i in range(0, len(said), 4 * SIZE)))
    return out


def unpack(nodes: bytes, leaves: int, levels: int) -> list[bytes]:
    out, at = [], 0
    for _ in range(levels + 1):
        out.append(nodes[at : at + SIZE * leaves])
        at, leaves = at + SIZE * leaves, -(-leaves // 2)
    return out


def copied_path(tree: list[bytes], at: int, changed: bytes) -> bytes:
    """The new ancestors of a changed leaf; every other node stays the tree's."""
    path, now = [], changed
    for level in tree[:-1]:
        beside = level[SIZE * (at ^ 1) : SIZE * (at ^ 1) + SIZE]
        pair = now + beside if at % 2 == 0 else beside + now
        now = sha256(hexlify(pair)).digest()
        path.append(now)
        at //= 2
    return b"".join(path)


def siblings(tree: list[bytes], at: int) -> bytes:
    """The hex texts of the siblings from a leaf to its block's top."""
    out = []
    for level in tree[:-1]:
        out.append(level[SIZE * (at ^ 1) : SIZE * (at ^ 1) + SIZE])
        at //= 2
    return hexlify(b"".join(out))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``pos``, their place in the group by ``order``, and ``n``, its size.

    A range shuffle, then a running number in each task; only a count per
    task and group goes through a window.
    """
    names = rows.columns
    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    at = names.index(group)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, n = TaskContext.get().partitionId(), None, -1
        for batch in batches:
            place = np.empty(batch.num_rows, np.int64)
            for i, g in enumerate(batch.column(at).to_pylist()):
                n = n + 1 if n >= 0 and g == last else 0
                last, place[i] = g, n
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(place)]
            yield pa.record_batch(columns, names=[*names, "part", "place"])

    schema = StructType([*ordered.schema.fields, StructField("part", IntegerType()), StructField("place", LongType())])
    placed = staged(ordered.mapInArrow(number, schema), "merkle-placed")
    counts = placed.groupBy("part", group).agg((F.max("place") + 1).alias("here"))
    before = F.sum("here").over(Window.partitionBy(group).orderBy("part")) - F.col("here")  # a row a task
    sized = counts.select("part", group, before.alias("before"), F.sum("here").over(Window.partitionBy(group)).alias("n"))
    out = join_small(placed, sized, ["part", group])
    return out.select(*names, (F.col("before") + F.col("place")).alias("pos"), "n")


BLOCK_SCHEMA = "g bigint, block bigint, n bigint, leaves int, levels int, nodes binary"


def blocks_of(nodes: DataFrame, block_levels: int, keys: str | None = None) -> DataFrame:
    """One row a block of the nodes ``g, pos, n, digest``: all its levels (and its leaves' keys)."""

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos").combine_chunks()
        n, first = rows["n"][0].as_py(), rows["pos"][0].as_py()
        levels = min(block_levels, height(n))
        tree = b"".join(climb(b"".join(rows["digest"].to_pylist()), levels))
        made = [
            pa.array([x], t)
            for x, t in (
                (rows["g"][0].as_py(), pa.int64()), (first >> block_levels, pa.int64()), (n, pa.int64()),
                (rows.num_rows, pa.int32()), (levels, pa.int32()), (tree, pa.binary()),
            )
        ]
        names = ["g", "block", "n", "leaves", "levels", "nodes"]
        if keys:
            own = rows["key"].combine_chunks()
            made.append(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own))
            names.append("keys")
        return pa.table(made, names=names)

    schema = BLOCK_SCHEMA + (f", keys array<{keys}>" if keys else "")
    cut = nodes.select("g", F.shiftright("pos", block_levels).alias("block"), "pos", "n", "digest", *(["key"] if keys else []))
    return staged(cut.groupBy("g", "block").applyInArrow(build, schema), "merkle-blocks")


def _tops(blocks: DataFrame, block_levels: int) -> DataFrame:
    """The blocks' tops as the next stage's nodes."""
    n = F.shiftright(F.col("n") + ((1 << block_levels) - 1), block_levels)
    return blocks.select("g", F.col("block").alias("pos"), n.alias("n"), F.substring("nodes", -SIZE, SIZE).alias("digest"))


def continued(versions: DataFrame, blocks: DataFrame, block_levels: int, task_versions: int) -> DataFrame:
    """The versions ``vg, vpos, g, pos, digest`` one stage up, with the ``path`` each copied."""
    cut = versions.withColumn("block", F.shiftright("pos", block_levels))
    need = cut.groupBy("g", "block").agg(F.ceil(F.count("*") / task_versions).cast("int").alias("shares"))
    need = need.select(F.col("g").alias("_g"), F.col("block").alias("_block"), "shares")
    # as many copies of a block as its versions have shares; a share's number is dealt by the version's own hash
    shared = blocks.select(*[F.col(c) for c in ("g", "block", "leaves", "levels", "nodes")]).join(
        need, (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_block"))
    )
    copies = shared.select("g", "block", "leaves", "levels", "nodes", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    mine = cut.join(need, (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_block")))
    mine = mine.select("vg", "vpos", "g", "block", "pos", "digest", F.pmod(F.xxhash64("vg", "vpos"), "shares").cast("int").alias("share"))

    def copy(own: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("vg", "vpos", "g", "pos", "digest", "path")}
        if len(own) and len(block):
            b = block.iloc[0]
            tree = unpack(b["nodes"], int(b["leaves"]), int(b["levels"]))
            first = int(b["block"]) << block_levels
            for vg, vpos, pos, digest in zip(own["vg"], own["vpos"], own["pos"], own["digest"]):
                path = copied_path(tree, int(pos) - first, digest)
                for c, x in zip(out, (vg, vpos, b["g"], b["block"], path[-SIZE:] or digest, path)):
                    out[c].append(x)
        return pd.DataFrame(out)

    dealt = mine.groupBy("g", "block", "share").cogroup(copies.groupBy("g", "block", "share"))
    return staged(
        dealt.applyInPandas(copy, "vg bigint, vpos bigint, g bigint, pos bigint, digest binary, path binary"), "merkle-versions"
    )


def above(blocks: DataFrame, higher: DataFrame | None, block_levels: int) -> DataFrame:
    """``g, pos, above`` of a stage's nodes: the hex texts of all siblings up to
    the root, from those above its blocks (``higher``; none at the top)."""
    if higher is None:
        told = blocks.select("g", "block", "leaves", "levels", "nodes", F.lit(b"").alias("over"))
    else:
        over = higher.select(F.col("g").alias("_g"), F.col("pos").alias("_pos"), F.col("above").alias("over"))
        told = blocks.select("g", "block", "leaves", "levels", "nodes").join(
            over, (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_pos"))
        ).drop("_g", "_pos")

    def pass_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                tree = unpack(r["nodes"], r["leaves"], r["levels"])
                first = r["block"] << block_levels
                yield pa.record_batch(
                    [
                        pa.array([r["g"]] * r["leaves"], pa.int64()),
                        pa.array(range(first, first + r["leaves"]), pa.int64()),
                        pa.array([siblings(tree, i) + r["over"] for i in range(r["leaves"])], pa.binary()),
                    ],
                    names=["g", "pos", "above"],
                )

    return told.mapInArrow(pass_down, "g bigint, pos bigint, above binary")


def leaf_proofs(blocks: DataFrame, higher: DataFrame, block_levels: int, kind: str) -> DataFrame:
    """``g, pos, key, leaf, proof`` of every row, block by block."""
    over = higher.select(F.col("g").alias("_g"), F.col("pos").alias("_pos"), F.col("above").alias("over"))
    told = blocks.join(over, (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_pos")))
    told = told.select("g", "block", "leaves", "levels", "nodes", "over", "keys")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(6)
            for i, r in enumerate(batch.drop_columns(["keys"]).to_pylist()):
                tree = unpack(r["nodes"], r["leaves"], r["levels"])
                first, end = r["block"] << block_levels, SIZE * r["leaves"]
                yield pa.record_batch(
                    [
                        pa.array([r["g"]] * r["leaves"], pa.int64()),
                        pa.array(range(first, first + r["leaves"]), pa.int64()),
                        keys[i].values,
                        pa.array([tree[0][k : k + SIZE] for k in range(0, end, SIZE)], pa.binary()),
                        pa.array([sha256(siblings(tree, k) + r["over"]).digest() for k in range(r["leaves"])], pa.binary()),
                    ],
                    names=["g", "pos", "key", "leaf", "proof"],
                )

    return told.mapInArrow(prove, f"g bigint, pos bigint, key {kind}, leaf binary, proof binary")


@dataclass
class Manifest:
    """The stored tree: ``group_stages`` and ``root_stages`` are block tables
    from the leaves up, ``groups`` is ``grp, g, subroot, root``, ``changed``
    the delivered digests that differ (``g, pos, digest``)."""

    groups: DataFrame
    group_stages: list[DataFrame]
    root_stages: list[DataFrame]
    changed: DataFrame
    block_levels: int
    key_type: str
    task_versions: int

    def versions(self) -> tuple[DataFrame, list[DataFrame]]:
        """``vg, vpos, root`` of every version (its row's group number and
        place), and the tables of the nodes it copied, stage by stage."""
        now = self.changed.select(F.col("g").alias("vg"), F.col("pos").alias("vpos"), "g", "pos", "digest")
        copied = []
        for blocks in self.group_stages:
            now = continued(now, blocks, self.block_levels, self.task_versions)
            copied.append(now)
        now = now.select("vg", "vpos", F.lit(0).cast("bigint").alias("g"), F.col("vg").alias("pos"), "digest")
        for blocks in self.root_stages:
            now = continued(now, blocks, self.block_levels, self.task_versions)
            copied.append(now)
        return now.select("vg", "vpos", F.col("digest").alias("root")), copied

    def proofs(self) -> DataFrame:
        """Per row: ``key, leaf, subroot, root, proof, folded_root, verified``; a
        row delivered as stored shares the whole tree, so it folds to the root."""
        higher = None
        for blocks in reversed(self.root_stages):
            higher = above(blocks, higher, self.block_levels)
        # a group's place in the root tree is its number, and a group tree's top is at 0
        higher = higher.select(F.col("pos").alias("g"), F.lit(0).cast("bigint").alias("pos"), "above")
        for blocks in reversed(self.group_stages[1:]):
            higher = above(blocks, higher, self.block_levels)
        told = leaf_proofs(self.group_stages[0], staged(higher, "merkle-above"), self.block_levels, self.key_type)
        folded = self.versions()[0].select(F.col("vg").alias("g"), F.col("vpos").alias("pos"), F.col("root").alias("folded"))
        told = told.join(folded, ["g", "pos"], "left")
        told = join_small(told, self.groups.select("g", "subroot", "root"), ["g"])
        end = F.coalesce("folded", "root")
        return told.select("key", "leaf", "subroot", "root", "proof", end.alias("folded_root"), (end == F.col("root")).alias("verified"))


def _stages(nodes: DataFrame, block_levels: int, keys: str | None = None) -> list[DataFrame]:
    """Block tables until one block covers the largest tree."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    stages = [blocks_of(nodes, block_levels, keys)]
    while largest > 1 << block_levels:
        largest = -(-largest // (1 << block_levels))
        stages.append(blocks_of(_tops(stages[-1], block_levels), block_levels))
    return stages


def build(
    docs: DataFrame,
    group: Column,
    key: Column,
    digest: Column,
    now: Column | None = None,
    block_levels: int = 10,
    task_versions: int = 16384,
) -> Manifest:
    """The manifest of the rows: ``digest`` as stored, ``now`` as delivered (see ``row_digest``)."""
    rows = docs.select(group.alias("grp"), key.alias("key"), digest.alias("digest"), (digest if now is None else now).alias("now"))
    rows = staged(rows.withColumn("now", F.when(F.col("now") != F.col("digest"), F.col("now"))), "merkle-leaves")
    kind = rows.schema["key"].dataType.simpleString()
    names = rows.select("grp").distinct().withColumn("one", F.lit(0).cast("bigint"))
    names = staged(numbered(names, "one", ["grp"]).select("grp", F.col("pos").alias("g"), F.col("n").alias("m")), "merkle-groups")
    own = join_small(rows, names.select("grp", "g"), ["grp"]).select("g", "key", "digest", "now")
    leaves = staged(numbered(own, "g", ["key", "digest"]), "merkle-leaves")
    group_stages = _stages(leaves.drop("now"), block_levels, kind)
    subroots = _tops(group_stages[-1], block_levels).select("g", F.col("digest").alias("subroot"))
    groups = staged(names.join(subroots, "g"), "merkle-groups")
    tops = groups.select(F.lit(0).cast("bigint").alias("g"), F.col("g").alias("pos"), F.col("m").alias("n"), F.col("subroot").alias("digest"))
    root_stages = _stages(tops, block_levels)
    root = _tops(root_stages[-1], block_levels).first()  # one digest
    changed = leaves.where("now IS NOT NULL").select("g", "pos", F.col("now").alias("digest"))
    groups = groups.withColumn("root", F.lit(bytes(root["digest"]) if root else None).cast("binary"))
    return Manifest(groups, group_stages, root_stages, changed, block_levels, kind, task_versions)
