"""Exact top-k by inner product: ball-tree branch and bound per shard.

Vectors are integers, floor(scale * x).  Rows are dealt by a hash into shards
of about ``shard_rows``; a task builds a ball tree over one shard (nodes with
centre, radius and a row range) and searches it for a block of queries.  For
a query q a node's inner products are at most q.c + |q| r.  Nodes are opened
by that bound, largest first, and none whose bound is under the current kth
score.  The kth score is shared between shards: each query first searches
its own shard, and the kth score found there is every other shard's starting
threshold.  Scores are exact integers; bounds are widened by their rounding.

Queries meet shards in blocks of ``block_queries``, so neither side of a task
grows with the input; a shard returns at most k rows a query.

Edge cases: vectors that are null, or hold null or non-finite components,
take no part; a query meets vectors of its own length only; rows with the
same vec_id are rows each, and only the query's own row is left out; a query
or candidate without an id is a candidate only, last in ties; scores beyond
64 bits raise; a vector of any length is one row of a shard; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import plain, staged

LEAF_ROWS = 128
_LAST = 2**63 - 1


class BallTree:
    def __init__(self, rows: np.ndarray) -> None:
        self.order = np.arange(len(rows))
        self.rows = rows
        self.low: list[int] = []
        self.high: list[int] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        stack = [(0, len(rows), -1, 0)]
        while stack:
            low, high, parent, side = stack.pop()
            node = len(self.low)
            if parent >= 0:
                pair = self.children[parent] or (0, 0)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            own = rows[self.order[low:high]].astype(float)
            centre = own.mean(axis=0)
            radii.append(float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())))
            centres.append(centre)
            self.low.append(low)
            self.high.append(high)
            self.children.append(None)
            if high - low > LEAF_ROWS and radii[-1] > 0:
                # two far points; each row goes to the side that its projection on their line gives
                far = own[int(((own - centre) ** 2).sum(axis=1).argmax())]
                other = own[int(((own - far) ** 2).sum(axis=1).argmax())]
                middle = (high - low) // 2
                self.order[low:high] = self.order[low:high][np.argpartition(own @ (other - far), middle)]
                stack += [(low, low + middle, node, 0), (low + middle, high, node, 1)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.sorted = rows[self.order]

    def search(self, query: np.ndarray, ids: np.ndarray, uids: np.ndarray, own: int, k: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, scores) of the k best, ties to the smaller id; none
        with a score under ``threshold`` is looked for."""
        q = query.astype(float)
        size = float(np.sqrt(q @ q))
        middle, reach = self.centres @ q, self.radii * size
        bound = middle + reach + 1e-9 * (np.abs(middle) + reach) + 1e-3
        heap = [(-bound[0], 0)]
        best, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while heap:
            upper, node = heapq.heappop(heap)
            if -upper < threshold:
                break
            if (pair := self.children[node]) is not None:
                for child in pair:
                    if bound[child] >= threshold:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            at = self.order[self.low[node] : self.high[node]]
            found = self.sorted[self.low[node] : self.high[node]] @ query
            hit = (found >= threshold) & (uids[at] != own)
            best, scores = np.concatenate([best, at[hit]]), np.concatenate([scores, found[hit]])
            if len(best) > k:
                top = np.lexsort((uids[best], ids[best], -scores))[:k]
                best, scores = best[top], scores[top]
            if len(best) == k:
                threshold = max(threshold, float(scores.min()))
        return best, scores


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(x, "<i8") for x in column]) if len(column) else np.zeros((0, 0), np.int64)


def integer_vectors(vectors: DataFrame, scale: int, id_column: str, vector: str) -> DataFrame:
    """``uid, id, dim, bytes`` (little-endian int64) of the rows that take part."""
    usable = plain(vector).isNotNull() & F.forall(
        plain(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    whole = F.transform(plain(vector), lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(plain(id_column).cast("bigint").alias("id"), whole.alias("v"))

    @F.pandas_udf("binary")
    def packed(column: pd.Series) -> pd.Series:
        return column.map(lambda x: np.asarray(x, "<i8").tobytes())

    return rows.select(F.monotonically_increasing_id().alias("uid"), "id", F.size("v").alias("dim"), packed("v").alias("bytes"))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    shard_rows: int = 16384,
    block_queries: int = 8192,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, <id_column>, score`` of the queries (rows where
    ``is_query``, a condition on column ``id``) against all rows."""
    rows = staged(integer_vectors(vectors, scale, id_column, vector), "vectors")
    n = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    shards, blocks = max(1, -(-n["n"] // shard_rows)), max(1, -(-n["q"] // block_queries))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
    asked_for = rows.where(F.coalesce(is_query, F.lit(False))).toDF(*rows.columns)  # columns of its own
    # inside the tasks a missing id is the last one, so that ids stay integers
    rows, asked_for = (x.withColumn("id", F.coalesce("id", F.lit(_LAST))) for x in (rows, asked_for))
    queries = asked_for.withColumn(
        "block", F.pmod(F.xxhash64("uid", F.lit("block")), F.lit(blocks)).cast("int")
    )
    schema = "quid bigint, query_id bigint, uid bigint, vec bigint, score bigint"

    def search(held: pd.DataFrame, asked: pd.DataFrame) -> Iterator[pd.DataFrame]:
        out = {c: [] for c in ("quid", "query_id", "uid", "vec", "score")}
        for dim, own in held.groupby("dim"):
            wanted = asked[asked["dim"] == dim]
            if not len(wanted):
                continue
            own = own.reset_index(drop=True)
            matrix, questions = _matrix(own["bytes"]), _matrix(wanted["bytes"])
            if dim and float(np.abs(matrix.astype(float)).max()) * float(np.abs(questions.astype(float)).max()) * dim >= 2.0**62:
                raise ValueError("an inner product may need more than 64 bits")
            ids, uids = own["id"].to_numpy(), own["uid"].to_numpy()
            tree = BallTree(matrix)
            for q, quid, qid, threshold in zip(questions, wanted["uid"], wanted["id"], wanted["threshold"]):
                at, scores = tree.search(q, ids, uids, quid, k, threshold)
                out["quid"].append(np.full(len(at), quid))
                out["query_id"].append(np.full(len(at), qid))
                out["uid"].append(uids[at])
                out["vec"].append(ids[at])
                out["score"].append(scores)
        return pd.DataFrame({c: np.concatenate(x) if x else np.zeros(0, np.int64) for c, x in out.items()})

    def against(asked: DataFrame) -> DataFrame:
        """asked: queries with ``shard`` (where to look), ``block`` and ``threshold``."""
        held = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(search, schema)

    order = [F.desc("score"), F.col("vec").asc_nulls_last(), F.col("uid")]
    home = staged(against(queries.withColumn("threshold", F.lit(float("-inf")))), "home")
    nth = Window.partitionBy("quid").orderBy(*order)
    kth = home.withColumn("r", F.row_number().over(nth)).where(F.col("r") == k).select("quid", F.col("score").cast("double").alias("kth"))
    elsewhere = (
        queries.join(kth, queries["uid"] == kth["quid"], "left")
        .withColumn("threshold", F.coalesce("kth", F.lit(float("-inf"))))
        .drop("quid", "kth")
        .withColumn("home", F.col("shard"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .where(F.col("shard") != F.col("home"))
        .drop("home")
    )
    found = home.unionByName(against(elsewhere)) if shards > 1 else home
    return (
        found.withColumn("rank", F.row_number().over(nth).cast("int"))
        .where(F.col("rank") <= k)
        .select(
            F.when(F.col("query_id") != _LAST, F.col("query_id")).alias("query_id"),
            "rank",
            F.when(F.col("vec") != _LAST, F.col("vec")).alias(id_column),
            "score",
        )
    )
