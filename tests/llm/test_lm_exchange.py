"""What the language model sends through its shuffles."""

from __future__ import annotations

import brute
import numpy as np
from pyspark.sql import functions as F

from riskweave.llm import common, lm


def test_squeezed_numbers_come_back():
    rng = np.random.default_rng(5)
    steps = rng.exponential(2.0**42, 3000).astype(np.uint64)
    for x in (steps, steps[:1], steps[:0], np.zeros(7, np.uint64), np.full(9, 2**64 - 1, np.uint64), rng.integers(0, 70_000, 500).astype(np.uint64)):
        assert (common.squeezed_numbers(common.squeeze_numbers(x)) == x).all()


def test_a_span_of_grams_takes_under_six_bytes_each():
    rng = np.random.default_rng(6)
    grams, buckets = np.sort(rng.integers(0, 2**64, 2_000_000, np.uint64)), 100
    to = lm._bucket(grams, buckets)
    sent = 0
    for k in (0, 1, 57, 99):
        own = grams[to == k]
        low = lm._lowest(np.array([k]), buckets)
        assert own[0] >= low[0]
        data = common.squeeze_numbers(np.diff(own, prepend=low[0]))
        assert (low + np.cumsum(common.squeezed_numbers(data), dtype=np.uint64) == own).all()
        sent += len(data)
    assert sent < 5.8 * np.isin(to, (0, 1, 57, 99)).sum()


def test_texts_are_sent_compressed_once_and_scores_stay(spark, monkeypatch):
    rng = np.random.default_rng(7)
    some = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    rows = [(f"k{i % 90}", " ".join(rng.choice(some, int(rng.integers(0, 60))))) for i in range(120)] + [(None, "a b"), ("n", None), ("e", "")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    parcels = docs.select(F.col("doc_id").alias("key"), "text", F.lit(1).cast("bigint").alias("block")).mapInArrow(
        lm._parcels, "block bigint, keys array<string>, sizes binary, texts binary"
    )
    told = parcels.agg(F.sum(F.size("keys")).alias("rows"), F.sum(F.length("texts")).alias("bytes")).first()
    assert told["rows"] == len(rows) and told["bytes"] < 0.6 * sum(len(t or "") for _, t in rows)
    got = lm.score_documents(docs, order=3, block_words=500, bucket_grams=900)
    want = brute.lm_scores(rows, 3)
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(((r[0], r[1], round(r[2], 4)) for r in got.collect()), key=key) == sorted(((k, n, round(s, 4)) for k, n, s in want), key=key)
