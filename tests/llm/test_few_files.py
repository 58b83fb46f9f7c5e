"""Small staged tables are not written as a file for every shuffle partition."""

from __future__ import annotations

import random

import brute
import corpus_pipeline

from riskweave.llm import common


def test_jaccard_stage_writes_few_files(spark, monkeypatch):
    rnd = random.Random(5)
    told = []
    for k in range(120):
        # families of near copies, an exact copy in each, and texts of their own
        text = [f"w{rnd.randrange(5000)}" for _ in range(60)] if k % 4 == 0 else told[-1][1].split()
        if k % 4 in (1, 2):
            text[rnd.randrange(len(text))] = f"x{k}"
        told.append((k, " ".join(text)))
    docs = spark.createDataFrame([(k, x, "en", "s", len(x)) for k, x in told], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    made, folder = [], common.scratch_dir

    def noted(*rest: object) -> str:
        made.append(folder(*rest))
        return made[-1]

    monkeypatch.setattr(common, "scratch_dir", noted)
    settings = {"spark.sql.shuffle.partitions": "96", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = common.staged(corpus_pipeline.ngram_jaccard_join(spark, docs, ""), "kept")
        rows = {r["doc_id"]: r["text"] for r in kept.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = brute.jaccard_components(told)
    assert rows == {k: t for i, (k, t) in enumerate(told) if found[i][1] == k}
    files = {path: len(spark.read.parquet(path).inputFiles()) for path in made}
    cores = spark.sparkContext.defaultParallelism
    assert len(files) > 10 and max(files.values()) <= max(4 * cores, 96 // 8)
    labels = [n for path, n in files.items() if "/labels-" in path]
    assert labels and max(labels) <= max(cores, 96 // 32)
