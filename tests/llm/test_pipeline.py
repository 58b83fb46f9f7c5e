"""The corpus pipeline stage by stage against brute force, and its queries' SQL."""

from __future__ import annotations

import os
import sys

import brute
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

import corpus_pipeline  # noqa: E402
import oracle_check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark):
    """The input and output of every stage, as run() passes them on."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.staged(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, made)
        docs = made
    return out


def test_stages_keep_the_columns_of_documents(spark, stages):
    want = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)
    for name, (_, made) in list(stages.items())[:-1]:
        assert sorted(made.dtypes) == sorted(want), name
        assert made.where(F.col("n_chars") != F.length("text")).count() == 0


def test_language_id_keeps_clean_documents(stages):
    docs, made = stages["language_id"]
    before = {k: t for k, t in rows(docs).items() if t and any(c.isalpha() for c in t)}
    assert rows(made) == before


def test_line_dedup_stage(stages):
    docs, made = stages["line_dedup"]
    told = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    want = brute.lines_left(told, corpus_pipeline.LINE_RATIO, distinct=True, min_line_pages=corpus_pipeline.MIN_LINE_PAGES)
    assert rows(made) == {k: t for k, t, *_ in want if brute.words(t)}


def test_jaccard_stage_keeps_one_of_each_component(stages):
    docs, made = stages["ngram_jaccard_join"]
    told = sorted(rows(docs).items())
    found = brute.jaccard_components(told)
    assert rows(made) == {k: t for i, (k, t) in enumerate(told) if found[i][1] == k}


def test_substring_stage(stages):
    docs, made = stages["substring_dedup"]
    want = brute.without_repeats(sorted(rows(docs).items()), sure_words=40)
    assert rows(made) == {k: t for k, t in want.items() if brute.words(t)}
    assert rows(made) != rows(docs)


def test_packing_stage(stages):
    docs, made = stages["best_fit_packing"]
    texts, packed = rows(docs), made.toPandas()
    for r in packed.itertuples():
        whole = brute.word_ids(texts[r.doc_id]) + [1]
        assert brute.le32(whole[r.start : r.start + r.length]) == r.ids
    assert packed.length.sum() == sum(len(brute.word_ids(t)) + 1 for t in texts.values())
    assert packed.groupby("sequence_id").length.sum().max() <= 4096


def test_run_equals_its_stages(spark, stages):
    a = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", F.crc32("ids").alias("c"))
    b = stages["best_fit_packing"][1].select("doc_id", "piece", "length", F.crc32("ids").alias("c"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_sql(spark, name):
    con = oracle_check.duck(SF)
    problems, n, *_ = oracle_check.compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert not problems and n
