"""Repeated passages that begin and end inside sentences."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from riskweave.llm import subdedup
from riskweave.llm.ship import ship


def spread(rng, n, every):
    """n words that no other call gives, a sentence end after about ``every``."""
    return [f"w{rng.randrange(10**12)}" + ("." if rng.random() < 1 / every else "") for _ in range(n)]


def longest_shared(a, b, n=51):
    a, b = a.lower().split(), b.lower().split()
    own = {tuple(a[i : i + n]) for i in range(len(a) - n + 1)}
    return sum(tuple(b[i : i + n]) in own for i in range(len(b) - n + 1))


def test_passages_of_51_words_inside_sentences_go(spark):
    ship(spark)
    rng = random.Random(5)
    rows, left = [], {}
    for case, (length, every) in enumerate([(40, 10**9), (51, 10**9), (51, 30), (60, 12), (90, 40), (200, 10**9), (400, 9)]):
        passage = spread(rng, length, every)
        for copy in range(4):
            before, after = spread(rng, 37, 10), spread(rng, 41, 10)
            before[-1], after[0] = before[-1].strip("."), after[0].strip(".")
            told = [x.upper() if copy == 2 else x for x in passage]
            key = 10 * case + copy
            rows.append((key, " ".join([*before, *told, *after])))
            left[key] = " ".join([*before, *(passage if copy == 0 else []), *after])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = subdedup.remove_repeats(docs, sure_words=40).orderBy("doc_id").collect()
    assert {r["doc_id"]: r["text"] for r in found} == left
    for (_, original), r in zip(rows, found):
        kept, at = "", 0
        for span in r["spans"]:
            kept, at = kept + original[at : span["start"]], span["start"] + span["length"]
        assert kept + original[at:] == r["text"]


def test_the_registered_query_leaves_no_run_of_51_words(spark, tmp_path):
    from riskweave.llm.queries import llm_queries

    rng = random.Random(6)
    passage = spread(rng, 70, 10**9)
    texts = [" ".join([*spread(rng, 30, 10), "x", *passage, *spread(rng, 30, 10)]) for _ in range(5)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r["text"] for r in llm_queries()["op9_substring_dedup"](spark, str(tmp_path)).collect()}
    assert found[0] == texts[0]
    assert not any(longest_shared(texts[0], found[k]) for k in range(1, 5))


def test_hard_rows_keep_their_number_and_nulls(spark):
    ship(spark)
    rows = [(1, None), (2, ""), (3, "word " * 400), (None, "a b"), (None, "word " * 400), (3, "word " * 400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("tie", F.lit(1))
    found = subdedup.remove_repeats(docs, sure_words=40)
    assert found.count() == len(rows)
    assert subdedup.remove_repeats(docs.limit(0), sure_words=40).count() == 0


def test_own_repeats_go_and_one_word_over_and_over_stays(spark):
    ship(spark)
    rng = random.Random(8)
    passage, a, b, c = (spread(rng, n, 10**9) for n in (60, 20, 25, 20))
    rows = [(1, " ".join([*a, *passage, *b, *passage, *c])), (2, "word " * 400)]
    found = {r["doc_id"]: r["text"] for r in subdedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), sure_words=40).collect()}
    assert found == {1: " ".join([*a, *passage, *b, *c]), 2: rows[1][1]}
