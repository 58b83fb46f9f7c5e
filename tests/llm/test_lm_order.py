"""The registered language-model scores use trigrams."""

from __future__ import annotations

import brute

from riskweave.llm.queries import llm_queries


def test_the_registered_query_scores_with_trigrams(spark, tmp_path):
    texts = ["a b c", "a b c", "x b d", "x b d", "a b c x b d", None, "b c"]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"], r["n_words"], round(r["log_score"], 6)) for r in llm_queries()["op3_lm_scoring"](spark, str(tmp_path)).collect())
    assert got == [(k, n, round(s, 6)) for k, n, s in brute.lm_scores(rows, 3)]
    assert got != [(k, n, round(s, 6)) for k, n, s in brute.lm_scores(rows, 2)]
