"""The pipeline's line stage against copies of a document inside one host."""

from __future__ import annotations

import corpus_pipeline


def table(spark, texts):
    rows = [(i, t, "en", h, len(t)) for i, (h, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_copies_alone_do_not_make_a_text_boilerplate(spark):
    body = "\n".join(f"only line {i} of the copied page" for i in range(5))
    texts = [("small", f"page {i}\nown words {i}") for i in range(8)] + [("small", body)] * 2
    texts += [("large", f"leaf {i}\nFooter\nwords {i}") for i in range(60)] + [("large", body + "\nFooter")] * 30
    made = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, table(spark, texts), "").collect()}
    want = {i: "\n".join(x for x in t.split("\n") if x != "Footer") for i, (_, t) in enumerate(texts)}
    assert made == want


def test_lines_on_a_few_per_cent_of_a_host_are_boilerplate(spark):
    texts = [
        ("h", f"page {i}\nown words {i}" + ("\nThree per cent" if i % 33 == 0 else "") + ("\nEight per cent" if i % 12 == 0 else ""))
        for i in range(500)
    ]
    texts += [("few", f"site {i}\nstories of {i}" + ("\nOn nine pages" if i < 9 else "")) for i in range(40)]
    made = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, table(spark, texts), "").collect()}
    assert made == {i: "\n".join(x for x in t.split("\n") if not x.endswith("per cent")) for i, (_, t) in enumerate(texts)}
