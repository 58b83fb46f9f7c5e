"""Columns of the caller's with the operators' own names, kept or not, and op9 against brute force."""

from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F

from riskweave.llm import bloom, jaccard, langid, linededup, lm, minhash, packing, quality, spelling, subdedup
from riskweave.llm.queries import op9_substring_dedup
from riskweave.llm.ship import ship

#: Names that some operator uses for a column of its own.
OWN = (
    "id tie digests windows spans marked shared near digest first pick _id _tie _text _key _host _own _kept _left lines n_lines n_dropped pages copied line"
    " host key label size component cells proof g code frequent c0 c1 c2 _c0 _c1 block bucket grams lang_pred score n_words sketch bands word edit n"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"Same footer of this host.\nOwn words {i} {' '.join(f'w{i}x{j}' for j in range(30))}. {passage if i % 3 == 0 else ''}" for i in range(15)]
    texts += [texts[4], None, ""]
    rows = [(i, t, "h", "en") for i, t in enumerate(texts)]
    base = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    return base.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in OWN])


def whole(df, columns):
    return sorted(map(repr, df.select(*[F.col(f"`{c}`") for c in columns]).collect()))


def values_kept(made, names=OWN):
    for c in names:
        assert made.where(F.col(f"`{c}`") != F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string"))).count() == 0, c


def test_kept_columns_keep_their_values(spark, docs):
    clear = [c for c in OWN if c not in ("n_lines", "n_dropped", "spans")]  # those are columns of the result
    plain = docs.select("doc_id", "text", "source", "lang")
    made = linededup.drop_boilerplate(docs, keep=clear)
    assert made.columns == ["doc_id", *clear, "text", "n_lines", "n_dropped"]
    values_kept(made, clear)
    own = ["doc_id", "text", "n_lines", "n_dropped"]
    assert whole(made, own) == whole(linededup.drop_boilerplate(plain), own)
    assert made.where("n_dropped > 0").count() > 10
    for sure in (None, 40):
        made = subdedup.remove_repeats(docs, keep=[c for c in OWN if c != "spans"], sure_words=sure)
        assert whole(made, ["doc_id", "text", "spans"]) == whole(subdedup.remove_repeats(plain, sure_words=sure), ["doc_id", "text", "spans"])
        values_kept(made, [c for c in OWN if c != "spans"])
    made = jaccard.keep_one(docs)
    assert made.columns == docs.columns
    values_kept(made)
    assert sorted(r[0] for r in made.select("doc_id").collect()) == [*range(15), 16, 17]


def test_other_columns_are_ignored(spark, docs):
    plain = docs.select("doc_id", "text", "source", "lang")
    for run in (
        lambda d: quality.line_frequency_verdict(d), lambda d: lm.score_documents(d).select("doc_id", "n_words", F.round("log_score", 6)),
        lambda d: jaccard.near_duplicates(d).select("doc_id", "size", "component"), lambda d: minhash.near_duplicates(d).select("doc_id", "size", "component"),
        lambda d: langid.predict(d, langid.fit(d)), lambda d: spelling.runs(d, F.col("doc_id")),
    ):
        a, b = run(docs), run(plain)
        assert a.columns == b.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    model = langid.fit(docs)
    assert langid.keep_identified(docs, model, 0.0).columns == docs.columns
    assert packing.pack_documents(docs, __import__("public_tokenizers").path("word_bpe_49k.json")).select("doc_id").distinct().count() == 18


def test_a_digest_filter_lets_every_member_through(spark):
    ship(spark)
    from riskweave.llm.spelling import probe
    import numpy as np

    values = spark.range(5000).select(F.xxhash64("id").alias("d"))
    own = np.array([r["d"] for r in values.collect()], np.int64).view(np.uint64)
    for most in (1 << 20, 1 << 10):
        table = bloom.digest_filter(values, "d", filter_bytes=most)
        assert len(probe(table, own)) == 5000 and table.nbytes <= most
    few = np.arange(1, 100_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert len(probe(bloom.digest_filter(values, "d"), few)) < 2000
    assert len(probe(bloom.digest_filter(values.limit(0), "d"), few)) == 0


def test_registered_substring_dedup_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    told = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    ship(spark)
    made = {r["doc_id"]: r for r in op9_substring_dedup(spark, sf).collect()}
    want = brute.without_repeats([tuple(r) for r in told], sure_words=40)
    assert {k: r["text"] for k, r in made.items()} == want
    assert sum(bool(r["spans"]) for r in made.values()) > 20
    for k, text in told:
        left, at = "", 0
        for span in made[k]["spans"]:
            left, at = left + text[at : span["start"]], span["start"] + span["length"]
        assert left + text[at:] == made[k]["text"]
