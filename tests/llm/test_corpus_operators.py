"""Every corpus operator against a brute-force version, on hard small rows and on a small table."""

from __future__ import annotations

import random

import brute
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from riskweave.llm import bpe, components, jaccard, langid, linededup, lm, packing, quality, subdedup, topk, wavelet
from riskweave.llm import common
from riskweave.llm.ship import ship
from riskweave.session import scratch_dir

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# extra columns whose names the operators use themselves
SCHEMA = "doc_id bigint, text string, source string, lang string, id bigint, key string, n_words string, ids string, label int, `a.b` int"


def hard_rows():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 6))) for _ in range(60)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", ",", ". Q", "\n", "\t"]) for _ in range(n))

    base = prose(120)
    words = base.split(" ")
    near = [" ".join(w if rng.random() > 0.02 else "x%d" % k for k, w in enumerate(words)) for _ in range(25)]
    far = [" ".join(w if rng.random() > 0.07 else "y%d" % k for k, w in enumerate(words)) for _ in range(25)]
    texts = [
        None, "", " \n\t ", "one", "One TWO three four", "one two three four", "a b c d e", "A b C d e", "12345 !!! $$$",
        base, base, base, *near, *far, prose(3000), "z" * 3000, "word " * 400, "Stop. " * 300, "<|endoftext|> a.b 3.14 ... don't Σας",
        "\x1c\x85 odd spaces　here\x0b\x0c", prose(9), prose(10), prose(11), prose(40) + "\n" + base, base + "\n" + prose(60),
        *[f"Common footer line of this host.\nText {i} {prose(30)}" for i in range(12)],
    ]
    rows = [(i, t, f"h{i % 3}" if i % 7 else None, ["en", "de", None][i % 3]) for i, t in enumerate(texts)]
    rows.append((None, "a row without an id", "h1", "en"))
    rows.append((None, "another row without an id", "h1", "en"))
    return rows + [rows[9], rows[-3]]  # rows told twice


@pytest.fixture(scope="module")
def hard(spark):
    ship(spark)
    return spark.createDataFrame([(*r, 1, "k", "n", "x", 2, 3) for r in hard_rows()], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_word_hashes_follow_the_words_only():
    texts = [t for _, t, *_ in hard_rows()]
    import pyarrow as pa

    old, common.HASH_BYTES = common.HASH_BYTES, 64
    try:
        hashes, bounds = common.words(*common.text_bytes(pa.array(texts, pa.string())))
    finally:
        common.HASH_BYTES = old
    spelt = [brute.words(t) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in spelt]
    flat = [w for x in spelt for w in x]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_packed_numbers_round_trip():
    for x in ([], [0], [1, 255, 256], [2**64 - 1, 0, 7]):
        x = np.array(x, np.uint64)
        assert (common.unpack_numbers(common.pack_numbers(x)) == x).all()


def test_language_id(spark, hard, empty):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the hat of the", "en"), ("der hund und die katze", "de")] * 30)]
    train = spark.createDataFrame([*rows, (90, None, "en"), (91, "unlabelled", None)], "doc_id bigint, text string, lang string")
    model = langid.fit(train, max_docs_per_lang=1000, profile_size=100)
    assert model.languages == ["de", "en"]
    found = langid.predict(hard, model)
    assert found.columns == ["doc_id", "lang_pred", "score"] and found.count() == len(hard_rows())
    for (_, text, *_), (_, pred, score) in zip(sorted(hard_rows(), key=repr), sorted(map(tuple, found.collect()), key=repr)):
        assert 0 <= score <= 1
    said = {r["doc_id"]: r for r in found.collect()}
    assert [said[i]["lang_pred"] for i in (0, 1, 2, 8)] == ["und"] * 4
    assert said[9]["lang_pred"] != "und"
    assert langid.predict(empty, model).count() == 0
    assert langid.predict(hard, langid.fit(empty)).where("lang_pred <> 'und'").count() == 0
    kept = langid.keep_identified(hard, model, 0.0)
    assert kept.columns == hard.columns
    assert kept.count() == found.where("lang_pred <> 'und'").count()


def test_profile_ties_and_distance():
    codes = np.array([5, 5, 3, 3, 9], np.int64)
    assert langid.profile(codes, 10).tolist() == [3, 5, 9]
    model = langid.LanguageModel(["x", "y"], np.array([3, 5, 9]), np.array([[0, 1], [1, 0], [10, 2]]), 10, 1)
    grams = langid.gram_codes("A-a b", 1)
    assert sorted(grams.tolist()) == [97, 97, 98]
    assert model.predict("") == ("und", 0.0)


def test_language_id_held_out_accuracy(spark):
    from riskweave.llm.queries import op1_language_id

    sf = "/root/testdata/sf0.01"
    found = op1_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out AND lang IS NOT NULL")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count() > 0


def test_quality_rules(hard, empty):
    found = quality.line_frequency_verdict(hard)
    rows = hard_rows()
    want = [
        (key, *brute.quality(text), *verdict[1:])
        for (key, text, *_), verdict in zip(rows, brute.line_verdicts([(k, h, t) for k, t, h, _ in rows]))
    ]
    got = found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_lines",
        "n_removed_words",
    )
    same(result(got), want)
    assert found.where("n_removed_lines > 0").count() > 0
    assert quality.line_frequency_verdict(empty).count() == 0


def test_lm_scoring(hard, empty):
    rows = hard_rows()
    for order, words in ((1, 10**6), (2, 200), (3, 10**6)):
        got = lm.score_documents(hard, order=order, block_words=words, bucket_grams=500)
        want = brute.lm_scores([(k, t) for k, t, *_ in rows], order)
        a = sorted(((r["doc_id"], r["n_words"], round(r["log_score"], 4)) for r in got.collect()), key=repr)
        assert a == sorted(((k, n, round(s, 4)) for k, n, s in want), key=repr)
    assert lm.score_documents(hard).where("n_words = 0 AND perplexity IS NOT NULL").count() == 0
    assert lm.score_documents(empty).count() == 0


def check_packing(found, rows, capacity):
    whole = {}
    for key, text, *_ in rows:
        whole.setdefault(key, []).append(brute.word_ids(text) + [1])
    pieces = found.toPandas()
    assert len(pieces) == sum(-(-len(x) // capacity) for v in whole.values() for x in v)
    for r in pieces.itertuples():
        key = None if pd.isna(r.doc_id) else int(r.doc_id)
        assert any(x[r.start : r.start + r.length] == np.frombuffer(r.ids, "<u4").tolist() for x in whole[key])
        assert r.start == r.piece * capacity and 0 < r.length <= capacity
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert (own.length.cumsum() - own.length).tolist() == own.offset.tolist()
        assert own.length.sum() <= capacity
    return pieces


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing(hard, empty, rule):
    found = packing.pack_documents(hard, WORD_BPE, capacity=256, rule=rule)
    pieces = check_packing(found, hard_rows(), 256)
    assert pieces.sequence_id.nunique() <= 1.1 * -(-pieces.length.sum() // 256)
    limited = packing.pack_documents(hard, WORD_BPE, capacity=256, max_documents=2, max_attention=40_000, rule=rule).toPandas()
    cut = limited[limited.length < 256].groupby("sequence_id")
    assert cut.size().max() <= 2
    assert cut.length.apply(lambda x: (x**2).sum() if len(x) > 1 else 0).max() <= 40_000
    assert packing.pack_documents(empty, WORD_BPE).count() == 0


def test_best_fit_is_near_the_bound():
    lengths = np.random.default_rng(3).integers(1, 4096, 3000)
    opener, offset = packing.best_fit(lengths, 4096, 4096, 4096**2)
    assert len(set(opener.tolist())) <= 1.02 * lengths.sum() / 4096 + 1
    used = np.zeros(3000, np.int64)
    for i in np.lexsort((offset, opener)):
        assert offset[i] == used[opener[i]]
        used[opener[i]] += lengths[i]
    assert used.max() <= 4096


def test_top_k(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype("f4")]) for i in range(700)]
    rows += [(700, None), (800, [1.0, None] + [0.0] * 6), (801, [float("nan")] * 8), (900, [float("inf")] * 8), (None, [2.0] * 8)]
    rows += [rows[100], rows[100], (100, rows[5][1]), (1000, [0.0] * 8), (1100, [0.0] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("uid", F.lit("x")).repartition(3)
    ship(spark)
    want = brute.top_k(rows)
    for settings in ({}, {"shard_rows": 60, "block_queries": 3}, {"k": 700, "shard_rows": 300}):
        got = result(topk.top_k(vectors, F.col("id") % 100 == 0, **settings))
        same(got, brute.top_k(rows, **{k: v for k, v in settings.items() if k == "k"}))
    same(result(topk.top_k(vectors, F.col("id") % 100 == 0)), want)
    assert topk.top_k(vectors.limit(0), F.col("id") % 100 == 0).count() == 0
    few = vectors.where("vec_id in (200, 201)")
    assert result(topk.top_k(few, F.col("id") % 100 == 0))[0][:3] == (200, 1, 201)


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = rng.integers(0, 300, n).astype(np.uint32)
        for bits in (9, 17):
            own = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids, bits).to_bytes())
            assert (own.decode() == ids).all() and (own.access(np.arange(n)) == ids).all()
            for token in (0, 7, 299, 511, 1 << 20):
                assert (own.occurrences(token) == np.flatnonzero(ids == token)).all()
                assert own.rank(token, n // 2) == (ids[: n // 2] == token).sum() and own.count(token) == (ids == token).sum()
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix.build(np.array([512]), 9)


def test_token_files(spark, hard, empty):
    path = scratch_dir(spark, "tokens")
    wavelet.write_token_shards(hard, path, WORD_BPE, shard_tokens=700)
    assert spark.read.parquet(path).count() > 3
    found = wavelet.read_documents(spark, path).toPandas().sort_values("start")
    rows = hard_rows()
    assert len(found) == len(rows)
    keys = [None if pd.isna(k) else int(k) for k in found.doc_id]
    assert keys == sorted((k for k, *_ in rows), key=lambda k: (k is not None, k or 0))
    assert found.start.tolist() == (found.n_tokens.cumsum() - found.n_tokens).tolist()
    want = sorted((repr(k), tuple(brute.word_ids(t) + [2])) for k, t, *_ in rows)
    assert sorted((repr(k), tuple(np.frombuffer(x, "<u4").tolist())) for k, x in zip(keys, found.ids)) == want
    token = brute.word_ids("word")[0]
    places = sorted((k, i) for k, t, *_ in rows for i, x in enumerate(brute.word_ids(t)) if x == token)
    assert sorted((r["doc_id"], r["position"]) for r in wavelet.find_token(spark, path, token).collect()) == places
    assert wavelet.count_token(spark, path, token).first()["n"] == len(places) > 0
    nothing = scratch_dir(spark, "tokens")
    wavelet.write_token_shards(empty, nothing, WORD_BPE)
    assert wavelet.read_documents(spark, nothing).count() == 0


def test_line_dedup(hard, empty):
    rows = [(k, h, t) for k, t, h, _ in hard_rows()]
    for ratio in (0.1, 0.3):
        want = brute.lines_left(rows, ratio)
        same(result(linededup.drop_boilerplate(hard, ratio).select("doc_id", "text", "n_lines", "n_dropped")), want)
        same(result(linededup.drop_boilerplate(hard, ratio, max_broadcast_lines=0)), want)
    assert sum(w[3] for w in brute.lines_left(rows)) > 0
    assert linededup.drop_boilerplate(empty).count() == 0


def test_jaccard_join(hard, empty, spark):
    rows = hard_rows()
    want = brute.jaccard_components([(k, t) for k, t, *_ in rows])
    want = [(k, *want[i]) for i, (k, *_) in enumerate(rows)]
    # few members make a group large or a signature common here, so every path runs
    for settings in ({}, {"frequent": 2, "bucket_signatures": 300}, {"common_least": 2}, {"frequent": 2, "common_least": 3, "rounds": 1}, {"rounds": 0}):
        found = jaccard.near_duplicates(hard, **settings).select("doc_id", "size", "component")
        same(result(found), want)
    assert len({w[2] for w in want}) < len(want) - 20
    kept = jaccard.keep_one(hard)
    assert kept.columns == hard.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert set(i for i in ids if i is not None) == {w[0] for w in want if w[0] is not None and (w[0] == w[2])}
    assert ids.count(None) == 2
    assert jaccard.near_duplicates(empty).count() == 0


def test_signatures_meet_at_every_size():
    rng = np.random.default_rng(11)
    for size in (7, 30, 97, 130, 400, 1100, 5000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            # as far apart as a link allows: one side loses features, or both change some
            lost = rng.permutation(a)[: int(len(a) * rng.choice([0.75, 0.9]))]
            new = rng.integers(0, 2**63, rng.integers(0, 1 + len(lost) // 3)).astype(np.uint64)
            b = np.unique(np.concatenate([lost, new]))
            shared = len(np.intersect1d(a, b))
            if 100 * shared < 75 * (len(a) + len(b) - shared) or len(a) == len(b) == shared:
                continue
            common_ones = np.sort(rng.choice(common.mix64(a), 3))
            for listed in (np.zeros(0, np.uint64), common_ones):
                met = [
                    np.concatenate([s for k in (0, 1) for s in jaccard.signatures(x, jaccard.level(jaccard.band(len(x)) + k), listed)[:2]])
                    for x in (a, b)
                ]
                assert len(np.intersect1d(*met)), size
            assert jaccard.may_link(jaccard.cell_counts(a), jaccard.cell_counts(b), len(a), len(b))
            assert jaccard.similar_rows([a], [b], columns=50).tolist() == [[True]]


def test_connected_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100 + rng.randint(0, 30), 100 + rng.randint(0, 30)) for _ in range(25)]
    links = [(a, b) for a, b in links if a != b]
    parent = {}
    for a, b in links:
        parent.setdefault(a, a), parent.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(parent[a], parent[b])
            changed |= parent[a] != low or parent[b] != low
            parent[a] = parent[b] = low
    found = components.connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r["id"]: r["label"] for r in found.collect()} == parent
    labels = spark.createDataFrame([], "id bigint, label bigint")
    for part in (links[::3], links[1::3], [], links[2::3]):
        labels = components.extended(labels, spark.createDataFrame(part, "a bigint, b bigint"))
    assert {r["id"]: r["label"] for r in labels.collect()} == parent


def test_substring_dedup(spark, hard, empty):
    rng = random.Random(4)
    text = [" ".join(rng.choice(["ab", "cd", "ef", "gh"]) + str(rng.randint(0, 900)) for _ in range(8)) + "." for _ in range(60)]
    passage = " ".join(text[:8])
    rows = [(i, f"{' '.join(text[20 + i : 24 + i])} Of {passage} and {text[i + 9]}\n" + text[30 + i].upper()) for i in range(10)]
    rows += [(20, None), (21, ""), (22, "Ok. " * 50), (23, passage), (24, passage.replace(" ", "\n"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("digest", F.lit(1)).repartition(2)
    found = {r["doc_id"]: r for r in subdedup.remove_repeats(docs).collect()}
    want = brute.without_repeats(rows)
    assert {k: r["text"] for k, r in found.items()} == want
    for key, original in rows:
        left, at = "", 0
        for span in found[key]["spans"]:
            left, at = left + original[at : span["start"]], span["start"] + span["length"]
        assert original is None or left + original[at:] == found[key]["text"]
    assert text[5] in found[0]["text"] and all(text[5] not in found[k]["text"] for k in (1, 5, 9, 23))
    assert subdedup.remove_repeats(hard).count() == len(hard_rows())
    for unit in ("line", "paragraph"):
        assert subdedup.remove_repeats(hard, unit=unit).count() == len(hard_rows())
    assert subdedup.remove_repeats(empty).count() == 0


def test_byte_bpe(spark, hard, empty):
    encoded = bpe.encode_documents(hard, MULTI_BPE, public_tokenizers.PATTERN)
    found = bpe.decode_documents(encoded, MULTI_BPE, public_tokenizers.PATTERN)
    want = [(k, len(brute.multi_ids(t)), brute.le32(brute.multi_ids(t)), (t or "").encode()) for k, t, *_ in hard_rows()]
    same([(r[0], r[1], bytes(r[2]), bytes(r[3])) for r in found.collect()], want)
    assert bpe.encode_documents(empty, MULTI_BPE, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_long_pieces_merge_in_the_same_order():
    with open(MULTI_BPE, "rb") as f:
        own = bpe.ByteBPE(f.read(), public_tokenizers.PATTERN)
    rng = random.Random(3)
    for n in (2, 31, 200, 511):
        piece = "".join(rng.choice("abcdetión") for _ in range(n)).encode()[:n]
        assert own.merge_rows([piece])[0].tolist() == own.merge_long(piece).tolist()
