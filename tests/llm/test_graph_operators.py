"""Circulant MinHash, spelling variants and the Merkle manifest against brute force, on hard small rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import common, merkle, minhash, pivots, spelling
from riskweave.llm.ship import ship

from test_corpus_operators import hard_rows, result, same

# extra columns whose names the operators use themselves
SCHEMA = (
    "doc_id bigint, text string, source string, lang string, n_chars bigint, id bigint, key string, g bigint, pos bigint, n bigint,"
    " word string, run string, label int, bands int, a string, b string, part int, place int, digest string, h string, `a.b` int"
)


def rows_of(texts):
    return [(k, t, s, lang, None if t is None else len(t)) for k, t, s, lang in texts]


def frame(spark, rows):
    ship(spark)
    return spark.createDataFrame([(*r, 1, "k", 2, 3, 4, "w", "r", 5, 6, "a", "b", 7, 8, "d", "h", 9) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def hard(spark):
    return frame(spark, rows_of(hard_rows()))


# ---- circulant MinHash ------------------------------------------------------------

def components(docs, percent=80, n=4):
    """docs: (key, text) -> [(key, set size, smallest key of the component)]."""
    sets = [brute.shingles(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            shared = len(s & sets[j])
            if shared and 100 * shared >= percent * (len(s) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(key, len(sets[i]), least.get(find(i))) for i, (key, _) in enumerate(docs)]


def star(spark, leaves=70):
    """Copies that are near to one original each, and mostly not to each other, and a chain."""
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 400)}" for _ in range(300)]
    texts = [" ".join(base)]
    for i in range(leaves):
        own = list(base)
        for k in rng.sample(range(300), 8):
            own[k] = f"x{i}-{k}"
        texts.append(" ".join(own))
    chain = list(base)[:200]
    for i in range(12):
        chain = list(chain)
        for k in range(4):
            chain[(17 * i + 50 * k) % 200] = f"c{i}-{k}"
        texts.append(" ".join(chain))
    return [(i, t, "s", "en", len(t)) for i, t in enumerate(texts)]


def test_permutations_and_shift():
    x = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(minhash.pi(x.copy()))) == 1 << 16
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 5, 400)]
    got = minhash.signatures(sets, 24)
    for row, own in zip(got, sets):
        moved = minhash.sigma(own).astype(np.uint64)
        want = [int(minhash.pi(((moved + np.uint64(k)) % np.uint64(1 << 32)).astype(np.uint32)).min()) for k in range(24)]
        assert row.tolist() == want
    hashes = minhash.band_hashes(got, minhash.Scheme(bands=4, rows=6))
    assert hashes.shape == (3, 4) and len(np.unique(hashes)) == 12


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(2)
    seen = []
    for _ in range(40):
        both = rng.integers(0, 2**63, 300).astype(np.uint64)
        own = [np.unique(np.concatenate([both, rng.integers(0, 2**63, 37).astype(np.uint64)])) for _ in range(2)]
        x, y = minhash.signatures(own, 240)
        seen.append((x == y).mean())
    assert abs(np.mean(seen) - 300 / 374) < 0.02 and min(seen) * 240 > minhash.Scheme().least_agreement


def test_min_hash_components(spark, hard, monkeypatch):
    told = rows_of(hard_rows())
    want = components([(k, t) for k, t, *_ in told])
    same(result(minhash.near_duplicates(hard).select("doc_id", "size", "component")), want)
    rows = star(spark)
    docs, want = frame(spark, rows), components([(k, t) for k, t, *_ in rows])
    assert len({w[2] for w in want}) < 10
    same(result(minhash.near_duplicates(docs).select("doc_id", "size", "component")), want)
    # small blocks, no pivot rounds, dense blocks and several partners' shares: the rows are the same
    for name, value in (("ROUNDS", 0), ("BLOCK", 16), ("DENSE", 0), ("BUCKET_ROWS", 40)):
        monkeypatch.setattr(minhash, name, value)
    for name, value in (("PARTNERS", 3), ("BUCKET_BYTES", 1 << 14)):
        monkeypatch.setattr(pivots, name, value)
    same(result(minhash.near_duplicates(docs).select("doc_id", "size", "component")), want)
    monkeypatch.setattr(minhash, "ROUNDS", 1)
    monkeypatch.setattr(minhash, "DENSE", 10**6)
    same(result(minhash.near_duplicates(docs).select("doc_id", "size", "component")), want)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_pair_a_class_and_round(spark):
    docs = frame(spark, star(spark))
    scheme = minhash.Scheme()
    classes = minhash.document_signatures(docs, scheme, "doc_id", "text").dropDuplicates(["id"])
    met = minhash.band_groups(classes)
    pairs, _ = pivots.pivot_pairs(met, spark.createDataFrame([], "id bigint, label bigint"), None)
    assert pairs.count() == pairs.select("a").distinct().count() <= classes.count()
    # the original shares most bands with the copies, so they choose it
    original = minhash.set_id(common.shingle_sets(*words_of(star(spark)[0][1]), 4)[0])
    assert pairs.where(F.col("b") == original).count() > 0.6 * pairs.count()


def words_of(text):
    import pyarrow as pa

    return common.words(*common.text_bytes(pa.array([text])), lower=True)


# ---- spelling variants ------------------------------------------------------------------

def variants(counts, ratio):
    pattern, near = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            pattern[i, w[:i], w[i + 1 :]].add(w)
            cut = w[:i] + w[i + 1 :]
            if cut in counts:
                near[w].add(cut)
                near[cut].add(w)
    for group in pattern.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return [(w, n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items()]


def random_counts():
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))): rng.choice([1, 2, 9, 60, 400]) for _ in range(500)}
    words.update({"z" * 40: 3, "z" * 41: 90, "z" * 20 + "y" + "z" * 19: 1, "漢字": 7, "漢": 50})
    return words


@pytest.mark.parametrize("setting", [{}, {"filter_bytes": 64}, {"bits_per_word": 1}])
def test_spelling_variants(spark, setting, monkeypatch):
    ship(spark)
    counts = random_counts()
    if setting:  # edits hashed a few at once, and words and letters in several turns
        monkeypatch.setattr(spelling, "EDITS", 50)
        monkeypatch.setattr(spelling, "TASK_WORDS", 90)
        monkeypatch.setattr(spelling, "PART_BLOCKS", 2)
    vocab = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n bigint, near string").select("word", "n")
    found = spelling.variants(vocab, ratio=2, **setting)
    assert found.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    want = variants(counts, 2)
    same(result(found), want)
    assert max(len(w) for w, *_ in want) == 41 and sum(f is not None for *_, f, _, _ in want) > 50
    assert any(r != f for *_, f, _, r in want if f)
    assert spelling.variants(vocab.limit(0)).count() == 0
    assert result(spelling.variants(vocab.where("word = '漢'"))) == [("漢", 50, 0, None, None, "漢")]


def test_filters_hold_every_word_and_few_others():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(3000)})
    codes = spelling.by_length(words)[8][1]
    blocks = spelling.filter_blocks({8: len(words)}, 16, 1 << 20)[8]
    table = spelling.set_bits(spelling.word_hash(codes), blocks, 0, blocks)
    assert len(spelling.probe(table, spelling.word_hash(codes))) == len(words)
    others = spelling.by_length(["".join(rng.choice("ijklmnop") for _ in range(8)) for _ in range(20000)])[8][1]
    assert len(spelling.probe(table, spelling.word_hash(others))) < 200
    assert sum(spelling.filter_blocks({n: 10**6 for n in range(6, 20)}, 16, 1 << 20).values()) * 64 <= 1 << 20


def test_runs(spark, hard, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK_CHARS", 50)
    want = Counter()
    for key, text, *_ in rows_of(hard_rows()):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        want.update((key, w) for w in re.findall("[a-zÀ-ÿ]+", low))
    found = spelling.runs(hard, F.col("doc_id")).groupBy("key", "run").count().collect()
    assert {(r["key"], r["run"]): r["count"] for r in found} == want
    assert max(len(w) for _, w in want) > 1000


def test_vocabulary(spark):
    words = spark.createDataFrame([(w,) for w in ["abcdéf"] * 3 + ["abc"] * 9 + ["abcdefg"] * 2], "word string")
    assert result(spelling.vocabulary(words, 6, 3)) == [("abcdéf", 3)]


# ---- Merkle manifest ------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, more=0):
    key, text, source, lang, n_chars = row
    n_chars = None if n_chars is None else n_chars + more
    said = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (key, source, lang, n_chars, text)]
    return sha("".join(said))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def manifest(rows, tampered):
    def first(v):
        return (v is not None, v if v is not None else 0)

    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (first(r[0]), leaf(r))):
        groups[r[3]].append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subs = {x: tree([leaf(r) for r in groups[x]]) for x in names}
    top = tree([subs[x][-1][0] for x in names])
    out = []
    for at, x in enumerate(names):
        for i, r in enumerate(groups[x]):
            now, proof = leaf(r, 1 if tampered(r) else 0), ""
            for levels, k in ((subs[x], i), (top, at)):
                for level in levels[:-1]:
                    if k ^ 1 < len(level):
                        proof += level[k ^ 1]
                        now = sha(level[k ^ 1] + now if k % 2 else now + level[k ^ 1])
                    else:
                        now = sha(now)
                    k //= 2
            out.append((r[0], leaf(r), subs[x][-1][0], top[-1][0], sha(proof), now, now == top[-1][0]))
    return out


def proofs(docs, levels, task_versions=16384):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    own = merkle.build(
        docs, F.col("lang"), F.col("doc_id"), merkle.row_digest([F.col(c) for c in fields]),
        merkle.row_digest([tampered if c == "n_chars" else F.col(c) for c in fields]), levels, task_versions,
    )
    told = own.proofs()
    said = [F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded_root")]
    return own, told.select("key", *said, "verified")


def is_tampered(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0


@pytest.mark.parametrize("levels", [1, 2, 3, 10])
def test_merkle_manifest(spark, hard, levels):
    rows = rows_of(hard_rows())
    own, found = proofs(hard, levels, 2)
    same(result(found), manifest(rows, is_tampered))
    assert found.where("NOT verified").count() > 5
    # a version copies its ancestors and nothing else
    roots, copied = own.versions()
    assert roots.count() == own.changed.count() == found.where("NOT verified").count()
    height = {r["g"]: merkle.height(r["n"]) for r in own.group_stages[0].select("g", "n").distinct().collect()}
    nodes = sum(r["c"] for c in copied[: len(own.group_stages)] for r in c.groupBy("vg").agg((F.sum(F.length("path")) / 32).alias("c")).collect())
    assert nodes == sum(height[r["g"]] for r in own.changed.collect())


def test_merkle_manifest_of_many_groups_and_of_none(spark):
    rows = [(i, f"t{i}", "s", f"l{i % 9}" if i % 5 else None, i if i % 11 else None) for i in range(60)]
    same(result(proofs(frame(spark, rows), 2)[1]), manifest(rows, is_tampered))
    alone = rows[3:4]
    same(result(proofs(frame(spark, alone), 2)[1]), manifest(alone, is_tampered))
    assert result(proofs(frame(spark, alone), 2)[1])[0][4] == sha("")
    assert proofs(frame(spark, rows).limit(0), 2)[1].count() == 0
