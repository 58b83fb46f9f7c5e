"""The word encoder against the tokenizers library, on texts made to be hard."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskweave.llm import packing, tokens, wavelet
from riskweave.llm.ship import ship
from riskweave.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = [
    "a", "b", "Z", "don't", "'s", "'", "''ll", "1", "23", "٣", "é", "É", "é", "́", "ß", "×", "÷", "Ã", "漢", "字", "Σας", "İ", "K", "ﬁ", " ", "　",
    "‍", "😀", "!", "...", "--", "<", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "endoftext", " ", " ", " ", "\n", "\t", "\x0b", "\x0c", "\r",
    "\x1c", "\x85", "\x00", "w" * 30, "&", "#", "ñ", "ÿ", "À", "﻿",
]
SPECIAL = [
    "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "x <|startoftext|>", "<|endoftext|>.", "<|ENDOFTEXT|> x", "<|endoftext|", "Q<|endoftext|>,",
]


def ids_of(encoder, texts):
    flat, counts = encoder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    return [flat[e - n : e].tolist() for e, n in zip(ends.tolist(), counts.tolist())]


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


def hard_texts(seed, n=400):
    rng = random.Random(seed)
    return [None, "", " \n", *SPECIAL, *["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 25))) for _ in range(n)]]


def library(texts):
    return [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_ids_equal_the_library(vocabulary):
    assert 49407 in LIBRARY.encode("a <|endoftext|> b", add_special_tokens=False).ids
    encoder = tokens.WordEncoder(vocabulary)
    for seed in range(6):  # later texts find what earlier ones taught
        texts = hard_texts(seed)
        for text, got, want in zip(texts, ids_of(encoder, texts), library(texts)):
            assert got == want, repr(text)


def test_units_of_one_hash_are_told_apart(vocabulary, monkeypatch):
    texts = hard_texts(11, 60)
    whole = tokens.span_hashes
    monkeypatch.setattr(tokens, "span_hashes", lambda *x: whole(*x) % np.uint64(7))
    assert ids_of(tokens.WordEncoder(vocabulary), texts) == library(texts)


def test_memory_is_bounded_in_bytes(vocabulary, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 3 << 20)
    rng, encoder, most = random.Random(3), tokens.WordEncoder(vocabulary), 0
    for _ in range(12):
        texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(8000))]
        assert ids_of(encoder, texts) == library(texts)
        most = max(most, encoder.nbytes)
    assert most < 6 << 20


def test_word_table():
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(0, 2**63, 300_000).astype(np.uint64) * np.uint64(2))
    hashes[:5000] = np.sort(hashes[:5000] >> np.uint64(30))  # a crowd at one end of the table
    hashes = np.unique(hashes)
    table, shuffled = tokens.WordTable(4), rng.permutation(hashes)
    for part in np.array_split(shuffled, 7):
        assert (table.find(part) == -1).all()
        table.add(part)
    assert (table.find(shuffled) == np.arange(len(shuffled))).all()
    assert (table.find(hashes + np.uint64(1)) == np.where(np.isin(hashes + np.uint64(1), hashes), table.find(hashes + np.uint64(1)), -1)).all()


def test_units_end_at_texts_and_long_units_are_hashed_whole(monkeypatch):
    monkeypatch.setattr(tokens, "HASH_BYTES", 16)
    tokens._powers.__defaults__[0].clear()
    texts = ["ab", "cd1 é!", None, "x" * 100, "it's A-b", ""]
    data, offsets = tokens.text_bytes(pa.array(texts))
    folded, start, stop = tokens.units(data, offsets)
    cut = [bytes(folded[a:b]).decode() for a, b in zip(start, stop)]
    assert cut == ["ab", "cd", "1", "é", "!", "x" * 100, "it's", "a", "-", "b"]
    own = tokens.span_hashes(folded, start, stop)
    again = [tokens.span_hashes(np.frombuffer(x.encode(), np.uint8), np.array([0]), np.array([len(x.encode())]))[0] for x in cut]
    assert own.tolist() == [int(x) for x in again]
    tokens._powers.__defaults__[0].clear()


def test_packing_and_token_files_of_special_strings(spark):
    ship(spark)
    texts = hard_texts(21, 40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    want = {i: ids for i, ids in enumerate(library(texts))}
    pieces = packing.pack_documents(docs, PATH, capacity=8, outputs={"ids": F.col("ids")}).orderBy("doc_id", "piece").collect()
    got = {}
    for r in pieces:
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert got == {i: [*ids, 1] for i, ids in want.items()}
    path = scratch_dir(spark, "special")
    wavelet.write_token_shards(docs, path, PATH, shard_tokens=50)
    read = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in wavelet.read_documents(spark, path).collect()}
    assert read == {i: [*ids, 2] for i, ids in want.items()}
