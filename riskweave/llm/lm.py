"""Stupid-backoff language-model scores against the corpus itself.

The score of a word after its context is count(context word) / count(context)
if that n-gram occurs, else ``backoff`` times the score after the context
without its first word; a single word scores count / all words.  Counts are
over all documents but the scored one (leave one out), so a text does not
vouch for itself; a word that no other document has counts as one occurrence.

Documents are dealt by a hash into blocks of about ``block_words`` words, and
cross the shuffle as compressed parcels of one block's texts.  A block sends
each of its distinct n-grams (all orders, 64-bit hashes) with its count to the
n-gram's hash bucket, as entropy-coded steps from one to the next.  A bucket
adds up the counts of all blocks -- its part of the n-gram count tables -- and
joins the totals back to the blocks' n-grams.  A block then looks up its
documents' n-grams, takes off each document's own counts and sums the scores
per document.  An n-gram that
every document has crosses the shuffle once a block, and what is gathered
grows with the corpus.  The words of a bucket or block are bounded by
``bucket_grams`` and ``block_words`` (a longer single text is a block).

Edge cases: a null or empty text has 0 words, score 0 and a null perplexity; a
very long text is scored whole, alone in its block if need be;
repeated rows are documents each, so a copy vouches for the other; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import (
    pack_numbers, plain, slices, squeeze_numbers, squeezed_numbers, text_bytes, text_sizes, unpack_numbers, windows, words,
)

#: Bytes of text that a task holds to make parcels of.
PARCEL_BYTES = 32 << 20
#: Under this name a block sends its number of words.
_ALL = np.uint64(0)


def _block_words(own: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a block's texts and each text's bounds."""
    hashes, bounds, n = [], [np.zeros(1, np.int64)], 0
    for sizes, texts in zip(own["sizes"], own["texts"]):
        offsets = np.concatenate([[0], np.cumsum(unpack_numbers(sizes.as_py()).astype(np.int64))])
        data = pa.decompress(texts.as_buffer(), int(offsets[-1]), "zstd") if offsets[-1] else b""
        h, b = words(np.frombuffer(data, np.uint8), offsets)
        hashes.append(h)
        bounds.append(b[1:] + n)
        n += len(h)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.concatenate(bounds)


def _parcels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, text, block`` as compressed parcels of rows of one block."""

    def parcel(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).sort_by("block").combine_chunks()
        block = rows["block"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        sizes, texts = [], []
        for a, b in zip(edges, edges[1:]):
            data, offsets = text_bytes(rows["text"].slice(a, b - a).combine_chunks())
            sizes.append(pack_numbers(np.diff(offsets)))
            texts.append(pa.compress(data, "zstd", asbytes=True))
        keys = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rows["key"].combine_chunks())
        columns = [pa.array(block[edges[:-1]]), keys, pa.array(sizes, pa.binary()), pa.array(texts, pa.binary())]
        return pa.record_batch(columns, names=["block", "keys", "sizes", "texts"])

    held, size = [], 0
    for batch in batches:
        for i, j in slices(text_sizes(batch.column("text")), PARCEL_BYTES):
            part = batch.slice(i, j - i)
            of_part = int(text_sizes(part.column("text")).sum()) + 16 * part.num_rows
            if held and size + of_part > PARCEL_BYTES:
                yield parcel(held)
                held, size = [], 0
            held.append(part)
            size += of_part
    if held:
        yield parcel(held)


def _grams(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams inside each text, and the word each ends at."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    every = windows(hashes, n)
    inside = np.flatnonzero(owner[: len(every)] == owner[n - 1 :]) if len(every) else np.zeros(0, np.int64)
    return every[inside], inside + n - 1


def _distinct(hashes: np.ndarray, bounds: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The block's n-grams of all orders, sorted, with their counts."""
    every = [_grams(hashes, bounds, n)[0] for n in range(1, order + 1)]
    found, count = np.unique(np.concatenate(every), return_counts=True)
    return np.concatenate([[_ALL], found]), np.concatenate([[len(hashes)], count])


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    return (((grams >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _lowest(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """A number that no gram of the bucket is below."""
    return (bucket.astype(np.uint64) << np.uint64(32)) // np.uint64(buckets) << np.uint64(32)


def _own_counts(owner: np.ndarray, gram: np.ndarray, size: int) -> np.ndarray:
    """How often each (document, gram) pair occurs, at every occurrence."""
    pair = owner * np.int64(size) + gram
    _, back, count = np.unique(pair, return_inverse=True, return_counts=True)
    return count[back]


def backoff_scores(
    hashes: np.ndarray, bounds: np.ndarray, grams: np.ndarray, totals: np.ndarray, order: int, backoff: float
) -> np.ndarray:
    """Natural log of every word's score, given the corpus totals of the block's n-grams."""
    n_words = len(hashes)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    others = np.zeros((order + 1, n_words), np.int64)  # by order and last word: occurrences in other documents
    others[0] = totals[0] - np.diff(bounds)[owner]
    for n in range(1, order + 1):
        found, last = _grams(hashes, bounds, n)
        at = np.searchsorted(grams[1:], found) + 1
        others[n, last] = totals[at] - _own_counts(owner[last], at, len(grams))
    score = np.log(np.maximum(others[1], 1)) - np.log(np.maximum(others[0], 1))
    for n in range(2, order + 1):
        seen = np.flatnonzero(others[n] > 0)
        score += math.log(backoff)
        score[seen] = np.log(others[n, seen]) - np.log(others[n - 1, seen - 1])
    # a word too near its text's start has no such context: nothing to back off from
    place = np.arange(n_words) - bounds[owner] if n_words else np.zeros(0, np.int64)
    for n in range(2, order + 1):
        short = place < n - 1
        score[short] -= math.log(backoff)
    return score


def score_documents(
    docs: DataFrame,
    order: int = 2,
    backoff: float = 0.4,
    block_words: int = 2_000_000,
    bucket_grams: int = 2_000_000,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, n_words, log_score`` (natural log, summed over words) and ``perplexity``."""
    rows = docs.select(plain(key).alias("key"), plain(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    # a word takes 6 characters or so; only the number of blocks and buckets comes of it
    about = (rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0) / 6
    blocks = max(1, math.ceil(about / block_words))
    buckets = max(1, math.ceil(about * order / bucket_grams))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", F.xxhash64("text")), F.lit(blocks)))
    dealt = dealt.mapInArrow(_parcels, f"block bigint, keys array<{kind}>, sizes binary, texts binary")

    def send(table: pa.Table) -> pa.Table:
        grams, count = _distinct(*_block_words(table), order)
        to = _bucket(grams, buckets)
        edges = [0, *(np.flatnonzero(np.diff(to)) + 1).tolist(), len(to)]
        low = _lowest(to[edges[:-1]], buckets)
        spans = list(zip(edges, edges[1:], low))
        block = table["block"][0].as_py()
        return pa.table(
            {
                "block": pa.array([block] * len(spans), pa.int64()),
                "bucket": pa.array(to[edges[:-1]], pa.int64()),
                # sorted, so the steps between them are shorter
                "grams": pa.array([squeeze_numbers(np.diff(grams[a:b], prepend=first)) for a, b, first in spans], pa.binary()),
                "counts": pa.array([squeeze_numbers(count[a:b]) for a, b, _ in spans], pa.binary()),
            }
        )

    def add_up(table: pa.Table) -> pa.Table:
        low = _lowest(table["bucket"].to_numpy()[:1], buckets)
        parts = [low + np.cumsum(squeezed_numbers(x.as_py()), dtype=np.uint64) for x in table["grams"]]
        counts = [squeezed_numbers(x.as_py()) for x in table["counts"]]
        found, back = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(back, weights=np.concatenate(counts), minlength=len(found)).astype(np.uint64)[back]
        ends = np.cumsum([len(x) for x in parts])[:-1]
        return pa.table(
            {
                "block": table["block"],
                "bucket": table["bucket"],
                "totals": pa.array([squeeze_numbers(x) for x in np.split(totals, ends)], pa.binary()),
            }
        )

    def score(own: pa.Table, told: pa.Table) -> pa.Table:
        hashes, bounds = _block_words(own)
        grams, _ = _distinct(hashes, bounds, order)
        told = told.sort_by("bucket")
        totals = np.concatenate([squeezed_numbers(x.as_py()) for x in told["totals"]]).astype(np.int64)
        scores = np.concatenate([[0.0], np.cumsum(backoff_scores(hashes, bounds, grams, totals, order, backoff))])
        n = np.diff(bounds)
        total = np.where(n > 0, scores[bounds[1:]] - scores[bounds[:-1]], 0.0)
        return pa.table({"key": pc.list_flatten(own["keys"]), "n_words": pa.array(n.astype(np.int64)), "log_score": pa.array(total)})

    sent = dealt.groupBy("block").applyInArrow(send, "block bigint, bucket bigint, grams binary, counts binary")
    told = sent.groupBy("bucket").applyInArrow(add_up, "block bigint, bucket bigint, totals binary")
    scored = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(score, f"key {kind}, n_words bigint, log_score double")
    return scored.select(
        F.col("key").alias(key),
        "n_words",
        "log_score",
        F.when(F.col("n_words") > 0, F.exp(-F.col("log_score") / F.col("n_words"))).alias("perplexity"),
    )
