"""Spelling variants of a vocabulary by Bloom-guided edit neighbourhoods.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  Every word's neighbourhood is generated as hashes only: its
deletions, and its replacements by greater letters, so that each unordered
pair is met from exactly one side (an insertion is the other word's deletion).
A hash is a polynomial of the code points, so an edit's hash comes from the
word's by a few numpy operations, for all positions and letters at once.

The hashes are probed against broadcast blocked Bloom filters, one per word
length (a block is 64 bytes, an edit touches one block).  Tasks build the
filters block range by block range.  ``filter_bytes`` bounds all filters
together: a vocabulary that would need more gets denser filters, so more
edits pass, never a larger broadcast.  Only edits that pass are written out as
words and shuffled to an exact join with the vocabulary, which removes false
positives; the result does not depend on the filters.

A word's form is its near word of largest count if that count is ``ratio``
times its own or more; ties go to the smallest in code-point order.  Counts
grow by ``ratio`` along a chain of forms, so it is short and has no cycle; the
roots are found by pointer jumping.

Edge cases: a null or empty text has no words; a text longer than
``CHUNK_CHARS`` is cut between runs before its words are listed; repeated rows
are counted each; a vocabulary of one word or none has no near pairs; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import mix64, plain, staged

#: Letters of a run, lower case; A-Z are folded before.
LETTERS = "a-zÀ-ÿ"
#: Longer texts are cut between runs.
CHUNK_CHARS = 1 << 20
#: Edits hashed at once in a task.
EDITS = 1 << 20
#: Words whose neighbourhoods a task generates.
TASK_WORDS = 20_000
#: 64-bit words of a filter block, and bits set for a word in its block.
BLOCK, PROBES = 8, 7
#: Blocks that a task builds at once (1 MiB).
PART_BLOCKS = 1 << 14

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def runs(docs: DataFrame, key: Column, text: str = "text") -> DataFrame:
    """``key, run`` of every occurrence of a run of letters, A-Z in lower case."""
    low = F.translate(plain(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = F.lit(rf"((?s).{{1,{CHUNK_CHARS}}}(?![{LETTERS}])|[{LETTERS}]+)")
    chunks = F.when(F.length("text") > CHUNK_CHARS, F.regexp_extract_all("text", cut, F.lit(1))).otherwise(F.array("text"))
    pieces = docs.select(key.alias("key"), low.alias("text")).where("text IS NOT NULL").select("key", F.explode(chunks).alias("text"))
    return pieces.select("key", F.explode(F.regexp_extract_all("text", F.lit(f"([{LETTERS}]+)"), F.lit(1))).alias("run"))


def vocabulary(words: DataFrame, min_chars: int, min_count: int) -> DataFrame:
    """``word, n`` of the words (a row an occurrence) that are long and frequent enough."""
    long = words.where(F.length("word") >= min_chars)
    return staged(long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count), "spelling-words")


# ---- hashes -----------------------------------------------------------------

def letter_hash(codes: np.ndarray) -> np.ndarray:
    return mix64(codes.astype(np.uint64) + np.uint64(0x51ED270B))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (_BASE, _INVERSE):
        factors = np.full(n + 1, b, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


def word_hash(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of code points (words of one length)."""
    return (letter_hash(codes) * powers(codes.shape[1])[0][: codes.shape[1]]).sum(axis=1, dtype=np.uint64)


def by_length(words: list[str]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (row numbers, code points)."""
    size = np.array([len(w) for w in words], np.int64)
    out = {}
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        flat = "".join([words[i] for i in at]).encode("utf-32-le")
        out[n] = at, np.frombuffer(flat, "<u4").reshape(len(at), n)
    return out


# ---- filters ------------------------------------------------------------------

def places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Each hash's block, and the bits that choose its places there."""
    mixed = mix64(hashes)
    block = ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    return block.astype(np.int64), mix64(mixed + np.uint64(1))


def set_bits(hashes: np.ndarray, blocks: int, first: int, count: int) -> np.ndarray:
    """The filter blocks ``first`` to ``first + count`` with these words set."""
    block, bits = places(hashes, blocks)
    out = np.zeros(count * BLOCK, np.uint64)
    for k in range(PROBES):
        p = (bits >> np.uint64(9 * k)) & np.uint64(511)
        np.bitwise_or.at(out, (block - first) * BLOCK + (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))
    return out


def probe(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Positions of the hashes that the filter may hold."""
    block, bits = places(hashes, len(table) // BLOCK)
    at = np.arange(len(hashes))
    for k in range(PROBES):
        p = (bits[at] >> np.uint64(9 * k)) & np.uint64(511)
        word = table[block[at] * BLOCK + (p >> np.uint64(6)).astype(np.int64)]
        at = at[(word >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)]
    return at


def filter_blocks(counts: dict[int, int], bits_per_word: int, filter_bytes: int) -> dict[int, int]:
    """Blocks of each length's filter; all together at most ``filter_bytes`` (a block a length at least)."""
    bits = min(bits_per_word, 8 * filter_bytes / max(1, sum(counts.values())))
    return {n: max(1, int(c * bits) // (64 * BLOCK)) for n, c in counts.items()}


def filters(vocab: DataFrame, bits_per_word: int, filter_bytes: int) -> dict[int, np.ndarray]:
    """length -> filter of the vocabulary's words of that length."""
    counts = {r["size"]: r["c"] for r in vocab.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("c")).collect()}
    blocks = filter_blocks(counts, bits_per_word, filter_bytes)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, (_, codes) in by_length(batch.column(0).to_pylist()).items():
                hashes = word_hash(codes)
                part = places(hashes, blocks[n])[0] // PART_BLOCKS
                yield pa.record_batch(
                    [pa.array(np.full(len(part), n, np.int32)), pa.array(part), pa.array(hashes.view(np.int64))], names=["size", "part", "hash"]
                )

    def build(rows: pa.Table) -> pa.Table:
        n, part = rows["size"][0].as_py(), rows["part"][0].as_py()
        first = part * PART_BLOCKS
        made = set_bits(rows["hash"].to_numpy().view(np.uint64), blocks[n], first, min(PART_BLOCKS, blocks[n] - first))
        return pa.table({"size": pa.array([n], pa.int32()), "part": pa.array([part], pa.int64()), "bits": pa.array([made.tobytes()], pa.binary())})

    hashed = vocab.select("word").mapInArrow(spell, "size int, part bigint, hash bigint")
    made = hashed.groupBy("size", "part").applyInArrow(build, "size int, part bigint, bits binary")
    out = {n: np.zeros(b * BLOCK, np.uint64) for n, b in blocks.items()}
    for r in made.toLocalIterator():  # filter_bytes at most
        at = r["part"] * PART_BLOCKS * BLOCK
        bits = np.frombuffer(r["bits"], np.uint64)
        out[r["size"]][at : at + len(bits)] = bits
    return out


# ---- near pairs -----------------------------------------------------------------

def deletions(codes: np.ndarray, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes without the code point at each position, and which are the first of equal ones."""
    power, inverse = powers(codes.shape[1])
    terms = letter_hash(codes) * power[: codes.shape[1]]
    sums = np.cumsum(terms, axis=1, dtype=np.uint64)
    behind = (sums[:, -1:] - sums[:, first:end]) * inverse[1]
    new = np.ones((len(codes), end - first), bool)
    low = max(first, 1)
    new[:, low - first :] = codes[:, low:end] != codes[:, low - 1 : end - 1]
    return sums[:, first:end] - terms[:, first:end] + behind, new


def replacements(codes: np.ndarray, letters: np.ndarray, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes with each letter at each position, and which letters are greater than the one there."""
    power = powers(codes.shape[1])[0][first:end]
    own = codes[:, first:end, None]
    change = (letter_hash(letters)[None, None, :] - letter_hash(own)) * power[None, :, None]
    return word_hash(codes)[:, None, None] + change, letters[None, None, :] > own


def candidates(words: list[str], letters: np.ndarray, tables: dict[int, np.ndarray]) -> Iterator[tuple[int, str]]:
    """(row number, edit) of every edit that passes its length's filter."""
    for n, (rows, codes) in by_length(words).items():
        span = max(1, min(n, EDITS // max(1, len(letters))))  # positions at once
        many = max(1, EDITS // (span * max(1, len(letters))))  # words at once
        for a in range(0, len(rows), many):
            part = codes[a : a + many]
            for first in range(0, n, span):
                end = min(n, first + span)
                if n - 1 in tables:
                    hashes, new = deletions(part, first, end)
                    flat = np.flatnonzero(new)
                    for k in flat[probe(tables[n - 1], hashes.ravel()[flat])].tolist():
                        i, p = divmod(k, end - first)
                        w = words[rows[a + i]]
                        yield int(rows[a + i]), w[: first + p] + w[first + p + 1 :]
                hashes, greater = replacements(part, letters, first, end)
                flat = np.flatnonzero(greater)
                for k in flat[probe(tables[n], hashes.ravel()[flat])].tolist():
                    i, p = divmod(k, (end - first) * len(letters))
                    p, c = divmod(p, len(letters))
                    w = words[rows[a + i]]
                    yield int(rows[a + i]), w[: first + p] + chr(letters[c]) + w[first + p + 1 :]


def near_pairs(vocab: DataFrame, bits_per_word: int = 16, filter_bytes: int = 64 << 20) -> DataFrame:
    """``word, n, near, near_n``: every pair of near words, both ways round."""
    sc = vocab.sparkSession.sparkContext
    own = vocab.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in own.collect()), np.uint32)  # code points that occur
    told = sc.broadcast((alphabet, filters(vocab, bits_per_word, filter_bytes)))

    def guided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, tables = told.value
        for batch in batches:
            found = list(candidates(batch.column(0).to_pylist(), letters, tables))
            at = pa.array([i for i, _ in found], pa.int64())
            yield pa.record_batch(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([w for _, w in found], pa.string())],
                names=["word", "n", "edit"],
            )

    # a fixed number of words a task, however few files the vocabulary has
    spread = vocab.repartition(max(sc.defaultParallelism, -(-vocab.count() // TASK_WORDS)), "word")
    positive = spread.mapInArrow(guided, "word string, n bigint, edit string")
    known = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = staged(positive.join(known, F.col("edit") == F.col("near")).select("word", "n", "near", "near_n"), "spelling-pairs")
    back = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form (``word, form``), by pointer jumping."""
    now = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        jumped = now.join(ahead, F.col("root") == F.col("at"), "left")
        jumped = staged(jumped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if jumped.where("moved").isEmpty():
            return jumped.select("word", "root")
        now = jumped.select("word", "root")


def variants(vocab: DataFrame, ratio: int = 5, bits_per_word: int = 16, filter_bytes: int = 64 << 20) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the vocabulary ``word, n``."""
    first = F.min(F.struct((-F.col("near_n")).alias("k"), F.col("near").alias("near")))
    best = near_pairs(vocab, bits_per_word, filter_bytes).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("b"))
    best = best.select(F.col("word").alias("w"), "n_near", F.col("b.near").alias("near"), (-F.col("b.k")).alias("near_n"))
    strong = F.col("near_n") >= ratio * F.col("n")
    told = vocab.join(best, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("near")).alias("form"), F.when(strong, F.col("near_n")).alias("form_n")
    )
    told = staged(told, "spelling-forms")
    ends = roots(told.where("form IS NOT NULL")).select(F.col("word").alias("w"), "root")
    out = told.join(ends, F.col("word") == F.col("w"), "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
