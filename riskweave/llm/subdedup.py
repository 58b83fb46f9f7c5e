"""Removal of repeated passages by unit hashing.

A text is cut into units: lines, and in a line sentences (or lines or
paragraphs alone).  Units are normalised (case, white space) and hashed to 64
bits.  A unit is a repeat if it stands earlier in its own text, or in a
document with a smaller id.  Runs of consecutive repeats of at least
``min_words`` words are removed; shorter ones (a stock sentence) stay.
Sentences are the default because a repeated passage seldom fills whole
lines.  The spans removed are given in code points of the original text.

With ``sure_words`` the partial units at the ends of a passage count too: every
word inside a window of ``min_words`` words (case folded) that stands earlier
goes, wherever sentences end.  Windows are compared around repeated window
hashes picked by winnowing, which has one in every run of ``sure_words`` words;
so a shared run of that length is found even if no unit of it is whole, and its
ends are exact to the word.  A shorter run is found if it has a picked window
or is of whole units.  In one text, equal windows that overlap (one word over and
over) are left to the units.

Of equal texts the one with the smallest id stands for all, and the others are
told before from end to end.  Every other text is hashed once and has each
distinct digest once.  The earliest
document of a digest is a partial minimum, so a passage that a third of all
documents share is pre-aggregated; the join back to the digests, which only
rows of shared digests reach, is skew-split by AQE.

Edge cases: a text of any length is hashed and cut whole; a null text stays null and an empty one empty, without spans;
rows with the same id count as one document, and a null id ranks last;
repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.bloom import digest_filter
from riskweave.llm.common import NARROW, SLICE_BYTES, WIDE, join_small, plain, slices, staged, text_bytes, text_sizes, windows, words
from riskweave.llm.spelling import probe

#: Where a unit ends.
UNIT_ENDS = {
    "sentence": re.compile(r"[.!?](?=[\x20\x09-\x0D])|\n"),
    "line": re.compile(r"\n"),
    "paragraph": re.compile(r"\n[\x20\x09\x0B-\x0D]*\n"),
}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def units(text: str, unit: str) -> list[tuple[int, int, int, int]]:
    """(start, end, words, signed 64-bit digest) of every unit that has a word."""
    out = []
    start = 0
    for end in [*(m.end() for m in UNIT_ENDS[unit].finditer(text)), len(text)]:
        words = text[start:end].lower().split()
        if words:
            digest = xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
            out.append((start, end, len(words), digest - (1 << 64) if digest >> 63 else digest))
        start = end
    return out


def text_windows(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The hashes of every text's n-word windows, in order, case folded."""
    hashes, bounds = words(*text_bytes(pa.array([x and x.lower() for x in texts], pa.string())))
    every = windows(hashes, n).view(np.int64)
    return [every[a : max(a, b - n + 1)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def picked(own: np.ndarray, w: int) -> np.ndarray:
    """Winnowing: the places that are least in some ``w`` consecutive windows."""
    if len(own) < w:
        return np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(own, w).min(1)
    edge = np.full(w - 1, np.iinfo(np.int64).min)
    most = np.lib.stride_tricks.sliding_window_view(np.concatenate([edge, least, edge]), w).max(1)
    return np.flatnonzero(most == own)


def near_shared(own: np.ndarray, shared: np.ndarray, w: int) -> np.ndarray:
    """The distinct windows less than ``w`` places from a shared picked one: between
    two picks, or a pick and the end of a run, there are no more."""
    at = np.flatnonzero(np.isin(own, shared))
    edges = np.zeros(len(own) + 1, np.int64)
    np.add.at(edges, np.maximum(at - w + 1, 0), 1)
    np.add.at(edges, np.minimum(at + w, len(own)), -1)
    return np.unique(own[np.cumsum(edges[:-1]) > 0])


def window_spans(text: str, own: np.ndarray, earlier: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(start, end) of the runs of words inside windows that stand earlier, here or in ``earlier``."""
    again = np.isin(own, earlier) if len(earlier) else np.zeros(len(own), bool)
    # a window that overlaps an equal one is one word or phrase over and over, no passage told again
    order = np.argsort(own, kind="stable")
    same, gap = own[order][1:] == own[order][:-1], np.diff(order)
    looped = own[order][1:][same & (gap < n)]
    later = np.zeros(len(own), bool)
    later[order[1:][same]] = True
    at = np.flatnonzero(again | (later & ~np.isin(own, looped)))
    if not len(at):
        return []
    edges = np.zeros(len(own) + n, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + n, -1)
    gone = np.diff((np.cumsum(edges) > 0).astype(np.int8), prepend=0)
    found = [(m.start(), m.end()) for m in WORD.finditer(text)]
    out = []
    for a, b in zip(np.flatnonzero(gone == 1).tolist(), np.flatnonzero(gone == -1).tolist()):
        start = found[a][0]
        while start and text[start - 1] in " \t":
            start -= 1
        out.append((start, found[b - 1][1]))
    return out


def cut(
    text: str, own: list[tuple[int, int, int, int]], repeats: set[int], min_words: int, more: list[tuple[int, int]] | None = None
) -> tuple[str, list[tuple[int, int]]]:
    """The text without long runs of repeats and ``more`` (start, end), and the spans (start, length) that went."""
    gone: list[tuple[int, int]] = list(more or ())
    seen: set[int] = set()
    run: list[int] = []  # start, end, words

    def close() -> None:
        if run and run[2] >= min_words:
            gone.append((run[0], run[1]))
        run.clear()

    for start, end, n, digest in own:
        if digest in repeats or digest in seen:
            run[:] = [run[0], end, run[2] + n] if run else [start, end, n]
        else:
            close()
        seen.add(digest)
    close()
    kept, spans, at = [], [], 0
    for start, end in sorted(gone):
        if spans and start < at:
            spans[-1] = (spans[-1][0], max(at, end) - spans[-1][0])
        else:
            kept.append(text[at:start])
            spans.append((start, end - start))
        at = max(at, end)
    return "".join([*kept, text[at:]]), spans


def firsts(found: DataFrame) -> DataFrame:
    """``digest, first``: the smallest id of every digest that several ids have."""
    return (
        found.groupBy("digest")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count_if(F.col("id").isNull()).alias("nulls"))
        .where((F.col("first") != F.col("last")) | (F.col("first").isNotNull() & (F.col("nulls") > 0)))
        .select("digest", "first")
    )


def filtered(found: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows whose ``digest`` may be one of ``shared``, by a broadcast Bloom
    filter, so that the others are not shuffled to the join."""
    told = found.sparkSession.sparkContext.broadcast(digest_filter(shared, "digest"))
    at = found.columns.index("digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(probe(told.value, batch.column(at).to_numpy().view(np.uint64))))

    return found.mapInArrow(run, found.schema)


def copies(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, tie`` of the texts that a smaller id tells in the same words: all of such a text is told before."""
    told = docs.where(plain(text) != "").select(plain(key).alias("id"), F.xxhash64(plain(text)).alias("tie"), F.xxhash64(plain(text), F.lit(7)).alias("proof")).distinct()
    order = F.struct(F.col("id").isNull().alias("none"), "id")
    first = told.groupBy("tie", "proof").agg(F.min(order).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("tie").alias("_t"), F.col("proof").alias("_p"), F.col("f.id").alias("first"))
    again = told.join(first, (F.col("tie") == F.col("_t")) & (F.col("proof") == F.col("_p")))
    return staged(again.where(~F.col("id").eqNullSafe(F.col("first"))).select("id", "tie"), "copies")


def marked_documents(docs: DataFrame, unit: str, key: str, text: str, min_words: int, sure_words: int | None) -> DataFrame:
    """``_id, _tie, digests, windows, copy`` of the texts that may have repeats:
    the digests, and with ``sure_words`` the windows, that a smaller id has as
    well.  A text is also named, with none, if it repeats itself.  Copies of a
    text take no part but are named as such: the first of them stands for all.

    Every other text is hashed once, into a staged table; the digests that several
    ids have are found from it, and only rows with such a digest (and the few
    that a Bloom filter lets through) are shuffled to the join with them.
    """
    rows = docs.select(plain(key).alias("id"), F.xxhash64(plain(text)).alias("tie"), plain(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    w = sure_words - min_words + 1 if sure_words else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(text_sizes(batch.column(2)), SLICE_BYTES):
                part = batch.slice(i, j - i)
                owner, digests, picks = [], [], []
                texts = part.column(2).to_pylist()
                own_windows = text_windows(texts, min_words) if w else None
                for k, x in enumerate(texts):
                    if not x:
                        continue
                    every = [u[3] for u in units(x, unit)]
                    own = set(every)
                    some = np.unique(own_windows[k][picked(own_windows[k], w)]).tolist() if w else []
                    again = len(own) < len(every) or (w and len(np.unique(own_windows[k])) < len(own_windows[k]))
                    digests += [*own, *some, *([None] if again else [])]
                    picks += [False] * len(own) + [True] * len(some) + [False] * bool(again)
                    owner += [k] * (len(own) + len(some) + bool(again))
                at = pa.array(np.array(owner, np.int64))
                yield pa.record_batch(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(digests, pa.int64()), pa.array(picks, pa.bool_())],
                    names=["id", "tie", "digest", "pick"],
                )

    def run_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(text_sizes(batch.column(2)), SLICE_BYTES):
                part = batch.slice(i, j - i)
                texts = part.column(2).to_pylist()
                told = zip(text_windows(texts, min_words), part.column(3))
                near = [near_shared(own, s.values.to_numpy(), w) for own, s in told]
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(near, pa.list_(pa.int64()))], names=["id", "tie", "near"]
                )

    again = copies(docs, key, text)
    rows = join_small(rows, again, ["id", "tie"], "left_anti")
    hashed = staged(rows.mapInArrow(run, f"id {kind}, tie bigint, digest bigint, pick boolean"), "digests")
    alone = hashed.where("digest IS NULL").select("id", "tie").distinct()  # texts that repeat themselves
    found = hashed.where("digest IS NOT NULL")
    known = staged(firsts(found), "firsts", NARROW)
    met = filtered(found, known).join(known, "digest")
    later = F.when(~F.col("pick") & ~F.col("id").eqNullSafe(F.col("first")), F.col("digest"))
    marked = met.groupBy("id", "tie").agg(F.collect_set(later).alias("digests"), F.collect_set(F.when(F.col("pick"), F.col("digest"))).alias("shared"))
    none = F.array().cast("array<bigint>")
    marked = marked.unionByName(alone.select("id", "tie", none.alias("digests"), none.alias("shared")))
    marked = marked.groupBy("id", "tie").agg(F.flatten(F.collect_list("digests")).alias("digests"), F.flatten(F.collect_list("shared")).alias("shared"))
    marked = staged(marked, "shared", WIDE)
    named = marked.withColumnsRenamed({"id": "_id", "tie": "_tie"})
    nothing = F.lit(None).cast("array<bigint>")
    told_before = again.select(F.col("id").alias("_id"), F.col("tie").alias("_tie"), nothing.alias("digests"), nothing.alias("windows"), F.lit(True).alias("copy"))
    if not w:
        return named.select("_id", "_tie", "digests", nothing.alias("windows"), F.lit(False).alias("copy")).unionByName(told_before)
    # rows told twice are marked once, and their windows are the same
    told = named.where(F.size("shared") > 0).select("_id", "_tie", "shared")
    texts = rows.join(told, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))).select("id", "tie", "text", "shared")
    near = staged(texts.mapInArrow(run_windows, f"id {kind}, tie bigint, near array<bigint>"), "windows", WIDE)
    each = near.select("id", "tie", F.explode("near").alias("digest"))
    earlier = each.join(firsts(each), "digest").where(~F.col("id").eqNullSafe(F.col("first")))
    earlier = earlier.groupBy("id", "tie").agg(F.collect_set("digest").alias("windows"))
    both = named.join(earlier, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left")
    return both.select("_id", "_tie", "digests", "windows", F.lit(False).alias("copy")).unionByName(told_before)


def remove_repeats(
    docs: DataFrame,
    unit: str = "sentence",
    min_words: int = 20,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
    sure_words: int | None = None,
) -> DataFrame:
    """``key``, other columns named in ``keep``, ``text`` without repeats, and
    ``spans``: start and length of what went, in code points of the original."""
    columns = [c for c in (keep or []) if c not in (key, text)]
    found = marked_documents(docs, unit, key, text, min_words, sure_words)
    w = sure_words - min_words + 1 if sure_words else 0
    # by position: no column of the caller's meets one of ours, and a mapped table's names must not hold dots
    rows = docs.select(
        plain(key).alias("c0"), *[plain(c).alias(f"c{i + 1}") for i, c in enumerate(columns)], plain(text).alias("text"),
        F.xxhash64(plain(text)).alias("tie"),
    )
    joined = rows.join(found, F.col("c0").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left")
    at = len(columns) + 1
    joined = joined.select(*[f"c{i}" for i in range(at)], "text", "digests", "windows", "copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            for i, j in slices(text_sizes(batch.column(at)), SLICE_BYTES):
                part = batch.slice(i, j - i)
                texts, spans = part.column(at).to_pylist(), [[] for _ in range(j - i)]
                touched = np.flatnonzero(part.column(at + 3).is_valid().to_numpy(zero_copy_only=False)).tolist()  # the others have no repeat
                own = text_windows([texts[k] for k in touched], min_words) if sure_words else None
                for n, k in enumerate(touched):
                    x, more = texts[k], None
                    if not x:
                        continue
                    mine, copy = units(x, unit), part.column(at + 3)[k].as_py()
                    if sure_words:
                        earlier = (own[n] if len(own[n]) >= w else own[n][:0]) if copy else np.array(part.column(at + 2)[k].as_py() or (), np.int64)
                        more = window_spans(x, own[n], earlier, min_words)
                    digests = {u[3] for u in mine} if copy else set(part.column(at + 1)[k].as_py() or ())
                    texts[k], gone = cut(x, mine, digests, min_words, more)
                    spans[k] = [{"start": a, "length": m} for a, m in gone]
                yield pa.record_batch(
                    [*part.columns[:at], pa.array(texts, pa.string()), pa.array(spans, span)],
                    names=[*part.schema.names[:at], "text", "spans"],
                )

    schema = ", ".join(f"`{n}` {t}" for n, t in joined.dtypes[: at + 1])
    cut_ = joined.mapInArrow(run, f"{schema}, spans array<struct<start:bigint,length:bigint>>")
    return cut_.toDF(key, *columns, text, "spans")
