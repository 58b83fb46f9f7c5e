"""Vector best-fit packing of tokenised documents into fixed-length sequences.

A document's ids end with an end id; only a document longer than the capacity
is cut, into capacity-long pieces and a rest.  A sequence has three limits:
tokens, documents and attention cost (the sum of the squared piece lengths,
as with attention inside each document).  Pieces are placed longest first; of
the open sequences that hold the piece under every limit, the rule selects
one: ``norm`` leaves the smallest weighted norm of what remains, ``dot`` has
the largest weighted cosine between demand and remainder.

Full pieces are sequences of their own.  The others are dealt by a hash into
groups of about ``group_pieces`` and each group is packed by one task from
(id, length) alone, so no task's work grows with the input; a group wastes
about one sequence.  Ids and lengths are staged once, so a task that is run
again packs the same pieces.

Edge cases: a null or empty text is a document of the end id alone; a very
long text is tokenised whole and cut into pieces; repeated rows are packed each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import plain, staged
from riskweave.llm.tokens import encoded_slices

#: Bytes of text that a worker encodes at once, beside its ids as bytes.
ENCODE_BYTES = 512 << 10


def tokenised_pieces(docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, piece, start, length, ids`` of every document (ids: little-endian uint32)."""
    rows = docs.select(plain(key).alias("key"), plain(text).alias("text"))
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, counts in encoded_slices(batches, vocabulary.value, 1, ENCODE_BYTES):
            # every text's ids with the end id behind them, as bytes
            ends = np.cumsum(counts + 1)
            every = np.full(int(ends[-1]), end_id, "<u4")
            inside = np.ones(len(every), bool)
            inside[ends - 1] = False
            every[inside] = ids
            raw, pieces = every.tobytes(), -(-(counts + 1) // capacity)
            owner = np.repeat(np.arange(len(counts)), pieces)
            piece = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)).astype(np.int32)
            start = piece.astype(np.int64) * capacity
            length = np.minimum(capacity, (counts + 1)[owner] - start)
            first = (ends - counts - 1)[owner] + start
            yield pa.record_batch(
                [
                    part.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(piece),
                    pa.array(start),
                    pa.array(length),
                    pa.array([raw[4 * a : 4 * (a + n)] for a, n in zip(first.tolist(), length.tolist())], pa.binary()),
                ],
                names=["key", "piece", "start", "length", "ids"],
            )

    schema = f"key {rows.schema['key'].dataType.simpleString()}, piece int, start bigint, length bigint, ids binary"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def best_fit(
    lengths: np.ndarray,
    capacity: int,
    max_documents: int,
    max_attention: int,
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """(first piece of the sequence, offset in it) of every piece; ties go to
    the longer, then the earlier piece, and to the earlier sequence."""
    order = np.argsort(-lengths, kind="stable")
    limits = np.array([capacity, max_documents, max_attention], float)
    least = int(lengths.min()) if len(lengths) else 0
    rest = np.zeros((1024, 3))  # what remains of each open sequence, in units
    first = np.zeros(1024, np.int64)
    n = 0
    opener, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    weight = np.array(weights)
    for i in order.tolist():
        length = int(lengths[i])
        need = np.array([length, 1, length * length], float)
        free = rest[:n]
        fits = np.flatnonzero((free[:, 0] >= length) & (free[:, 1] >= 1) & (free[:, 2] >= need[2]))
        if len(fits):
            open_ = free[fits] / limits
            demand = need / limits
            if rule == "norm":
                at = fits[int(((open_ - demand) ** 2 @ weight).argmin())]
            else:
                size = np.sqrt(open_**2 @ weight)
                at = fits[int(((open_ * demand) @ weight / np.maximum(size, 1e-300)).argmax())]
        else:
            if n == len(rest):
                rest, first = np.concatenate([rest, np.zeros_like(rest)]), np.concatenate([first, np.zeros_like(first)])
            at, n = n, n + 1
            rest[at], first[at] = limits, i
        opener[i], offset[i] = first[at], capacity - int(rest[at, 0])
        rest[at] -= need
        if rest[at, 0] < least or rest[at, 1] < 1 or rest[at, 2] < least * least:  # nothing fits any more
            n -= 1
            rest[at : n], first[at : n] = rest[at + 1 : n + 1].copy(), first[at + 1 : n + 1].copy()
    return opener, offset


def assign(
    pieces: DataFrame,
    capacity: int,
    max_documents: int,
    max_attention: int,
    group_pieces: int,
    weights: tuple[float, float, float],
    rule: str,
) -> DataFrame:
    """``uid, sequence_id, offset`` for pieces with ``uid`` and ``length``; a
    sequence's id is the uid of its first piece."""
    whole = pieces.where(F.col("length") >= capacity).select(
        "uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.where(F.col("length") < capacity).select("uid", "length")
    groups = max(1, -(-rest.count() // group_pieces))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("uid", ignore_index=True)
        uid = group["uid"].to_numpy()
        opener, offset = best_fit(group["length"].to_numpy(), capacity, max_documents, max_attention, weights, rule)
        return pd.DataFrame({"uid": uid, "sequence_id": uid[opener], "offset": offset})

    dealt = rest.withColumn("group", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInPandas(pack, "uid bigint, sequence_id bigint, offset bigint")
    return whole.unionByName(packed)


def pack_documents(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int = 1,
    capacity: int = 4096,
    max_documents: int | None = None,
    max_attention: int | None = None,
    group_pieces: int = 16384,
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1),
    rule: str = "norm",
    outputs: Mapping[str, Column] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per piece: ``key, piece, start, length``, ``outputs``, ``sequence_id, offset``.

    ``outputs`` are columns derived from a piece (default: its ``ids``); they
    are taken before the join with the places, so only they travel.  Left
    out, ``max_documents`` and ``max_attention`` are the values that the
    capacity implies (one-token documents; one full-length document).
    """
    outputs = {"ids": F.col("ids")} if outputs is None else outputs
    pieces = staged(
        tokenised_pieces(docs, vocabulary_path, end_id, capacity, key, text).withColumn("uid", F.monotonically_increasing_id()),
        "pieces",
    )
    places = assign(
        pieces, capacity, max_documents or capacity, max_attention or capacity * capacity, group_pieces, weights, rule
    )
    told = pieces.select("uid", plain(key), "piece", "start", "length", *[c.alias(n) for n, c in outputs.items()])
    return told.join(places, "uid").drop("uid")
