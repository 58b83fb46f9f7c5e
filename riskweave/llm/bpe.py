"""Byte-level BPE encoding and decoding with numpy matrices.

Every piece of text that the split pattern gives is encoded on its own.  The
distinct pieces of a batch are dealt into buckets by length and laid out as
padded id matrices.  In each round every row merges its leftmost pair of
minimum rank; pairs are looked up in an open-addressing hash table, and rows
are compacted after the merge.  A row leaves when no pair is known.

Edge cases: a null or empty text has no ids and decodes to no bytes; texts
of any length are processed whole (one unbroken piece above ``LONG_PIECE``
bytes is merged in the same order with a heap instead of a matrix, since a
row's rounds grow with its length); repeated rows give repeated results;
columns other than the key and the text are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import SLICE_BYTES, plain, slices, text_sizes

#: Pieces above this many bytes are merged with a heap.
LONG_PIECE = 512
#: Cells of one padded matrix.
MATRIX_CELLS = 1 << 18
#: Distinct pieces that a worker remembers before it starts afresh.
CACHE_PIECES = 300_000

_EMPTY = np.uint64(2**64 - 1)
_NONE = np.int64(1) << 40


class PairTable:
    """(left id, right id) -> rank of the merged token, by open addressing."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 2.5).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, _EMPTY, np.uint64)
        self.ranks = np.full(size, _NONE, np.int64)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == _EMPTY
            where, first = np.unique(slot[free], return_index=True)
            took = np.flatnonzero(free)[first]
            self.keys[where], self.ranks[where] = keys[took], ranks[took]
            left = np.ones(len(keys), bool)
            left[took] = False
            keys, ranks, slot = keys[left], ranks[left], (slot[left] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != _EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % len(self.keys)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (found != _EMPTY)]
        return out


class ByteBPE:
    def __init__(self, rank_file: bytes, pattern: str) -> None:
        import regex

        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        size = max(self.ranks.values()) + 1
        self.vocabulary = [b""] * size
        for token, rank in self.ranks.items():
            self.vocabulary[rank] = token
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            ((self.ranks[t[:i]] << 32) | self.ranks[t[i:]], r)
            for t, r in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        self.pairs = PairTable(np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.int64))
        # white space as Unicode has it, without the separators 1C-1F that Python adds
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.known: dict[str, bytes] = {}

    def merge_rows(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of like length, all rows merging side by side."""
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        inside = np.arange(width) < lengths[:, None]
        ids = np.full((len(pieces), width), 0xFFFFFFFF, np.int64)
        ids[inside] = self.byte_id[flat]
        rank = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        row = np.arange(len(pieces))
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(pieces)
        while True:
            if rank.shape[1]:
                at = rank.argmin(axis=1)  # the leftmost of the smallest
                best = rank[np.arange(len(row)), at]
                done = best == _NONE
            else:
                done = np.ones(len(row), bool)
            for k in np.flatnonzero(done).tolist():
                out[row[k]] = ids[k, : lengths[k]]
            if done.all():
                return out
            if done.any():
                go = ~done
                ids, rank, row, lengths, at, best = ids[go], rank[go], row[go], lengths[go], at[go], best[go]
            n = np.arange(len(row))
            ids[n, at] = best
            lengths = lengths - 1
            keep = int(lengths.max())
            # compaction: the right half of each merged pair and its rank go
            column = np.arange(keep)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            column = column[: keep - 1]
            rank = np.take_along_axis(rank, column + (column >= at[:, None]), axis=1)
            for near in (at - 1, at):
                ok = (near >= 0) & (near + 1 < lengths)
                rank[n[ok], near[ok]] = self.pairs.find(ids[n[ok], near[ok]], ids[n[ok], near[ok] + 1])
            if keep > 1:
                rank[column >= (lengths - 1)[:, None]] = _NONE

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one very long piece: pairs in a heap by (rank, place)."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        vocabulary, ranks = self.vocabulary, self.ranks
        alive = [True] * n
        heap = [
            (r, i, a, b)
            for i, (a, b) in enumerate(zip(ids, ids[1:]))
            if (r := ranks.get(vocabulary[a] + vocabulary[b])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i] = r
            alive[j] = False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := ranks.get(vocabulary[r] + vocabulary[ids[k]])) is not None:
                    heapq.heappush(heap, (x, i, r, ids[k]))
            if (h := before[i]) >= 0 and (x := ranks.get(vocabulary[ids[h]] + vocabulary[r])) is not None:
                heapq.heappush(heap, (x, h, ids[h], r))
        return np.array([x for x, on in zip(ids, alive) if on], np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(piece) > LONG_PIECE:
                out[k] = self.merge_long(piece).astype("<u4").tobytes()
            else:
                buckets.setdefault((len(piece) + 1).bit_length(), []).append(k)
        for bits, members in buckets.items():
            step = max(1, MATRIX_CELLS >> bits)
            for i in range(0, len(members), step):
                part = members[i : i + step]
                for k, ids in zip(part, self.merge_rows([pieces[x] for x in part])):
                    out[k] = ids.astype("<u4").tobytes()
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self.split.findall(t) if t else [] for t in texts]
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        new = list({p for pieces in split for p in pieces if p not in self.known})
        self.known.update(zip(new, self.encode_pieces([p.encode() for p in new])))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[str, ByteBPE] = {}


def _load(rank_file: bytes, pattern: str) -> ByteBPE:
    key = hashlib.sha256(rank_file + pattern.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = ByteBPE(rank_file, pattern)
    return _loaded[key]


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens`` and ``ids`` (binary, little-endian uint32) of every whole text.

    ``rank_path`` is read on the driver and broadcast: its size is that of the
    vocabulary, whatever the input.
    """
    rows = docs.select(plain(key).alias("key"), plain(text).alias("text"))
    with open(rank_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _load(ranks.value, pattern)
        for batch in batches:
            for i, j in slices(text_sizes(batch.column(1)), SLICE_BYTES):
                ids = bpe.encode(batch.column(1).slice(i, j - i).to_pylist())
                yield pa.record_batch(
                    [batch.column(0).slice(i, j - i), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["key", "n_tokens", "ids"],
                )

    schema = f"key {rows.schema['key'].dataType.simpleString()}, n_tokens bigint, ids binary"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, rank_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a binary column ``decoded``: the bytes of its ids (null: no bytes)."""
    with open(rank_path, "rb") as f:
        ranks = encoded.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("binary")
    def decoded(column):  # noqa: ANN001, ANN202
        bpe = _load(ranks.value, pattern)
        return column.map(lambda x: bpe.decode(x) if x is not None else b"")

    return encoded.withColumn("decoded", decoded(plain(ids)))
