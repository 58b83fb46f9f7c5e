"""Token files: a wavelet matrix per shard, and token access, counting and
occurrence lookup on it.

Documents are put in ascending key order by a range shuffle.  Each task
tokenises its range and closes a shard at the first document end at or after
``shard_tokens`` ids.  A shard is one Parquet file of one row: the documents'
keys and lengths, and the ids as a wavelet matrix, one bit-plane per id bit
with a running count of ones every ``BLOCK`` bits (the rank directory).
Spark writes the files, so any store and lost executors are its concern.

Edge cases: a null or empty text is the end id alone; a very long text is
tokenised whole and makes its shard larger (a document is never split); null
keys come first;
rows with the same key are ordered by a hash of their text; other columns are
ignored; an empty table gives a folder without shards and no documents.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.common import join_small, plain
from riskweave.llm.tokens import encoded_slices, encoder

#: Bits between two entries of a rank directory.
BLOCK = 512
_MAGIC = b"WVM1"
_ONES = np.array([bin(x).count("1") for x in range(256)], np.int64)


def _width(bits: int) -> type:
    return np.uint16 if bits <= 16 else np.uint32


class WaveletMatrix:
    """A sequence of ids below ``2**bits``.

    Layout: magic, n (u64), bits (u32); then for each plane, highest bit
    first: zeros (u64), rank directory (u32 each), packed bits.
    """

    def __init__(self, n: int, zeros: list[int], ranks: list[np.ndarray], planes: list[np.ndarray]) -> None:
        self.n, self.zeros, self.ranks, self.planes, self.bits = n, zeros, ranks, planes, len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        if len(ids) and int(ids.max()) >> bits:
            raise ValueError(f"an id needs more than {bits} bits")
        zeros, ranks, planes = [], [], []
        row = ids.astype(_width(bits))
        for shift in range(bits - 1, -1, -1):
            one = (row & row.dtype.type(1 << shift)).astype(bool)
            packed = np.packbits(one, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8), np.uint8)])
            per_block = _ONES[packed].reshape(-1, BLOCK // 8).sum(axis=1)
            ranks.append(np.concatenate([[0], np.cumsum(per_block)]).astype("<u4"))
            planes.append(packed)
            zeros.append(len(row) - int(np.count_nonzero(one)))
            below = np.empty_like(row)
            np.compress(~one, row, out=below[: zeros[-1]])
            np.compress(one, row, out=below[zeros[-1] :])
            row = below
        return cls(len(ids), zeros, ranks, planes)

    def to_bytes(self) -> bytes:
        parts = [_MAGIC, struct.pack("<QI", self.n, self.bits)]
        for z, r, p in zip(self.zeros, self.ranks, self.planes):
            parts += [struct.pack("<Q", z), r.tobytes(), p.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != _MAGIC:
            raise ValueError("not a wavelet matrix")
        n, bits = struct.unpack_from("<QI", data, 4)
        blocks, at = -(-n // BLOCK), 16
        zeros, ranks, planes = [], [], []
        for _ in range(bits):
            zeros.append(struct.unpack_from("<Q", data, at)[0])
            ranks.append(np.frombuffer(data, "<u4", blocks + 1, at + 8))
            at += 8 + 4 * (blocks + 1)
            planes.append(np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at))
            at += blocks * BLOCK // 8
        return cls(n, zeros, ranks, planes)

    def _bit(self, k: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[k][at >> 3] >> (at & 7).astype(np.uint8)) & 1

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones of plane k before each position."""
        out = self.ranks[k][at // BLOCK].astype(np.int64)
        padded = np.concatenate([self.planes[k], np.zeros(BLOCK // 8, np.uint8)])
        start = at // BLOCK * (BLOCK // 8)
        inside = np.unpackbits(padded[start[:, None] + np.arange(BLOCK // 8)], axis=1, bitorder="little")
        return out + (inside * (np.arange(BLOCK) < (at % BLOCK)[:, None])).sum(axis=1, dtype=np.int64)

    def _select(self, k: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """Position in plane k of the nth (from 0) bit of this value."""
        ones = self.ranks[k].astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = np.searchsorted(before, nth, "right") - 1
        rows = self.planes[k].reshape(-1, BLOCK // 8)[block]
        hits = np.cumsum(np.unpackbits(rows, axis=1, bitorder="little") == bit, axis=1)
        return block * BLOCK + (hits > (nth - before[block])[:, None]).argmax(axis=1)

    def access(self, positions: np.ndarray) -> np.ndarray:
        at = np.asarray(positions, np.int64)
        out = np.zeros(len(at), np.uint32)
        for k in range(self.bits):
            one = self._bit(k, at).astype(bool)
            out = out << np.uint32(1) | one
            ones = self._ones(k, at)
            at = np.where(one, self.zeros[k] + ones, at - ones)
        return out

    def _interval(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences before ``end`` stand below the last plane."""
        if token >> self.bits:
            return 0, 0
        span = np.array([0, end], np.int64)
        for k in range(self.bits):
            ones = self._ones(k, span)
            span = self.zeros[k] + ones if token >> (self.bits - 1 - k) & 1 else span - ones
        return int(span[0]), int(span[1])

    def rank(self, token: int, end: int) -> int:
        """Occurrences of the token before position ``end``."""
        low, high = self._interval(token, end)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, nth: np.ndarray) -> np.ndarray:
        """Positions of the token's nth occurrences (from 0)."""
        at = self._interval(token, self.n)[0] + np.asarray(nth, np.int64)
        for k in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - k) & 1
            at = self._select(k, bit, at - self.zeros[k] if bit else at)
        return at

    def occurrences(self, token: int) -> np.ndarray:
        return self.select(token, np.arange(self.count(token)))

    def decode(self) -> np.ndarray:
        """The whole sequence, undoing the planes from the last to the first."""
        row = np.zeros(self.n, _width(self.bits))
        for k in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            row[self.zeros[k] :] |= row.dtype.type(1 << (self.bits - 1 - k))
            above = np.empty_like(row)
            above[one] = row[self.zeros[k] :]
            above[~one] = row[: self.zeros[k]]
            row = above
        return row


def write_token_shards(
    docs: DataFrame,
    path: str,
    vocabulary_path: str,
    end_id: int = 2,
    shard_tokens: int = 1 << 18,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Tokenise whole texts and write them as wavelet-matrix shards under ``path``."""
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    bits = max(encoder(vocabulary.value).tokenizer.get_vocab_size() - 1, end_id).bit_length()
    rows = docs.select(plain(key).alias("key"), plain(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        keys: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        tokens = 0

        def close() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.concatenate(ids), bits).to_bytes()
            own = pa.concat_arrays(keys)
            listed = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            return pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([tokens], pa.int64()), listed,
                 pa.array([np.concatenate(lengths)], pa.list_(pa.int64())), pa.array([matrix], pa.binary())],
                names=["part", "shard", "n_tokens", "keys", "lengths", "matrix"],
            )

        for slice_, told, counts in encoded_slices(batches, vocabulary.value, 1):
            counts = counts + 1  # with the end id
            ends = np.cumsum(counts)
            every = np.full(int(ends[-1]), end_id, np.uint32)
            inside = np.ones(len(every), bool)
            inside[ends - 1] = False
            every[inside] = told
            begin, done = 0, 0
            while begin < len(counts):
                # up to the first document end at or after the shard's size
                stop = min(len(counts), int(np.searchsorted(ends, done + shard_tokens - tokens)) + 1)
                keys.append(slice_.column(0).slice(begin, stop - begin))
                lengths.append(counts[begin:stop])
                ids.append(every[done : int(ends[stop - 1])])
                tokens += int(ends[stop - 1]) - done
                begin, done = stop, int(ends[stop - 1])
                if tokens >= shard_tokens:
                    yield close()
                    shard, keys, lengths, ids, tokens = shard + 1, [], [], [], 0
        if lengths:
            yield close()

    schema = f"part int, shard int, n_tokens bigint, keys array<{kind}>, lengths array<bigint>, matrix binary"
    # the arrays' own rows are small; one row, one file
    ordered = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    shards = ordered.mapInArrow(run, schema)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``base``, the ids in all shards before each."""
    shards = spark.read.parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    # one row per writing task
    before = parts.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    sizes = shards.select("part", "shard", "n_tokens").join(before, "part")
    within = Window.partitionBy("part").orderBy("shard")
    bases = sizes.select(
        "part", "shard", (F.col("before") + F.sum("n_tokens").over(within) - F.col("n_tokens")).alias("base")
    )
    # a row a shard: broadcast once counted, so the matrices are not shuffled
    return join_small(shards, bases, ["part", "shard"])


def read_documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Every document read back: ``key, start, n_tokens, ids`` (little-endian uint32)."""
    shards = _shards(spark, path).select("base", "keys", "lengths", "matrix")
    kind = shards.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lengths = batch.column(2)[i].values.to_numpy().astype(np.int64)
                ends = np.cumsum(lengths)
                ids = WaveletMatrix.from_bytes(batch.column(3)[i].as_py()).decode().astype("<u4")
                yield pa.record_batch(
                    [
                        batch.column(1)[i].values,
                        pa.array(batch.column(0)[i].as_py() + ends - lengths),
                        pa.array(lengths),
                        pa.array([ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths.tolist())], pa.binary()),
                    ],
                    names=["key", "start", "n_tokens", "ids"],
                )

    return shards.mapInArrow(run, f"key {kind}, start bigint, n_tokens bigint, ids binary").withColumnRenamed("key", key)


def find_token(spark: SparkSession, path: str, token: int, key: str = "doc_id") -> DataFrame:
    """Every occurrence of a token, without decoding the shards: ``key, position``
    (place in the document, from 0)."""
    shards = spark.read.parquet(path).select("keys", "lengths", "matrix")
    kind = shards.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = WaveletMatrix.from_bytes(batch.column(2)[i].as_py()).occurrences(token)
                ends = np.cumsum(batch.column(1)[i].values.to_numpy())
                owner = np.searchsorted(ends, at, "right")
                start = np.concatenate([[0], ends])[owner]
                yield pa.record_batch(
                    [batch.column(0)[i].values.take(pa.array(owner)), pa.array((at - start).astype(np.int64))], names=["key", "position"]
                )

    return shards.mapInArrow(run, f"key {kind}, position bigint").withColumnRenamed("key", key)


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """One row: how often the token occurs in all shards (``n``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([WaveletMatrix.from_bytes(x.as_py()).count(token) for x in batch.column(0)], pa.int64())], names=["n"])

    counts = spark.read.parquet(path).select("matrix").mapInArrow(run, "n bigint")
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
