"""Helpers shared by the corpus operators: staging, Arrow slices, word hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import scratch_dir

#: Bytes of text that a task works on at once inside one Arrow batch.
SLICE_BYTES = 2 << 20
#: Bytes hashed at once; a longer text is cut between words.
HASH_BYTES = 1 << 20
#: Shuffle partitions that one file of a staged table takes: of rows of a few numbers, of wider rows.
NARROW, WIDE = 32, 8

# fixed values: the separators of a word, [\x20\x09-\x0D]
SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
SEPARATOR_CLASS = r"[\x20\x09-\x0D]"


def in_few_files(df: DataFrame, per_file: int) -> DataFrame:
    """``df`` with its partitions put together, ``per_file`` shuffle partitions in one,
    so that a small table is not written as thousands of tiny files.

    Nothing is shuffled.  The number of files grows with the shuffle partitions,
    and every core keeps a task (of wide rows four).
    """
    spark = df.sparkSession
    cores, partitions = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(NARROW * cores, partitions) // per_file)


def staged(df: DataFrame, name: str, per_file: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage and freezes values that a second evaluation could give
    differently (generated ids); the files outlive any executor.  With
    ``per_file`` the files are few (``in_few_files``): on a local file system Hadoop
    starts processes for every file it makes, out of the executor's JVM.
    """
    path = scratch_dir(df.sparkSession, name)
    df = df if per_file is None else in_few_files(df, per_file)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def plain(column: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + column.replace("`", "``") + "`")


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` in total (one row at least)."""
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield i, j
        i = j


def text_sizes(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text (null: 0)."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in one array, and offsets (null: an empty text)."""
    sizes = text_sizes(column)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    parts = [x.as_buffer() for x in column.cast(pa.large_binary()) if x.is_valid]
    return np.frombuffer(b"".join(parts), np.uint8), offsets


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SEPARATOR = np.isin(np.arange(256), np.frombuffer(SEPARATORS, np.uint8))
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(0, 2**61)) * 8 + 5
_powers: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _powers.clear()
        for b in (_BASE, inverse):
            factors = np.full(n + 1, b, np.uint64)
            factors[0] = 1
            _powers.append(np.cumprod(factors, dtype=np.uint64))
    return _powers[0], _powers[1]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` and the word bounds of each text.

    A word's hash is a polynomial over random values of its bytes, taken from
    running sums, so no Python code runs per word; it does not depend on where
    the word stands.  Returns (hashes, bounds): text k has words
    ``bounds[k]:bounds[k+1]``.
    """
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    out_hash, out_start = [], []
    at = 0
    while at < n:
        end = min(n, at + HASH_BYTES)
        if end < n and not first[end]:
            cut = np.flatnonzero(_IS_SEPARATOR[data[at:end]] | first[at + 1 : end + 1])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:  # one word longer than HASH_BYTES: take all of it
                while end < n and not first[end] and not _IS_SEPARATOR[data[end]]:
                    end += 1
        part = data[at:end]
        if lower:
            part = _LOWER[part]
        inside = ~_IS_SEPARATOR[part]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[at + 1 : end]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | first[at + 1 : end]
        start, stop = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        power, inverse = _base_powers(max(len(part), HASH_BYTES))
        run = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[: len(part)], out=run[1:])
        h = (run[stop] - run[start]) * inverse[start]
        out_hash.append(mix64(h + (stop - start).astype(np.uint64)))
        out_start.append(start + at)
        at = end
    hashes = np.concatenate(out_hash) if out_hash else np.zeros(0, np.uint64)
    starts = np.concatenate(out_start) if out_start else np.zeros(0, np.int64)
    return hashes, np.searchsorted(starts, offsets)


def pack_numbers(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as the largest needs, byte plane
    by byte plane, so that the shuffle's compression finds the empty planes."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def squeeze_numbers(values: np.ndarray) -> bytes:
    """Like ``pack_numbers``, with the two highest byte planes entropy-coded:
    the steps between sorted hashes differ there only in size, counts are mostly 1."""
    packed = pack_numbers(values)
    width, n = packed[0], len(values)
    planes = [packed[1 + k * n : 1 + (k + 1) * n] for k in range(width)]
    top = [pa.compress(x, "zstd", asbytes=True) for x in planes[-2:]]
    return np.array([n, width, *map(len, top)], "<u4").tobytes() + b"".join([*planes[:-2], *top])


def squeezed_numbers(data: bytes) -> np.ndarray:
    n, width = np.frombuffer(data, "<u4", 2).tolist()
    coded = min(2, width)
    lengths = np.frombuffer(data, "<u4", coded, 8).tolist()
    at = 8 + 4 * coded
    planes = [data[at : at + (width - coded) * n]]
    at += (width - coded) * n
    for length in lengths:
        planes.append(pa.decompress(data[at : at + length], n, "zstd", asbytes=True))
        at += length
    return unpack_numbers(bytes([width]) + b"".join(planes))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (texts not kept apart)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    m = len(hashes) - n + 1
    out = np.full(m, n, np.uint64)
    for k in range(n):
        out = out * _STEP + hashes[k : k + m]
    return mix64(out)


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct n-word shingle hashes of each text; a text with fewer
    words has its whole word sequence as one, without words none."""
    every = windows(hashes, n)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            sets.append(np.unique(every[a : b - n + 1]))
        else:
            sets.append(windows(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return sets


def join_small(rows: DataFrame, small: DataFrame, on: list[str], how: str = "inner", max_rows: int = 1_000_000) -> DataFrame:
    """Null-safe equi-join with a table that is small as a rule.

    ``small`` is staged and counted: up to ``max_rows`` rows of a few numbers
    each it is broadcast, beyond that the join is a shuffle join whose skewed
    partitions AQE splits.  The rows are the same either way.
    """
    small = staged(small.select(*[plain(c).alias(f"_{c}") if c in on else plain(c) for c in small.columns]), "small", NARROW)
    if small.count() <= max_rows:
        small = F.broadcast(small)
    match = [plain(c).eqNullSafe(plain(f"_{c}")) for c in on]
    condition = match[0]
    for m in match[1:]:
        condition = condition & m
    return rows.join(small, condition, how).drop(*[f"_{c}" for c in on])
