"""A broadcast Bloom filter of a column of 64-bit digests, of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.spelling import BLOCK, PART_BLOCKS, places, set_bits


def digest_filter(digests: DataFrame, column: str, bits_per_value: int = 12, filter_bytes: int = 64 << 20) -> np.ndarray:
    """The filter's words (see ``spelling.probe``) for the values of ``column``.

    Tasks set the bits of one range of blocks each.  More values than
    ``filter_bytes`` has bits for make the filter denser, never larger.
    """
    count = digests.count()
    blocks = max(1, int(min(bits_per_value * count, 8 * filter_bytes)) // (64 * BLOCK))
    out = np.zeros(blocks * BLOCK, np.uint64)
    if not count:
        return out

    def place(batches):
        for batch in batches:
            values = batch.column(0).to_numpy()
            part = places(values.view(np.uint64), blocks)[0] // PART_BLOCKS
            yield pa.record_batch([pa.array(part), batch.column(0)], names=["part", "value"])

    def build(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        first = part * PART_BLOCKS
        made = set_bits(rows["value"].to_numpy().view(np.uint64), blocks, first, min(PART_BLOCKS, blocks - first))
        return pa.table({"part": pa.array([part], pa.int64()), "bits": pa.array([made.tobytes()], pa.binary())})

    placed = digests.select(F.col(column).alias("value")).mapInArrow(place, "part bigint, value bigint")
    for r in placed.groupBy("part").applyInArrow(build, "part bigint, bits binary").toLocalIterator():  # filter_bytes at most
        at = r["part"] * PART_BLOCKS * BLOCK
        bits = np.frombuffer(r["bits"], np.uint64)
        out[at : at + len(bits)] = bits
    return out
