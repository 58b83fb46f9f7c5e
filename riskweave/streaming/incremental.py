"""The layers applied to a file stream (Structured Streaming).

The batch layers are DataFrame -> DataFrame functions, so the same code
cleanses a stream: new ``orders`` files -> raw claims -> silver claims,
optionally joined with a static silver-customers table (stream-static
join; the static side is re-read every micro-batch, so customer updates
are picked up).  The file sink with a checkpoint is exactly-once, and
``availableNow`` processes everything present, then stops: a restartable
incremental batch.

``trends_stream`` keeps the gold monthly trends up to date: a stateful
streaming aggregation whose state is one row per (month, policy type),
bounded by the calendar, so complete output mode is affordable; each
micro-batch overwrites the gold table with the full result (replaying a
batch writes the same table again).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators.cleanse import silver_claims
from riskweave.operators.enrich import enrich_claims
from riskweave.operators.gold import monthly_trends
from riskweave.sources import versions
from riskweave.sources.fixtures import claims_from


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet file stream with the schema taken from the files present.

    A path naming a single file is turned into a glob on its folder (a file
    stream source lists a folder)."""
    schema = spark.read.parquet(path).schema
    if path.endswith(".parquet"):
        folder, name = path.rsplit("/", 1)
        path = f"{folder}/{re.sub(r'[.]', '[.]', name)}"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def silver_claims_stream(orders: DataFrame) -> DataFrame:
    """Raw orders stream -> silver claims stream (stateless)."""
    return silver_claims(claims_from(orders))


def enriched_stream(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Silver claims stream joined with static silver customers."""
    return enrich_claims(silver_claims_stream(orders), customers)


def write_files(stream: DataFrame, sink_path: str, checkpoint_path: str, fmt: str = "parquet",
                available_now: bool = True) -> StreamingQuery:
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint_path).outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(sink_path)


def run_to_completion(stream: DataFrame, sink_path: str, checkpoint_path: str, fmt: str = "parquet") -> None:
    """Process all available input, then stop (re-running resumes from the
    checkpoint and only reads new files)."""
    q = write_files(stream, sink_path, checkpoint_path, fmt, available_now=True)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def trends_stream(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Gold monthly trends over the enriched claims stream (stateful)."""
    return monthly_trends(enriched_stream(orders, customers))


def run_aggregate_to_table(stream: DataFrame, table_path: str, checkpoint_path: str, fmt: str = "parquet") -> None:
    """Complete-mode aggregate: every micro-batch overwrites ``table_path``
    with the whole current result; process what is available, then stop."""

    def overwrite(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(table_path)

    q = (
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(overwrite)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def run_aggregate_to_versions(stream: DataFrame, path: str, checkpoint_path: str, fmt: str = "parquet", keep: int = 2) -> None:
    """Complete-mode aggregate into a versioned table (``sources.versions``): every
    micro-batch writes the whole result beside the last one under its own
    number, and readers switch when it is complete.  A replayed batch writes
    its own version again; a batch that dies leaves the table as it was."""

    def add(batch: DataFrame, batch_id: int) -> None:
        versions.write_version(batch, path, batch_id, fmt)
        versions.prune(batch.sparkSession, path, keep)

    q = (
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(add)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()
