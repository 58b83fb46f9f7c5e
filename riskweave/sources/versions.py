"""Tables that are replaced without a gap: write beside, then switch.

A versioned table is a folder of numbered versions.  A version is written
whole beside the others, and Spark's own commit marks it complete (the
``_SUCCESS`` file of its job); readers take the newest complete one.  A write
that dies leaves an incomplete version that nobody reads, and the table as it
was.  Older versions stay until ``prune`` removes them, so a reader that has
listed its files can finish.

``replace_view`` is the same for a catalog: the name is a view on the newest
version's files, and altering a view is one metastore operation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PREFIX = "version="


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str, complete: bool = True) -> list[int]:
    """Numbers of the table's versions, oldest first."""
    place, fs = _folder(spark, path)
    if not fs.exists(place):
        return []
    found = []
    for status in fs.listStatus(place):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(PREFIX) and name[len(PREFIX) :].isdigit():
            done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if not complete or fs.exists(done):
                found.append(int(name[len(PREFIX) :]))
    return sorted(found)


def location(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{PREFIX}{number:08d}"


def write_version(df: DataFrame, path: str, number: int | None = None, fmt: str = "parquet") -> int:
    """Write the rows as the table's next version (or as ``number``, again if it was
    written before, as a stream's replayed batch is); returns its number."""
    spark = df.sparkSession
    if number is None:
        number = max(versions(spark, path, complete=False), default=-1) + 1
    # Spark drops the old marker with the folder, so a version that is written again is incomplete meanwhile
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").format(fmt).save(location(path, number))
    return number


def read_version(spark: SparkSession, path: str, number: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The newest complete version (or the one named)."""
    known = versions(spark, path)
    if number is None and known:
        number = known[-1]
    if number is None or number not in known:
        raise FileNotFoundError(f"{path} has no complete version" + ("" if number is None else f" {number}"))
    return spark.read.format(fmt).load(location(path, number))


def prune(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` complete versions, and incomplete ones older than those."""
    done = versions(spark, path)
    last = done[-keep:] if keep else []
    gone = [n for n in versions(spark, path, complete=False) if last and n < last[0]]
    for n in gone:
        place, fs = _folder(spark, location(path, n))
        fs.delete(place, True)
    return gone


def replace_view(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> int:
    """Point the catalog view ``name`` at the newest complete version."""
    number = versions(spark, path)[-1]
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{location(path, number)}`")
    return number
