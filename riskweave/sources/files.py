"""File scans and table sinks (bronze loads, layer tables, audit history)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """CSV scan.  Give ``schema`` in production: inference costs a second
    pass over the files.  ``infer_schema=True`` reproduces a header-and-infer
    load for exploration."""
    reader = spark.read.option("header", header).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_by_name(spark: SparkSession, path: str, schema: StructType | str, malformed: str = "error") -> DataFrame:
    """CSV scan that finds the columns of ``schema`` by their header names.

    Other columns follow as strings, in file order.  A missing column is an
    error, and so is a file whose header differs from the first one's.  A
    value that does not parse raises when it is read (``malformed="error"``)
    or is NULL (``"null"``); blank values are NULL.
    """
    if malformed not in ("error", "null"):
        raise ValueError("malformed is 'error' or 'null'")
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.option("header", True).csv(path).columns
    by_name = {c.strip().lower(): c for c in header}
    missing = [f.name for f in wanted if f.name.lower() not in by_name]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {header}")
    text = StructType([StructField(c, StringType()) for c in header])
    rows = spark.read.option("header", True).option("enforceSchema", False).schema(text).csv(path)
    columns = []
    for f in wanted:
        raw = F.col("`" + by_name[f.name.lower()].replace("`", "``") + "`")
        raw = F.when(F.trim(raw) != "", raw)
        value = raw.try_cast(f.dataType)
        if malformed == "error":
            said = F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), raw)
            value = F.when(raw.isNotNull() & value.isNull(), F.raise_error(said).cast(f.dataType)).otherwise(value)
        columns.append(value.alias(f.name))
    used = {by_name[f.name.lower()] for f in wanted}
    return rows.select(*columns, *[F.col("`" + c.replace("`", "``") + "`") for c in header if c not in used])


#: Name of the text column that holds a row whose number of fields is wrong.
MALFORMED = "_malformed"


def split_csv(spark: SparkSession, path: str, schema: StructType | str, out: str, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """One CSV scan that parts the rows into (accepted, rejected), stored under ``out``.

    Columns are found by their header names, as in ``read_csv_by_name``.  A row
    is rejected if it has too few or too many fields, a value that is not of
    its column's type, or no value in a ``required`` column; blank values are
    NULL.  Accepted rows have the columns of ``schema``; rejected ones ``raw``
    (the fields as read, as JSON) and ``rejects``, all of the row's faults with
    column, reason and value.  Both come from one job that writes the rows
    partitioned by their fate, so they add up to the file.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.option("header", True).csv(path).columns
    by_name = {c.strip().lower(): c for c in header}
    missing = [f.name for f in wanted if f.name.lower() not in by_name]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {header}")
    text = StructType([*[StructField(c, StringType()) for c in header], StructField(MALFORMED, StringType())])
    rows = (
        spark.read.option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", MALFORMED).schema(text).csv(path)
    )
    none = F.lit(None).cast("struct<column string, reason string, value string>")

    def fault(name: str | None, reason: str, value: Column) -> Column:
        return F.struct(F.lit(name).cast("string").alias("column"), F.lit(reason).alias("reason"), value.alias("value"))

    ragged = F.col(MALFORMED).isNotNull()
    values, faults = [], [F.when(ragged, fault(None, "number of fields", F.col(MALFORMED))).otherwise(none)]
    for f in wanted:
        raw = F.col("`" + by_name[f.name.lower()].replace("`", "``") + "`")
        raw = F.when(F.trim(raw) != "", raw)
        value = raw.try_cast(f.dataType)
        values.append(value.alias(f.name))
        said = fault(f.name, f"not {f.dataType.simpleString()}", raw)
        wrong = F.when(raw.isNotNull() & value.isNull(), said)
        if f.name in required:
            wrong = wrong.when(raw.isNull(), fault(f.name, "no value", raw))
        faults.append(F.when(~ragged, wrong.otherwise(none)).otherwise(none))
    found = F.filter(F.array(*faults), lambda x: x.isNotNull())
    raw = F.to_json(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in header]))
    parted = rows.select(*values, raw.alias("raw"), found.alias("rejects")).withColumn("accepted", F.size("rejects") == 0)
    parted.write.mode("overwrite").partitionBy("accepted").parquet(out)
    # a fate that no row has leaves no folder: both sides are read with the known schema
    kept = spark.read.schema(parted.schema).parquet(out)
    accepted = kept.where(F.col("accepted")).select(*[f.name for f in wanted])
    return accepted, kept.where(~F.col("accepted")).select("raw", "rejects")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a path-based table when ``path`` is given."""
    if path:
        return spark.read.format(fmt).load(path)
    return spark.table(name)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")


# Table formats whose catalogs implement the V2 create-or-replace/append API
# (their jars must be on the classpath); file formats use saveAsTable.
V2_FORMATS = ("iceberg", "delta")


def write_table(
    df: DataFrame,
    name: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Create-or-replace a table from a DataFrame (one Spark job).

    With ``path`` the table is a folder of ``fmt`` files; with ``name`` it is
    a catalog table.  Writing the layer is also what cuts lineage between
    layers: the next layer reads the stored files, not the plan above them.
    """
    if name and not path and fmt in V2_FORMATS and mode == "overwrite":
        v2 = df.writeTo(name).using(fmt)
        if partition_by:
            v2 = v2.partitionedBy(*[F.col(c) for c in partition_by])
        v2.createOrReplace()
        return
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w.save(path)
    elif name:
        w.saveAsTable(name)
    else:
        raise ValueError("give a table name or a path")


def append_table(
    df: DataFrame,
    name: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> None:
    """Append, creating the table on first use.

    With ``partition_by`` set and dynamic partition overwrite, re-running the
    same partition (e.g. one execution id) replaces it instead of adding a
    second copy, so a retried job stays idempotent.
    """
    spark = df.sparkSession
    if name and not path:
        if spark.catalog.tableExists(name):
            if fmt in V2_FORMATS:
                if partition_by:
                    df.writeTo(name).overwritePartitions()
                else:
                    df.writeTo(name).append()
                return
            if partition_by:
                overwrite_partitions(df, name, partition_by)
            else:
                df.write.mode("append").format(fmt).saveAsTable(name)
            return
        write_table(df, name=name, fmt=fmt, partition_by=partition_by, mode="overwrite")
        return
    if partition_by:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .format(fmt)
            .partitionBy(*partition_by)
            .save(path)
        )
    else:
        df.write.mode("append").format(fmt).save(path)


def overwrite_partitions(df: DataFrame, name: str, partition_by: list[str]) -> None:
    """Replace those partitions of a catalog table that ``df`` has rows of, in one statement.

    Dynamic partition overwrite is a setting, not an option of the write; it is
    set in a session of its own that shares the catalog, so the caller's mode
    stays as it is, also for writes that run meanwhile.
    """
    spark = df.sparkSession
    table = name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"
    cols = [c for c in spark.table(table).columns if c not in partition_by]
    view = f"rw_part_{uuid.uuid4().hex}"
    df.select(*cols, *partition_by).createGlobalTempView(view)
    try:
        own = spark.newSession()
        own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        listed = ", ".join(f"`{c}`" for c in [*cols, *partition_by])
        own.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({', '.join(f'`{c}`' for c in partition_by)}) SELECT {listed} FROM global_temp.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)


def _sql_literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def overwrite_partition(df: DataFrame, name: str, column: str, value) -> None:
    """Replace one partition of a catalog table with ``df``'s rows.

    A static partition spec replaces exactly that partition whatever the
    session's partition-overwrite mode, so other runs' rows are never
    touched and a retried run replaces its own rows instead of doubling them.
    """
    spark = df.sparkSession
    cols = [c for c in spark.table(name).columns if c != column]
    view = f"rw_part_{uuid.uuid4().hex}"
    df.select(*cols).createOrReplaceTempView(view)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({column} = {_sql_literal(value)}) "
            f"SELECT {', '.join(f'`{c}`' for c in cols)} FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Table names of a database (the current one when not given)."""
    return [t.name for t in spark.catalog.listTables(database)]


def list_databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]
