"""Line dedup by site-relative frequency.

For every host the pages that contain a line (once or more often, white space
at its ends aside) are divided by the host's pages; lines above ``ratio`` are
boilerplate and leave every page of that host.  Lines are compared by a
64-bit hash within their host.  Hosts of fewer than ``min_pages`` pages have
no boilerplate.  With ``distinct`` copies of a text count as one page of their
host, and a line must stand on ``min_line_pages`` pages, so that a document
told several times does not become boilerplate.

The counts are partial sums before any shuffle, so a line on every page of a
hot host is cheap.  A host has at most (mean distinct lines a page / ratio)
such lines; the per-host lists are counted before they are broadcast, and
beyond the limit the pages are shuffled by host with AQE's skew split.

Edge cases: a null text stays null with 0 lines; a very long text is split
whole, its lines as an array of one row; a line on exactly the allowed share
of pages stays; a null host is a host of its own; lines without a word are
never dropped; a page whose every line goes has an empty text; repeated rows
are pages each; kept columns keep their values, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import SEPARATORS, join_small, plain, staged

_BLANKS = SEPARATORS.decode()


def line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANKS))


def boilerplate(
    pages: DataFrame, ratio: float, min_pages: int, host: str, text: str, distinct: bool = False, min_line_pages: int = 1
) -> DataFrame:
    """``host, lines``: the hashes of the lines that each host repeats too often."""
    rows = pages.select(plain(host).alias("host"), plain(text).alias("text"))
    copied = F.lit(None).cast("long")
    totals = rows.groupBy("host").agg(F.count("*").alias("pages"))
    if distinct:
        rows = rows.withColumn("tie", F.xxhash64("text"))
        texts = rows.groupBy("host", "tie").agg(F.count("*").alias("copies"))
        totals = texts.groupBy("host").agg(F.count("*").alias("pages"))
        # only the texts that a host has twice or more are told apart below
        rows = join_small(rows, texts.where(F.col("copies") > 1), ["host", "tie"], "left")
        copied = F.when(F.col("copies") > 1, F.col("tie"))
    keys = F.transform(F.split("text", "\n"), line_key)
    each = F.explode(F.array_distinct(F.filter(keys, lambda k: k != "")))
    lines = rows.select("host", copied.alias("copied"), each.alias("line"))
    counts = lines.groupBy("host", F.xxhash64("line").alias("line"), "copied").agg(F.count("*").alias("n"))
    n = F.sum(F.when(F.col("copied").isNull(), F.col("n")).otherwise(1))
    counts = counts.groupBy("host", "line").agg(n.alias("n")).where(F.col("n") >= min_line_pages)
    totals = totals.where(F.col("pages") >= min_pages)
    often = join_small(counts, totals, ["host"]).where(F.col("n") > F.col("pages") * F.lit(ratio))
    return often.groupBy("host").agg(F.collect_set("line").alias("lines"))


def drop_boilerplate(
    pages: DataFrame,
    ratio: float = 0.1,
    min_pages: int = 10,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    keep: list[str] | None = None,
    max_broadcast_lines: int = 1_000_000,
    distinct: bool = False,
    min_line_pages: int = 1,
) -> DataFrame:
    """``key``, other columns named in ``keep``, ``text`` without boilerplate lines, ``n_lines``, ``n_dropped``."""
    columns = [c for c in (keep or []) if c not in (key, text)]
    found = staged(boilerplate(pages, ratio, min_pages, host, text, distinct, min_line_pages), "boilerplate").withColumnRenamed("host", "_host")
    size = found.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0)).alias("n")).first()["n"]
    # by position, so that no column of the caller's meets one of ours
    rows = pages.select(
        plain(key).alias("_key"), plain(host).alias("_own"), plain(text).alias("_text"), *[plain(c).alias(f"_c{i}") for i, c in enumerate(columns)]
    )
    joined = rows.join(
        F.broadcast(found) if size <= max_broadcast_lines else found, F.col("_own").eqNullSafe(F.col("_host")), "left"
    )
    lines = F.split("_text", "\n")
    kept = F.filter(lines, lambda x: (line_key(x) == "") | ~F.array_contains("lines", F.xxhash64(line_key(x))))
    joined = joined.withColumn("_kept", F.when(F.col("lines").isNotNull(), kept).otherwise(lines))
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    return joined.select(
        F.col("_key"),
        *[F.col(f"_c{i}") for i in range(len(columns))],
        F.array_join("_kept", "\n").alias("_left"),
        F.when(F.col("_text").isNull(), F.lit(0)).otherwise(n_lines).cast("long").alias("n_lines"),
        F.when(F.col("_text").isNull(), F.lit(0)).otherwise(n_lines - F.size("_kept")).cast("long").alias("n_dropped"),
    ).toDF(key, *columns, text, "n_lines", "n_dropped")
