"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base counts of every whole text (words are runs outside ``[\x20\x09-\x0D]``):
words, their code points, symbol characters, lines equal to an earlier line,
and words inside 5-word windows that occur twice or more in the text.

Then lines are normalised (ends trimmed, white space folded, lower case) and
hashed; for each host the distinct documents that contain a line are counted.
A line in more than ``max_share`` of a host's documents (and in at least
``min_docs``) is removed, and a document that loses more than
``max_removed`` of its words is rejected as depleted.

The counted table (numbers and line hashes, no text) is staged with a row id,
so the text is read once and repeated rows stay apart.  Line counts are
partial sums before the shuffle; the lines above the limits are few (a host
has at most mean lines a document / ``max_share``) and are counted before
they are broadcast.

Edge cases: a null text has no words and fails the base rules; a very long
text is counted whole, its words and lines as arrays of one row; a line on
exactly the allowed share of documents stays; a null host is a host of its
own; repeated rows are documents each; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import SEPARATOR_CLASS, SEPARATORS, join_small, let, plain, staged

_BLANKS = SEPARATORS.decode()
# fixed value: the symbol characters
_NOT_SYMBOLS = r"[^#*$%&|<>]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SEPARATOR_CLASS + "+"), lambda w: w != "")


def repeat_words(words: Column, n: int = 5) -> Column:
    """Words inside n-word windows that occur twice or more (the first included)."""

    def covered(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            again = F.filter(
                s,
                lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(again, lambda e: e["i"]))

        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end"))
        total = F.aggregate(
            let(ranked, places),
            start,
            lambda acc, p: F.struct(
                (acc["sum"] + F.least(F.lit(n), p + n - acc["end"])).alias("sum"), (p + n).alias("end")
            ),
        )["sum"]
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(total)

    def windows(h: Column) -> Column:
        own = F.transform(
            F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)])
        )
        return F.when(F.size(h) < n, F.lit(0)).otherwise(let(own, covered))

    return let(F.transform(words, lambda w: F.xxhash64(w)), windows).cast("long")


def base_counts(docs: DataFrame, key: str, host: str, text: str) -> DataFrame:
    """Row id, key, host, the base counts and ``lines``: (hash, words) of every
    line that has a word, ordered by hash."""
    rows = docs.select(plain(key).alias("key"), plain(host).alias("host"), F.coalesce(plain(text), F.lit("")).alias("text"))
    words = let(
        words_of(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    lines = let(
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != ""),
        lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.sort_array(
                F.transform(
                    F.transform(x, lambda y: F.lower(F.regexp_replace(F.btrim(y, F.lit(_BLANKS)), SEPARATOR_CLASS + "+", " "))),
                    lambda y: F.struct(F.xxhash64(y).alias("h"), F.size(F.split(y, " ")).alias("n")),
                )
            ).alias("lines"),
        ),
    )
    counted = rows.select(
        "key",
        "host",
        words.alias("w"),
        F.length(F.regexp_replace("text", _NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        lines.alias("l"),
    )
    return counted.select(
        F.monotonically_increasing_id().alias("uid"), "key", "host", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines",
        "w.n_repeat_words", "l.lines",
    )


def line_frequency_verdict(
    docs: DataFrame,
    max_share: float = 0.1,
    min_docs: int = 10,
    max_removed: float = 0.5,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
) -> DataFrame:
    """``key``, the base counts, ``base_failed, kept, n_lines, n_removed_lines, n_removed_words``."""
    base = staged(base_counts(docs, key, host, text), "quality")
    marked = F.transform(
        "lines",
        lambda x, i: F.struct(x["h"].alias("line"), x["n"].alias("n"), F.when(F.get("lines", i - 1)["h"] == x["h"], 0).otherwise(1).alias("first")),
    )
    lines = base.select("uid", "host", F.inline(marked))
    counts = lines.groupBy("host", "line").agg(F.sum("first").alias("docs")).where(F.col("docs") >= min_docs)
    totals = base.groupBy("host").agg(F.count("*").alias("total"))
    often = join_small(counts, totals, ["host"]).where(F.col("docs") > F.col("total") * F.lit(max_share)).select("host", "line")
    removed = (
        join_small(lines, often, ["host", "line"])
        .groupBy("uid")
        .agg(F.count("*").alias("n_removed_lines"), F.sum("n").alias("n_removed_words"))
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    gone = F.coalesce("n_removed_words", F.lit(0))
    return base.join(removed, "uid", "left").select(
        F.col("key").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (gone <= F.col("n_words") * F.lit(max_removed))).alias("kept"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_removed_lines", F.lit(0)).cast("long").alias("n_removed_lines"),
        gone.cast("long").alias("n_removed_words"),
    )
