"""The corpus pipeline: language ID, line dedup, n-gram Jaccard join, substring dedup, packing.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame with the columns of ``documents`` (the last:
packed pieces).  ``run`` writes each stage's rows as Parquet in the shared
checkpoint folder and rereads them as the next one's ``docs``.

Every stage keeps the rows' other columns; ``n_chars`` follows the text.  A
document whose text a dedup stage leaves without a word goes.  Defined
results for nulls, ties, repeated rows and empty tables are those of the
operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import jaccard, langid, linededup, packing, subdedup
from riskweave.llm.common import WIDE, in_few_files, staged
from riskweave.llm.ship import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Texts nearer than this to no language's profile are not language.
MIN_LANGUAGE_SCORE = 0.3
#: Share of a host's distinct texts above which a line is boilerplate.
LINE_RATIO = 0.02
#: Distinct texts of a host that a boilerplate line stands on at least.
MIN_LINE_PAGES = 10


def _with_words(docs: DataFrame) -> DataFrame:
    has_word = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.where(has_word).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return langid.keep_identified(docs.select(*COLUMNS), langid.fit(docs), MIN_LANGUAGE_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return _with_words(linededup.drop_boilerplate(docs, LINE_RATIO, keep=COLUMNS, distinct=True, min_line_pages=MIN_LINE_PAGES))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return in_few_files(jaccard.keep_one(docs).select(*COLUMNS), WIDE)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return in_few_files(_with_words(subdedup.remove_repeats(docs, keep=COLUMNS, sure_words=40)), WIDE)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenisation and packing have no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
