"""Registered corpus queries: one ``opN_<name>`` per operator, whole tables, production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import (
    bpe, jaccard, langid, linededup, lm, merkle, minhash, packing, quality, spelling, subdedup, topk, wavelet,
)
from riskweave.llm.ship import ship
from riskweave.session import scratch_dir

WORD_BPE = "word_bpe_49k.json"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_frequency_verdict(_table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"), order=3)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), outputs={"ids_crc32": F.crc32("ids")}
    )


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "wavelet")
    wavelet.write_token_shards(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return wavelet.read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_boilerplate(_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subdedup.remove_repeats(_table(spark, sf_dir, "documents"), sure_words=40)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(MULTI_BPE), public_tokenizers.PATTERN
    encoded = bpe.encode_documents(_table(spark, sf_dir, "documents"), ranks, pattern)
    decoded = bpe.decode_documents(encoded, ranks, pattern)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    component = F.col("component")
    return found.select(
        "doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.runs(_table(spark, sf_dir, "documents"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.crc32(F.concat("key", F.lit(":"), "run"))
    at = F.expr("cast(h % length(run) as int)")
    cut = F.concat(F.left("run", at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % 199 == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelling.variants(spelling.vocabulary(words, min_chars=6, min_count=5))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    told = merkle.build(
        docs,
        F.col("lang"),
        F.col("doc_id"),
        merkle.row_digest([F.col(c) for c in fields]),
        merkle.row_digest([tampered if c == "n_chars" else F.col(c) for c in fields]),
    ).proofs()
    said = {"leaf": "leaf", "subroot": "subroot", "root": "root", "proof": "proof_sha256", "folded_root": "folded_root"}
    return told.select(F.col("key").alias("doc_id"), *[F.lower(F.hex(c)).alias(n) for c, n in said.items()], "verified")


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _shipped(f) for f in (
        op1_language_id, op2_quality_rules, op3_lm_scoring, op4_best_fit_packing, op5_exact_top_k, op6_token_output, op7_line_dedup,
        op8_ngram_jaccard, op9_substring_dedup, op10_byte_bpe,
        op11_minhash_dedup, op12_spelling_variants, op13_merkle_manifest,
    )}
