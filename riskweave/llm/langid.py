"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent letter n-grams (1 to ``max_n``
code points, words bounded by a blank), most frequent first, ties in code
order.  A document's distance to a language is the sum, over the n-grams of
its own profile, of how far each is out of place in the language's profile;
an n-gram that the language lacks counts ``profile_size``.  The language with
the smallest distance wins, ties to the smaller name.

Profiles are fitted on labelled documents, of each language about
``max_docs_per_lang`` by a hash of the key (the only sampled step: a
classifier's training rows, bounded).  The n-grams are counted in the tasks
and summed by Spark; only the profiles (languages x ``profile_size`` rows)
come to the driver.  Prediction reads every whole text in one narrow pass.

Edge cases: a null text or one without letters is ``und`` with score 0; a very
long text is predicted from all of its n-grams, some tens of bytes of memory a
character; languages that tie go to the first in name order; with no labelled
documents every text is ``und``; rows without a label are not trained on;
repeated rows are predicted alike; other columns are ignored (or kept as they
are, whatever their names); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import SLICE_BYTES, join_small, plain, slices, text_sizes

UNDETERMINED = "und"
_BOUNDARY = 1
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether each Unicode code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def gram_codes(text: str | None, max_n: int) -> np.ndarray:
    """Codes (21 bits a code point) of all n-grams of a text, lower case; n is at most 3."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = letter_table()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    row = np.concatenate([[_BOUNDARY], np.where(letter, points, _BOUNDARY)[keep], [_BOUNDARY]])
    grams = [row[row != _BOUNDARY]]
    if max_n >= 2:
        grams.append(row[:-1] << 21 | row[1:])
    if max_n >= 3:
        triple = row[:-2] << 42 | row[1:-1] << 21 | row[2:]
        grams.append(triple[row[1:-1] != _BOUNDARY])
    codes = np.concatenate(grams)
    # the text's last blank may stand twice
    return codes[codes != (_BOUNDARY << 21 | _BOUNDARY)]


def profile(codes: np.ndarray, size: int) -> np.ndarray:
    grams, counts = np.unique(codes, return_counts=True)
    return grams[np.argsort(-counts, kind="stable")[:size]]


@dataclass
class LanguageModel:
    languages: list[str]
    grams: np.ndarray  # sorted codes of all profiles
    ranks: np.ndarray  # grams x languages; profile_size where a language lacks the gram
    profile_size: int
    max_n: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): 1 less the smallest distance as a share of the largest possible."""
        own = profile(gram_codes(text, self.max_n), self.profile_size)
        if not len(own) or not self.languages:
            return UNDETERMINED, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        away = np.abs(self.ranks[at] - np.arange(len(own))[:, None])
        distance = np.where(known[:, None] & (self.ranks[at] < self.profile_size), away, self.profile_size).sum(axis=0)
        best = int(distance.argmin())
        return self.languages[best], 1.0 - float(distance[best]) / (len(own) * self.profile_size)


def fit(
    docs: DataFrame,
    max_docs_per_lang: int = 2000,
    profile_size: int = 400,
    max_n: int = 3,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> LanguageModel:
    rows = docs.select(plain(key).alias("key"), plain(lang).alias("lang"), plain(text).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    shares = rows.groupBy("lang").agg((F.lit(float(max_docs_per_lang)) / F.count("*")).alias("share"))
    place = F.pmod(F.xxhash64("key", F.lit("train")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # one row a language: broadcast once counted, so no text is shuffled and a hot language stays spread
    sample = join_small(rows, shares, ["lang"]).where(place < F.col("share")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(text_sizes(batch.column(1)), SLICE_BYTES):
                part = batch.slice(i, j - i)
                by_lang: dict[str, list[np.ndarray]] = {}
                for name, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    by_lang.setdefault(name, []).append(gram_codes(x, max_n))
                for name, codes in by_lang.items():
                    grams, n = np.unique(np.concatenate(codes), return_counts=True)
                    yield pa.record_batch(
                        [pa.array([name] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())],
                        names=["lang", "gram", "n"],
                    )

    counts = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile_size)
    found = top.select("lang", "gram", "rank").collect()  # languages x profile_size rows
    languages = sorted({r["lang"] for r in found})
    grams = np.array(sorted({r["gram"] for r in found}), np.int64)
    ranks = np.full((len(grams), len(languages)), profile_size, np.int64)
    for r in found:
        ranks[np.searchsorted(grams, r["gram"]), languages.index(r["lang"])] = r["rank"] - 1
    return LanguageModel(languages, grams, ranks, profile_size, max_n)


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` for every row."""
    rows = docs.select(plain(key).alias("key"), plain(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(text_sizes(batch.column(1)), SLICE_BYTES):
                said = [model.predict(x) for x in batch.column(1).slice(i, j - i).to_pylist()]
                yield pa.record_batch(
                    [batch.column(0).slice(i, j - i), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())],
                    names=["key", "lang_pred", "score"],
                )

    schema = f"key {rows.schema['key'].dataType.simpleString()}, lang_pred string, score double"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float, text: str = "text") -> DataFrame:
    """The rows, all columns, whose text has a language with at least ``min_score``."""
    columns = docs.columns
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(text_sizes(batch.column(at)), SLICE_BYTES):
                part = batch.slice(i, j - i)
                said = [model.predict(x) for x in part.column(at).to_pylist()]
                yield part.filter(pa.array([name != UNDETERMINED and score >= min_score for name, score in said], pa.bool_()))

    # by position: a mapped table's column names must not hold dots
    numbered = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    return numbered.mapInArrow(run, numbered.schema).toDF(*columns)
