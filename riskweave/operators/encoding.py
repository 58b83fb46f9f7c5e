"""Category encoders as tables: fitting is a grouped count, applying is a join.

A fitted encoder is the table ``feature, category, position, n``: a column's
categories ranked by frequency (the name breaks ties), all columns in one
pass.  It is an ordinary stored table: it can be joined in SQL, compared
between loads, and applied without a model object.

Unseen categories (and NULL) get the position after the last one (``keep``) or
lose their row (``skip``).  Spark chooses the join by the table's size; a
frequent category is split by AQE's skew join where it does not broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, category, n`` of all columns in one scan (NULL is no category)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns])
    each = df.select(F.explode(pairs).alias("p")).select("p.*").where("category IS NOT NULL")
    return each.groupBy("feature", "category").agg(F.count("*").alias("n"))


def fit_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The encoder ``feature, category, position, n``: most frequent category first."""
    order = Window.partitionBy("feature").orderBy(F.col("n").desc(), "category")  # a row a category
    ranked = category_counts(df, columns).withColumn("position", (F.row_number().over(order) - 1).cast("double"))
    return ranked.select("feature", "category", "position", "n")


def feature_sizes(encoder: DataFrame) -> dict[str, int]:
    """How many categories each column has (a number a column)."""
    return {r["feature"]: r["c"] for r in encoder.groupBy("feature").agg(F.count("*").alias("c")).collect()}


def encode(df: DataFrame, encoder: DataFrame, columns: dict[str, str], unseen: str = "keep") -> DataFrame:
    """``df`` with the position of each column's category: ``columns`` maps a column to its output."""
    if unseen not in ("keep", "skip"):
        raise ValueError("unseen is 'keep' or 'skip'")
    sizes = feature_sizes(encoder)
    out = df
    for i, (column, name) in enumerate(columns.items()):
        own = encoder.where(F.col("feature") == column).select(F.col("category").alias(f"_c{i}"), F.col("position").alias(f"_p{i}"))
        same = F.col(column).cast("string") == F.col(f"_c{i}")
        if unseen == "skip":
            out = out.join(own, same).withColumn(name, F.col(f"_p{i}"))
        else:
            last = F.lit(float(sizes.get(column, 0)))
            out = out.join(own, same, "left").withColumn(name, F.coalesce(F.col(f"_p{i}"), last))
        out = out.drop(f"_c{i}", f"_p{i}")
    return out


def decode(df: DataFrame, encoder: DataFrame, feature: str, position: str, out: str) -> DataFrame:
    """``df`` with the category of a position (NULL if the encoder has none there)."""
    own = encoder.where(F.col("feature") == feature).select(F.col("position").alias("_p"), F.col("category").alias(out))
    return df.join(own, F.col(position) == F.col("_p"), "left").drop("_p")


def flag(condition: Column) -> Column:
    """A condition as a 0/1 label; NULL counts as 0."""
    return F.when(condition, 1.0).otherwise(0.0)


def assemble(columns: Sequence[str]) -> Column:
    """The columns as one array of doubles (NULL if any is NULL, so a model can leave the row out)."""
    parts = [F.col(c).cast("double") for c in columns]
    known = parts[0].isNotNull()
    for p in parts[1:]:
        known = known & p.isNotNull()
    return F.when(known, F.array(*parts))
