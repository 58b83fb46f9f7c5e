"""Training and scoring of tree ensembles on any table.

What is learnt is an argument: ``Inputs`` names the key, the numeric and the
category columns; a ``Target`` names the column to predict and, for a yes/no
target, the value that counts as yes.

* A hash sample of the rows is split into train and test by a second hash of
  the key, so neither depends on partitioning or task retries.
* One feature pipeline is fitted and shared by all targets; their fits run
  side by side; scoring is a single transform chain, so no join on the key is
  needed and a repeated key cannot multiply rows.
* All metrics of all targets come from one collapse of the scored test rows
  to (labels, predictions, scores) -> count.

A time series of groups is a table of (time, group, values): ``train_series``
holds out the last distinct times, fits one regressor a value on (step, group)
and predicts the holdout and one step beyond, in long form.

Training data is small as a rule (a sample; a table of times x groups), but
all of it stays in Spark: tree statistics are aggregated on executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators import metrics
from riskweave.operators.encoding import flag
from riskweave.operators.sampling import split_label, unit_hash


class InsufficientDataError(RuntimeError):
    pass


@dataclass(frozen=True)
class Inputs:
    """The columns a model reads, in the order of its features: numbers, then categories."""

    key: str
    numbers: tuple[str, ...]
    categories: tuple[str, ...]

    @property
    def indexed(self) -> dict[str, str]:
        return {c: f"{c}_idx" for c in self.categories}

    @property
    def features(self) -> list[str]:
        return [*self.numbers, *self.indexed.values()]

    def stages(self, vector: str = "features") -> list:
        """Index the categories (unseen ones kept) and gather the features."""
        made: list = [StringIndexer(inputCol=c, outputCol=i, handleInvalid="keep") for c, i in self.indexed.items()]
        return [*made, VectorAssembler(inputCols=self.features, outputCol=vector)]


@dataclass(frozen=True)
class Target:
    """A column to predict.  With ``positive`` the question is whether it has that value."""

    name: str
    column: str
    positive: str | None = None
    label: str = ""
    said: str = ""  # name in the predictions table

    @property
    def label_column(self) -> str:
        return self.label or f"{self.name}_label"

    @property
    def output(self) -> str:
        return self.said or self.column

    def named(self, part: str) -> str:
        return f"{self.name}_{part}"


#: Partitions of the training rows.  Forests seed their bagging per partition,
#: so the layout is fixed: the same rows give the same model on any cluster.
TRAIN_PARTITIONS = 16


def training_layout(df: DataFrame, key: str) -> DataFrame:
    """The rows in ``TRAIN_PARTITIONS`` partitions by key hash, each in key order
    (equal keys by a hash of the row), however ``df`` was partitioned."""
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.repartition(TRAIN_PARTITIONS, key).sortWithinPartitions(F.col(key), row)


def labelled_sample(data: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Add ``split``: train / test inside the hash sample, ``unsampled`` elsewhere."""
    in_sample = unit_hash(key, f"sample{seed}") < fraction
    inside = split_label(key, (0.8, 0.2), ("train", "test"), seed)
    return data.withColumn("split", F.when(in_sample, inside).otherwise(F.lit("unsampled")))


def model_rows(df: DataFrame, inputs: Inputs, targets: Sequence[Target]) -> DataFrame:
    """The columns that the models read, of the rows that have them all, and
    the 0/1 labels (an assembler stops at a NULL, so such rows are left out)."""
    needed = list(dict.fromkeys([*inputs.numbers, *inputs.categories, *[t.column for t in targets]]))
    rows = df.select(*dict.fromkeys([inputs.key, *needed])).dropna(subset=needed)
    return rows.withColumns({t.label_column: flag(F.col(t.column) == t.positive) for t in targets if t.positive is not None})


def fit_side_by_side(jobs: list[tuple[Estimator, DataFrame]]) -> list:
    """Fit (estimator, data) pairs from parallel driver threads; Spark
    schedules the resulting jobs side by side on the cluster."""
    if len(jobs) < 2:
        return [estimator.fit(data) for estimator, data in jobs]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(estimator.fit, data) for estimator, data in jobs]]


@dataclass
class Models:
    inputs: Inputs
    targets: Sequence[Target]
    features: PipelineModel
    labels: dict[str, StringIndexerModel]
    forests: dict[str, object]
    train_rows: int = 0
    test_rows: int = 0
    metrics: dict = field(default_factory=dict)

    def transform(self, rows: DataFrame) -> DataFrame:
        """Features, labels and every model's columns in one chain.  Rows of a
        class that the training rows lack are skipped, as in the metrics."""
        out = self.features.transform(rows)
        for indexer in self.labels.values():
            out = indexer.transform(out)
        for target in self.targets:
            out = self.forests[target.name].transform(out)
            if target.name in self.labels:
                names = self.labels[target.name].labels
                out = IndexToString(inputCol=target.named("prediction"), outputCol=f"predicted_{target.output}", labels=names).transform(out)
            else:
                out = out.withColumn(f"predicted_{target.output}", F.col(target.named("prediction")) == 1.0)
                out = out.withColumn(f"predicted_{target.output}_probability", vector_to_array(target.named("probability"))[1])
        return out

    def predictions(self, rows: DataFrame) -> DataFrame:
        """Key, then actual and predicted value of every target (and ``split``, if the rows have it)."""
        columns: list[Column | str] = [self.inputs.key]
        for t in self.targets:
            actual = F.col(t.column) if t.positive is None else F.col(t.label_column) == 1.0
            columns += [actual.alias(f"actual_{t.output}"), f"predicted_{t.output}"]
            if t.positive is not None:
                columns.append(f"predicted_{t.output}_probability")
        return self.transform(rows).select(*columns, *(["split"] if "split" in rows.columns else []))


def measured(scored: DataFrame, targets: Sequence[Target]) -> tuple[dict, int]:
    """Accuracy and F1 of every target, and AUC of the yes/no ones, from one
    pass over the scored rows; also their number."""
    columns = []
    for t in targets:
        columns += [F.col(t.label_column).alias(t.named("actual")), F.col(t.named("prediction")).alias(t.named("said"))]
        if t.positive is not None:
            columns.append(vector_to_array(t.named("probability"))[1].alias(t.named("score")))
    names = scored.select(*columns).columns
    counted = scored.select(*columns).groupBy(*names).agg(F.count("*").alias("n")).persist()
    try:
        parts = [counted.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("value")).select(F.lit("rows").alias("metric"), "value")]
        for t in targets:
            told = metrics.class_metrics(metrics.confusion_counts(counted, t.named("actual"), t.named("said"), weight="n"))
            parts += [told.select(F.lit(t.named(m)).alias("metric"), F.col(m).alias("value")) for m in ("accuracy", "f1")]
            if t.positive is not None:
                auc = metrics.rank_auc(counted, F.col(t.named("score")), F.col(t.named("actual")) == 1.0, weight=F.col("n"))
                parts.append(auc.select(F.lit(t.named("auc")).alias("metric"), F.col("auc").alias("value")))
        told = {r["metric"]: r["value"] for r in reduce(DataFrame.unionByName, parts).collect()}  # a row a metric
    finally:
        counted.unpersist()
    return told, int(told.pop("rows"))


def train(
    df: DataFrame,
    inputs: Inputs,
    targets: Sequence[Target],
    fraction: float = 0.1,
    seed: int = 42,
    num_trees: int = 50,
    max_depth: int = 8,
    min_rows: int = 1000,
) -> Models:
    """A forest for every target, fitted on the train rows of the hash sample and measured on its test rows."""
    data = labelled_sample(model_rows(df, inputs, targets), inputs.key, fraction, seed)
    held: list[DataFrame] = []

    def cached(rows: DataFrame) -> DataFrame:
        held.append(rows.persist())
        return rows

    sample = cached(training_layout(data.where(F.col("split") != "unsampled"), inputs.key))
    try:
        n = sample.count()
        if n < min_rows:
            raise InsufficientDataError(f"sample has {n} rows, fewer than {min_rows}")
        train_rows, test_rows = (sample.where(F.col("split") == s) for s in ("train", "test"))
        features = Pipeline(stages=inputs.stages()).fit(train_rows)
        classes = [t for t in targets if t.positive is None]
        labels = {
            t.name: StringIndexer(inputCol=t.column, outputCol=t.label_column, handleInvalid="skip").fit(train_rows) for t in classes
        }
        ready = features.transform(train_rows)
        for indexer in labels.values():
            ready = indexer.transform(ready)
        ready = cached(ready)
        categories = [len(m.labels) + 1 for m in features.stages if isinstance(m, StringIndexerModel)]  # one more for unseen values
        forests = [
            RandomForestClassifier(
                labelCol=t.label_column, featuresCol="features", numTrees=num_trees, maxDepth=max_depth, seed=seed, maxBins=max([32, *categories]),
                predictionCol=t.named("prediction"), rawPredictionCol=t.named("raw"), probabilityCol=t.named("probability"),
            )
            for t in targets
        ]
        fitted = fit_side_by_side([(f, ready) for f in forests])
        models = Models(inputs, targets, features, labels, {t.name: m for t, m in zip(targets, fitted)}, ready.count())
        models.metrics, models.test_rows = measured(models.transform(test_rows), targets)
        return models
    finally:
        for rows in held:
            rows.unpersist()


# ---- series of groups -----------------------------------------------------------

@dataclass(frozen=True)
class Series:
    """A table of one row a (time, group) with a step number and values to forecast."""

    time: str
    group: str
    step: Column
    values: tuple[str, ...]

    def frame(self, df: DataFrame) -> DataFrame:
        return df.select(self.time, self.group, *[F.col(v).cast("double").alias(v) for v in self.values], self.step.cast("double").alias("step"))


def holdout_times(df: DataFrame, time: str, holdout: int) -> DataFrame:
    """The last ``holdout`` distinct times (a ``holdout``-row DataFrame)."""
    return df.select(time).distinct().orderBy(F.col(time).desc()).limit(holdout)


def split_holdout(frame: DataFrame, series: Series, holdout: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows by a semi/anti join with the last times; nothing is collected."""
    last = F.broadcast(holdout_times(frame, series.time, holdout))  # ``holdout`` rows
    return frame.join(last, series.time, "left_anti"), frame.join(last, series.time, "left_semi")


def forward_frame(frame: DataFrame, series: Series) -> DataFrame:
    """One row a group at the step after the last, with the series' columns: time and values are NULL."""
    last = frame.agg(F.max("step")).first()[0]  # one number
    kinds = dict(frame.dtypes)
    empty = [F.lit(None).cast(kinds[c]).alias(c) for c in (series.time, *series.values)]
    ahead = F.lit(None if last is None else last + 1.0).cast("double").alias("step")
    return frame.select(series.group).distinct().select(series.group, ahead, *empty).select(*frame.columns)


def unpivoted(rows: DataFrame, values: Sequence[str], predicted: dict[str, str] | None = None) -> DataFrame:
    """Long form: a row a value with ``metric, actual_value`` (and ``predicted_value``)."""
    parts = []
    for v in values:
        said = [F.col(predicted[v]).alias("predicted_value")] if predicted else []
        parts.append(F.struct(F.lit(v).alias("metric"), F.col(v).alias("actual_value"), *said))
    gone = {*values, *(predicted or {}).values()}
    return rows.select(*[c for c in rows.columns if c not in gone], F.explode(F.array(*parts)).alias("_m")).select("*", "_m.*").drop("_m")


@dataclass
class SeriesModels:
    series: Series
    models: dict[str, PipelineModel]
    frame: DataFrame
    test: DataFrame

    @property
    def predicted(self) -> dict[str, str]:
        return {v: f"_{v}" for v in self.series.values}

    def forecast(self) -> DataFrame:
        """Long-form rows of the holdout and of one step beyond, ``forecast_type`` apart."""
        rows = self.test.withColumn("forecast_type", F.lit("holdout")).unionByName(
            forward_frame(self.frame, self.series).withColumn("forecast_type", F.lit("forward"))
        )
        for model in self.models.values():
            rows = model.transform(rows).select(*rows.columns, model.stages[-1].getPredictionCol())
        told = unpivoted(rows, self.series.values, self.predicted)
        return told.select(self.series.time, self.series.group, "metric", "actual_value", "predicted_value", "forecast_type")

    @cached_property
    def metrics(self) -> dict:
        held = self.forecast().where(F.col("forecast_type") == "holdout")
        told = metrics.error_metrics(held, "actual_value", "predicted_value", ["metric"]).collect()  # a row a value
        return {r["metric"]: {"rmse": r["rmse"], "mae": r["mae"]} for r in told}

    def release(self) -> None:
        self.frame.unpersist()


def train_series(
    df: DataFrame, series: Series, holdout: int = 3, max_iter: int = 50, max_depth: int = 4, seed: int = 42, min_rows: int = 12
) -> SeriesModels:
    """One boosted regressor a value on (step, group); ``release`` the models' frame after use."""
    frame = series.frame(df).repartition(1).persist()  # times x groups: a small table
    kept = False
    try:
        n_rows, n_times = frame.agg(F.count("*"), F.countDistinct(series.time)).first()
        if n_rows < min_rows or n_times <= holdout:
            raise InsufficientDataError(f"{n_rows} rows at {n_times} times: not enough history")
        train_rows, test = split_holdout(frame, series, holdout)
        train_rows = train_rows.persist()
        try:
            inputs = Inputs(series.time, ("step",), (series.group,))
            jobs = []
            for v in series.values:
                vector = f"_{v}_features"
                # names of their own, so that the models can follow each other in one chain
                indexer = StringIndexer(inputCol=series.group, outputCol=f"_{v}_group", handleInvalid="keep")
                gather = VectorAssembler(inputCols=[*inputs.numbers, f"_{v}_group"], outputCol=vector)
                regressor = GBTRegressor(labelCol=v, featuresCol=vector, predictionCol=f"_{v}", maxIter=max_iter, maxDepth=max_depth, seed=seed)
                jobs.append((Pipeline(stages=[indexer, gather, regressor]), train_rows))
            fitted = fit_side_by_side(jobs)
        finally:
            train_rows.unpersist()
        models = SeriesModels(series, dict(zip(series.values, fitted)), frame, test)
        models.metrics  # noqa: B018 - read while the frame is held
        kept = True
        return models
    finally:
        if not kept:
            frame.unpersist()
