"""Lazy layer DataFrames over one input folder.

``Layers(spark, sf_dir)`` exposes every medallion layer as a DataFrame
built from the driver's Parquet tables.  Nothing runs until an action; the
table-wide customer scores (z-score stats, percentile bounds) run their
small preparatory jobs when ``silver_customers`` is first asked for.  The
enriched and trend layers are persisted (memory and disk) the first time an
action reads them, as the batch would read its stored tables; lost blocks
are recomputed from lineage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from riskweave.operators import cleanse, enrich, gold
from riskweave.sources import fixtures


class Layers:
    """Lazily built layer DataFrames of one input folder.

    ``Layers(spark, sf_dir)`` returns the same instance for the same session
    and folder, so a session defines its layers once (like registering
    views) and every query plans on top of them; the few driver-side
    statistics of the table-wide scores are computed once per session.
    """

    _instances: dict = {}

    def __new__(cls, spark: SparkSession, sf_dir: str, score_digits: int | None = 6):
        key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), score_digits)
        inst = cls._instances.get(key)
        if inst is None:
            inst = super().__new__(cls)
            inst._init(spark, sf_dir, score_digits)
            cls._instances[key] = inst
        return inst

    @classmethod
    def release(cls, spark: SparkSession | None = None) -> None:
        """Unpersist and forget the layers of one session (all when None)."""
        for key, inst in list(cls._instances.items()):
            if spark is None or inst.spark is spark:
                for name in ("enriched", "trends"):
                    if name in inst.__dict__:
                        inst.__dict__[name].unpersist()
                del cls._instances[key]

    def _init(self, spark: SparkSession, sf_dir: str, score_digits: int | None) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.score_digits = score_digits

    @cached_property
    def customers(self) -> DataFrame:
        return fixtures.customers_raw(self.spark, self.sf_dir)

    @cached_property
    def claims(self) -> DataFrame:
        return fixtures.claims_raw(self.spark, self.sf_dir)

    @cached_property
    def customers_base(self) -> DataFrame:
        """Silver customers without the table-wide scores (all the
        enrichment join needs)."""
        return cleanse.customers_base(self.customers)

    @cached_property
    def silver_customers(self) -> DataFrame:
        return cleanse.silver_customers(self.customers, score_digits=self.score_digits)

    @cached_property
    def silver_claims(self) -> DataFrame:
        return cleanse.silver_claims(self.claims)

    @cached_property
    def enriched(self) -> DataFrame:
        """Persisted: most reports read it, like the stored enriched table.
        Lost blocks are recomputed from lineage."""
        return enrich.enrich_claims(self.silver_claims, self.customers_base).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def kpi(self) -> DataFrame:
        return gold.kpi_by_state(self.enriched)

    @cached_property
    def trends(self) -> DataFrame:
        """Persisted: the window and forecast queries all start here (months x
        policies rows)."""
        return gold.monthly_trends(self.enriched).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def watchlist(self) -> DataFrame:
        return gold.high_risk_watchlist(self.enriched)

    @cached_property
    def executive(self) -> DataFrame:
        return gold.executive_by_state(self.kpi)
