"""Where layer tables live: a catalog database or a base folder."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from riskweave.sources import versions
from riskweave.sources.files import create_database, read_table, write_table

BRONZE = ("customers", "claims")
SILVER = ("silver_customers", "silver_claims", "silver_claims_enriched")
GOLD = ("gold_claims_kpi_by_state", "gold_monthly_claim_trends", "gold_high_risk_watchlist")
HISTORY = "data_quality_check"


@dataclass
class Store:
    """Where layer tables live: a catalog database or a base folder.

    With ``versioned`` a path table is replaced without a gap: it is written
    beside the old one, and readers switch when it is complete.
    """

    spark: SparkSession
    database: str | None = None
    base_path: str | None = None
    fmt: str = "parquet"
    versioned: bool = False
    written: dict = field(default_factory=dict)

    def __post_init__(self):
        if not self.database and not self.base_path:
            raise ValueError("give a database or a base path")
        if self.database:
            create_database(self.spark, self.database)

    def name(self, table: str) -> str | None:
        return f"{self.database}.{table}" if self.database else None

    def path(self, table: str) -> str | None:
        return None if self.database else f"{self.base_path.rstrip('/')}/{table}"

    def write(self, df: DataFrame, table: str) -> None:
        if self.versioned and self.path(table):
            versions.write_version(df, self.path(table), fmt=self.fmt)
            versions.prune(self.spark, self.path(table))
        else:
            write_table(df, name=self.name(table), path=self.path(table), fmt=self.fmt)
        self.written[table] = self.name(table) or self.path(table)

    def read(self, table: str) -> DataFrame:
        if self.versioned and self.path(table) and table != HISTORY:  # the history is appended to
            return versions.read_version(self.spark, self.path(table), fmt=self.fmt)
        return read_table(self.spark, self.name(table), self.path(table), self.fmt)
