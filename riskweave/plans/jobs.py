"""One function per batch job, each reading and writing stored tables.

These are the steps a scheduler runs one by one (each may be its own Spark
application; hand-over is by stored table only):

    load-customers  CSV            -> customers
    load-claims     Parquet        -> claims
    silver-customers customers     -> silver_customers
    silver-claims   claims         -> silver_claims
    enrich          silver_*       -> silver_claims_enriched
    dq-enriched     enriched       -> data_quality_check (gate: exit 1 on failure)
    dq-customers    customers      -> data_quality_check (gate)
    gold-kpi        enriched       -> gold_claims_kpi_by_state
    gold-trends     enriched       -> gold_monthly_claim_trends, gold_high_risk_watchlist
    classify        enriched       -> gold_ml_claim_predictions
    forecast        trends         -> gold_ml_monthly_forecast
    views           gold_*         -> vw_executive_claims_by_state, vw_high_risk_claims_report

Command line (spark-submit or python):
    python -m riskweave.plans.jobs <job> (--database DB | --base-path PATH) [--input PATH]
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import cleanse, enrich, gold, ml, quality
from riskweave.plans.store import HISTORY, Store
from riskweave.sources.files import read_csv, read_csv_by_name

CUSTOMERS_SCHEMA = "customer_id BIGINT, age INT, state STRING, fraud_risk_score DOUBLE"


def _clock(clock: Column | None) -> Column:
    return F.current_timestamp() if clock is None else clock


def load_customers(store: Store, csv_path: str, schema: str | None = CUSTOMERS_SCHEMA) -> DataFrame:
    """Bronze customers from CSV, columns by header name, others kept (``schema=None`` infers types)."""
    df = read_csv_by_name(store.spark, csv_path, schema) if schema else read_csv(store.spark, csv_path, infer_schema=True)
    store.write(df, "customers")
    return store.read("customers")


def load_claims(store: Store, parquet_path: str) -> DataFrame:
    store.write(store.spark.read.parquet(parquet_path), "claims")
    return store.read("claims")


def silver_customers(store: Store, clock: Column | None = None) -> DataFrame:
    store.write(cleanse.silver_customers(store.read("customers"), processed_at=_clock(clock)), "silver_customers")
    return store.read("silver_customers")


def silver_claims(store: Store, clock: Column | None = None) -> DataFrame:
    store.write(cleanse.silver_claims(store.read("claims"), processed_at=_clock(clock)), "silver_claims")
    return store.read("silver_claims")


def claims_enriched(store: Store, clock: Column | None = None, hot_key_fraction: float | str | None = "auto") -> DataFrame:
    joined = enrich.enrich_claims(store.read("silver_claims"), store.read("silver_customers"),
                                  processed_at=_clock(clock), hot_key_fraction=hot_key_fraction)
    store.write(joined, "silver_claims_enriched")
    return store.read("silver_claims_enriched")


def _gate(store: Store, table: str, suite: quality.Suite, execution_id: str | None,
          execution_time: dt.datetime | None) -> list:
    rows = quality.run_gate(store.read(table), suite, history_table=store.name(HISTORY),
                            history_path=store.path(HISTORY), execution_id=execution_id,
                            execution_time=execution_time)
    store.written[HISTORY] = store.name(HISTORY) or store.path(HISTORY)
    return rows


def dq_enriched(store: Store, execution_id: str | None = None, execution_time: dt.datetime | None = None) -> list:
    """Seven checks on the enriched claims; raises DataQualityError on failure
    (after storing the result rows)."""
    target = store.name("silver_claims_enriched") or "silver_claims_enriched"
    return _gate(store, "silver_claims_enriched", quality.enriched_suite(target), execution_id, execution_time)


def dq_customers(store: Store, execution_id: str | None = None, execution_time: dt.datetime | None = None,
                 min_rows: int = 95_000, max_rows: int = 105_000) -> list:
    target = store.name("customers") or "customers"
    return _gate(store, "customers", quality.customers_suite(target, min_rows, max_rows), execution_id,
                 execution_time)


def dq_customer_keys(store: Store, execution_id: str | None = None, execution_time: dt.datetime | None = None) -> list:
    """Stops the batch before the join if a customer id repeats (its claims would fan out)."""
    target = store.name("silver_customers") or "silver_customers"
    suite = quality.Suite(target, [quality.Unique("customer_id unique", "customer_id")])
    return _gate(store, "silver_customers", suite, execution_id, execution_time)


def gold_kpi(store: Store, clock: Column | None = None) -> DataFrame:
    store.write(gold.kpi_by_state(store.read("silver_claims_enriched"), built_at=_clock(clock)),
                "gold_claims_kpi_by_state")
    return store.read("gold_claims_kpi_by_state")


def gold_trends(store: Store, clock: Column | None = None) -> DataFrame:
    store.write(gold.monthly_trends(store.read("silver_claims_enriched"), built_at=_clock(clock)),
                "gold_monthly_claim_trends")
    return store.read("gold_monthly_claim_trends")


def gold_watchlist(store: Store) -> DataFrame:
    store.write(gold.high_risk_watchlist(store.read("silver_claims_enriched")), "gold_high_risk_watchlist")
    return store.read("gold_high_risk_watchlist")


def gold_trends_and_watchlist(store: Store, clock: Column | None = None) -> tuple[DataFrame, DataFrame]:
    return gold_trends(store, clock), gold_watchlist(store)


def classify(store: Store, **params) -> dict:
    """Train both forests on the hash sample, store the predictions of its
    test rows, return the test metrics."""
    enriched = store.read("silver_claims_enriched")
    models = ml.train_classifiers(enriched, **params)
    fraction = params.get("fraction", 0.1)
    seed = params.get("seed", 42)
    store.write(ml.claim_predictions(models, enriched, fraction=fraction, seed=seed), "gold_ml_claim_predictions")
    return models.metrics


def forecast(store: Store, **params) -> dict:
    models = ml.train_forecast(store.read("gold_monthly_claim_trends"), **params)
    try:
        store.write(ml.forecast_rows(models), "gold_ml_monthly_forecast")
        return models.metrics
    finally:
        models.release()


#: view -> (its definition, the table it reads)
VIEWS = {
    "vw_executive_claims_by_state": (gold.EXECUTIVE_VIEW, "gold_claims_kpi_by_state"),
    "vw_high_risk_claims_report": (gold.WATCHLIST_VIEW, "gold_high_risk_watchlist"),
}


def views(store: Store) -> None:
    """The two reporting views, from their one definition.  In a catalog database
    they are persistent views (other sessions and tools can query them); over
    path tables they are session views."""
    for name, (definition, table) in VIEWS.items():
        if store.database:
            store.spark.sql(f"CREATE OR REPLACE VIEW `{store.database}`.{name} AS {definition.format(table=f'`{store.database}`.{table}')}")
        else:
            store.spark.sql(definition, table=store.read(table)).createOrReplaceTempView(name)


JOBS = {
    "load-customers": lambda st, a: load_customers(st, a.input),
    "load-claims": lambda st, a: load_claims(st, a.input),
    "silver-customers": lambda st, a: silver_customers(st),
    "silver-claims": lambda st, a: silver_claims(st),
    "enrich": lambda st, a: claims_enriched(st),
    "dq-enriched": lambda st, a: dq_enriched(st),
    "dq-customers": lambda st, a: dq_customers(st),
    "gold-kpi": lambda st, a: gold_kpi(st),
    "gold-trends": lambda st, a: gold_trends_and_watchlist(st),
    "classify": lambda st, a: classify(st),
    "forecast": lambda st, a: forecast(st),
    "views": lambda st, a: views(st),
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="riskweave.plans.jobs")
    parser.add_argument("job", choices=sorted(JOBS))
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--database")
    where.add_argument("--base-path")
    parser.add_argument("--input", help="source file/folder for the load jobs")
    parser.add_argument("--format", default="parquet")
    args = parser.parse_args(argv)

    from riskweave.session import build_session, release_scratch

    spark: SparkSession = build_session(app_name=f"riskweave-{args.job}")
    store = Store(spark, database=args.database, base_path=args.base_path, fmt=args.format)
    try:
        JOBS[args.job](store, args)
    except quality.DataQualityError as e:
        print(f"DATA QUALITY FAILED: {e}", file=sys.stderr)
        return 1
    finally:
        release_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
