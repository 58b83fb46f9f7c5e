"""The whole medallion batch: bronze -> silver -> enriched -> gate -> gold.

Each layer is written as a table and the next layer reads the stored
table, so a lost executor costs at most the current layer's recompute,
and every stage starts from a short lineage.  Independent writes
(bronze customers || claims, silver customers || claims, the gold tables)
are submitted from parallel driver threads; Spark runs their jobs side by
side on the cluster.  The data-quality gates (customer ids unique before the
join, the enriched suite after it) run before any gold table is written: a
failed check stores its result rows and stops the run.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.plans import jobs
from riskweave.plans.store import BRONZE, GOLD, HISTORY, SILVER, Store

__all__ = ["BRONZE", "GOLD", "HISTORY", "SILVER", "Store", "register_views", "run_medallion"]


def _parallel(tasks: list, parallel: bool) -> None:
    if not parallel or len(tasks) < 2:
        for t in tasks:
            t()
        return
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        for f in [pool.submit(t) for t in tasks]:
            f.result()


def run_medallion(
    spark: SparkSession,
    customers: DataFrame,
    claims: DataFrame,
    database: str | None = None,
    base_path: str | None = None,
    fmt: str = "parquet",
    gate: bool = True,
    parallel: bool = True,
    execution_id: str | None = None,
    execution_time: dt.datetime | None = None,
    clock: Column | None = None,
    hot_key_fraction: float | str | None = "auto",
    versioned: bool = False,
) -> dict:
    """Run every layer; return {table: location}.  ``clock`` defaults to
    ``current_timestamp()`` for the ``*_at`` columns.  ``versioned`` replaces path
    tables without a gap (see ``Store``)."""
    store = Store(spark, database, base_path, fmt, versioned)
    clock = F.current_timestamp() if clock is None else clock

    _parallel([lambda: store.write(customers, "customers"), lambda: store.write(claims, "claims")], parallel)
    _parallel([lambda: jobs.silver_customers(store, clock), lambda: jobs.silver_claims(store, clock)], parallel)
    if gate:  # an execution of its own: a run's rows replace those of the same id
        own = execution_id and f"{execution_id}-customers"
        jobs.dq_customer_keys(store, execution_id=own, execution_time=execution_time)
    jobs.claims_enriched(store, clock, hot_key_fraction=hot_key_fraction)
    if gate:
        jobs.dq_enriched(store, execution_id=execution_id, execution_time=execution_time)
    _parallel(
        [lambda: jobs.gold_kpi(store, clock), lambda: jobs.gold_trends(store, clock),
         lambda: jobs.gold_watchlist(store)],
        parallel,
    )
    return dict(store.written)


def register_views(spark: SparkSession, store: Store) -> None:
    """The two reporting views, as session views over the stored gold tables."""
    jobs.views(store)
