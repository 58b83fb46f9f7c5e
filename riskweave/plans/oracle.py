"""Reference SQL for each registered query, in DuckDB's dialect.

Written independently of the Spark code: the fixture views are SQL text,
each layer is a CTE, and the rules are re-stated in DuckDB terms
(``isodow`` Monday = 1, ``to_months`` for month arithmetic, integer
half-up rounding for exact means).  The driver's tables are registered as
views named after the Parquet files.
"""

from __future__ import annotations

FIXTURE_CUSTOMERS = """
SELECT c_custkey AS customer_id,
 CASE WHEN c_custkey % 60 = 1 THEN NULL ELSE CAST(12 + c_custkey % 95 AS INT) END AS age,
 CASE WHEN c_custkey % 40 = 3 THEN NULL
      WHEN c_custkey % 7 = 0 THEN CONCAT('  ', LOWER(st), ' ') ELSE st END AS state,
 CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE (c_acctbal + 1000.0E0) / 11000.0E0 END AS fraud_risk_score
FROM (SELECT c_custkey, c_acctbal, CASE c_nationkey % 10 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'FL' WHEN 3 THEN 'NY' WHEN 4 THEN 'PA'
 WHEN 5 THEN 'IL' WHEN 6 THEN 'OH' WHEN 7 THEN 'GA' WHEN 8 THEN 'NC' ELSE 'MI' END AS st FROM customer) c
"""

FIXTURE_CLAIMS = """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS claim_id,
 o_orderkey * 10 + 1 AS policy_id, o_custkey AS customer_id,
 CAST(o_orderdate AS TIMESTAMP) + INTERVAL '23' YEAR + CASE WHEN o_orderkey % 3 = 0 THEN INTERVAL '10' HOUR ELSE INTERVAL '0' HOUR END AS claim_date,
 CASE WHEN o_orderkey % 53 = 0 THEN -o_totalprice ELSE o_totalprice END AS claim_amount,
 CASE WHEN o_orderkey % 20 = 19 THEN 'Cancelled' WHEN o_orderstatus = 'F' THEN 'Approved' WHEN o_orderstatus = 'O' THEN 'Pending'
      WHEN o_orderkey % 2 = 0 THEN 'Denied' ELSE 'In Review' END AS claim_status,
 CASE SUBSTRING(o_orderpriority, 1, 1) WHEN '1' THEN 'Auto' WHEN '2' THEN 'Home' WHEN '3' THEN 'Health' WHEN '4' THEN 'Life' ELSE 'Travel' END AS policy_type,
 CASE WHEN o_orderkey % 4 = 0 THEN 'Accident' WHEN o_orderkey % 4 = 1 THEN 'Theft' WHEN o_orderkey % 4 = 2 THEN 'Illness' ELSE 'Damage' END AS claim_type
FROM orders
"""


def _fixed_holiday(x: str) -> str:
    return (
        f"((month({x}) = 1 AND day({x}) = 1) OR (month({x}) = 6 AND day({x}) = 19 AND year({x}) >= 2021)"
        f" OR (month({x}) = 7 AND day({x}) = 4) OR (month({x}) = 11 AND day({x}) = 11)"
        f" OR (month({x}) = 12 AND day({x}) = 25))"
    )


def holiday_sql(ts: str) -> str:
    x = f"CAST({ts} AS DATE)"
    nth = f"((day({x}) - 1) // 7 + 1)"
    rules = (
        f"((month({x}) = 1 AND isodow({x}) = 1 AND {nth} = 3)"
        f" OR (month({x}) = 2 AND isodow({x}) = 1 AND {nth} = 3)"
        f" OR (month({x}) = 5 AND isodow({x}) = 1 AND day({x} + 7) <= 7)"
        f" OR (month({x}) = 9 AND isodow({x}) = 1 AND {nth} = 1)"
        f" OR (month({x}) = 10 AND isodow({x}) = 1 AND {nth} = 2)"
        f" OR (month({x}) = 11 AND isodow({x}) = 4 AND {nth} = 4))"
    )
    return (
        f"CASE WHEN {ts} IS NULL THEN NULL ELSE ({_fixed_holiday(x)} OR {rules}"
        f" OR (isodow({x}) = 5 AND {_fixed_holiday(f'({x} + 1)')})"
        f" OR (isodow({x}) = 1 AND {_fixed_holiday(f'({x} - 1)')})) END"
    )


def months_sql(ts: str, end: str = "2024-12-31 00:00:00") -> str:
    e = f"TIMESTAMP '{end}'"
    cal = f"CAST((year({e}) - year({ts})) * 12 + month({e}) - month({ts}) AS INTEGER)"
    moved = f"({ts} + to_months({cal}))"
    return (
        f"CASE WHEN {ts} IS NULL THEN NULL WHEN {ts} <= {e} AND {moved} > {e} THEN {cal} - 1"
        f" WHEN {ts} > {e} AND {moved} < {e} THEN {cal} + 1 ELSE {cal} END"
    )


def exact_avg(col: str, digits: int = 2, scale: int = 8) -> str:
    """ROUND(AVG(col), digits), half-up, as DOUBLE: integer arithmetic on the
    sum at ``scale`` digits, so a tie does not hang on a DOUBLE's last bit."""
    units = f"CAST(SUM(CAST({col} AS DECIMAL(28,{scale}))) * {10**scale} AS HUGEINT)"
    n = f"(COUNT({col}) * {10 ** (scale - digits)})"
    return (
        f"(CASE WHEN {units} >= 0 THEN ({units} * 2 + {n}) // ({n} * 2)"
        f" ELSE -((-{units} * 2 + {n}) // ({n} * 2)) END) / {10**digits}.0E0"
    )


BASE = f"""
WITH customers AS ({FIXTURE_CUSTOMERS}),
claims AS ({FIXTURE_CLAIMS}),
customers_base AS (
  SELECT customer_id, CAST(age AS INTEGER) AS age, upper(trim(state)) AS state,
         CAST(fraud_risk_score AS DOUBLE) AS fraud_risk_score,
         CASE WHEN fraud_risk_score >= 0.85 THEN 'HIGH' WHEN fraud_risk_score >= 0.60 THEN 'MEDIUM' ELSE 'LOW' END
           AS fraud_risk_band
  FROM customers
  WHERE customer_id IS NOT NULL AND state IS NOT NULL AND age >= 18 AND age <= 100
),
silver_customers AS (
  SELECT customer_id, age, state, fraud_risk_score,
    ROUND((fraud_risk_score - AVG(fraud_risk_score) OVER ())
          / NULLIF(STDDEV_POP(fraud_risk_score) OVER (), 0), 6) AS fraud_risk_zscore,
    CASE WHEN fraud_risk_score IS NULL THEN NULL ELSE
      (CAST(RANK() OVER (ORDER BY fraud_risk_score) AS DOUBLE)
        + (COUNT(*) OVER (PARTITION BY fraud_risk_score) - 1) / 2.0E0)
      / COUNT(fraud_risk_score) OVER () * 100.0E0 END AS fraud_risk_percentile,
    fraud_risk_band
  FROM customers_base
),
silver_claims AS (
  SELECT claim_id, policy_id, customer_id, claim_date, CAST(claim_amount AS DOUBLE) AS claim_amount,
    upper(trim(claim_status)) AS claim_status, policy_type, claim_type,
    {holiday_sql('claim_date')} AS is_us_federal_holiday,
    {months_sql('claim_date')} AS months_to_book_end,
    date_trunc('month', claim_date) AS claim_month
  FROM claims
  WHERE claim_id IS NOT NULL AND customer_id IS NOT NULL AND claim_date IS NOT NULL
    AND claim_amount > 0 AND claim_status IN ('Approved', 'Pending', 'Denied', 'In Review')
),
enriched AS (
  SELECT cl.claim_id, cl.policy_id, cl.customer_id, cl.claim_date, cl.claim_month, cl.claim_amount,
    cl.claim_status, cl.policy_type, cl.claim_type, cu.age, cu.state, cu.fraud_risk_score, cu.fraud_risk_band
  FROM silver_claims cl JOIN customers_base cu ON cl.customer_id = cu.customer_id
),
kpi AS (
  SELECT state, policy_type, COUNT(*) AS claim_count,
    ROUND(SUM(claim_amount), 2) AS total_claim_amount,
    {exact_avg('claim_amount')} AS avg_claim_amount,
    ROUND(AVG(fraud_risk_score), 4) AS avg_fraud_risk_score,
    CAST(SUM(CASE WHEN fraud_risk_band = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_customer_claims,
    CAST(SUM(CASE WHEN claim_status = 'DENIED' THEN 1 ELSE 0 END) AS BIGINT) AS denied_claims
  FROM enriched GROUP BY state, policy_type
),
trends AS (
  SELECT claim_month, policy_type, COUNT(*) AS claim_count,
    ROUND(SUM(claim_amount), 2) AS total_claim_amount,
    {exact_avg('claim_amount')} AS avg_claim_amount
  FROM enriched GROUP BY claim_month, policy_type
),
watchlist AS (
  SELECT claim_id, customer_id, state, policy_type, claim_type, claim_amount, claim_status,
    fraud_risk_score, fraud_risk_band, claim_date
  FROM enriched
  WHERE fraud_risk_band = 'HIGH' AND claim_amount >= 50000 AND claim_status IN ('APPROVED', 'PENDING', 'IN REVIEW')
),
executive AS (
  SELECT state, CAST(SUM(claim_count) AS BIGINT) AS total_claims,
    ROUND(SUM(total_claim_amount), 2) AS total_claim_amount,
    {exact_avg('avg_fraud_risk_score', 4)} AS avg_fraud_risk_score,
    CAST(SUM(high_risk_customer_claims) AS BIGINT) AS high_risk_claims,
    CAST(SUM(denied_claims) AS BIGINT) AS denied_claims
  FROM kpi GROUP BY state
)
"""


def _q(body: str) -> str:
    return BASE + body


ORACLE: dict[str, str] = {
    "bronze_claims": _q("SELECT * FROM claims"),
    "claims_by_policy": _q("SELECT policy_type, COUNT(*) AS cnt FROM claims GROUP BY policy_type"),
    "silver_customers": _q("SELECT * FROM silver_customers"),
    "silver_claims": _q("SELECT * FROM silver_claims"),
    "claims_enriched": _q("SELECT * FROM enriched"),
    "claims_by_state_top5": _q(
        "SELECT state, COUNT(*) AS claims FROM enriched GROUP BY state ORDER BY claims DESC, state LIMIT 5"
    ),
    "holiday_summary": _q(
        "SELECT CAST(SUM(CASE WHEN is_us_federal_holiday THEN 1 ELSE 0 END) AS BIGINT) AS holiday_claims,"
        " ROUND(AVG(months_to_book_end), 2) AS avg_months_to_book_end FROM silver_claims"
    ),
    "holiday_claims": _q(
        "SELECT claim_id, claim_date, is_us_federal_holiday, months_to_book_end, claim_amount"
        " FROM silver_claims WHERE is_us_federal_holiday"
    ),
    "band_avg_percentile": _q(
        "SELECT fraud_risk_band, ROUND(AVG(fraud_risk_percentile), 2) AS avg_pct"
        " FROM silver_customers GROUP BY fraud_risk_band"
    ),
    "kpi_by_state": _q("SELECT * FROM kpi"),
    "kpi_top10": _q("SELECT * FROM kpi ORDER BY total_claim_amount DESC, state, policy_type LIMIT 10"),
    "monthly_trends": _q("SELECT * FROM trends"),
    "high_risk_watchlist": _q("SELECT * FROM watchlist"),
    "executive_by_state": _q("SELECT * FROM executive"),
    "watchlist_report": _q(
        "SELECT claim_id, customer_id, state, policy_type, claim_type, claim_amount, claim_status,"
        " fraud_risk_score, claim_date FROM watchlist"
    ),
    "top_states_by_amount": _q("SELECT * FROM executive ORDER BY total_claim_amount DESC, state LIMIT 5"),
    "watchlist_pending": _q(
        "SELECT CAST(COUNT(*) FILTER (WHERE claim_status = 'PENDING') AS BIGINT) AS claims FROM watchlist"
    ),
    "policy_compare": _q(
        "SELECT policy_type, CAST(SUM(claim_count) AS BIGINT) AS claim_count,"
        f" ROUND(SUM(total_claim_amount), 2) AS total_claim_amount"
        " FROM kpi WHERE policy_type IN ('Auto', 'Home') GROUP BY policy_type"
    ),
    "watchlist_by_policy": _q("SELECT policy_type, COUNT(*) AS count FROM watchlist GROUP BY policy_type"),
    "watchlist_by_state": _q("SELECT state, COUNT(*) AS count FROM watchlist GROUP BY state"),
    "watchlist_top10": _q(
        "SELECT claim_id, state, policy_type, claim_amount, fraud_risk_score FROM watchlist"
        " ORDER BY claim_amount DESC, claim_id LIMIT 10"
    ),
    "denied_vs_high_risk": _q(
        "SELECT state, CAST(SUM(claim_count) AS BIGINT) AS claim_count,"
        " CAST(SUM(denied_claims) AS BIGINT) AS denied_claims,"
        " CAST(SUM(high_risk_customer_claims) AS BIGINT) AS high_risk_claims"
        " FROM kpi WHERE state = 'CA' GROUP BY state"
    ),
    "layer_counts": _q(
        "SELECT 'customers' AS layer, COUNT(*) AS rows FROM customers"
        " UNION ALL SELECT 'claims', COUNT(*) FROM claims"
        " UNION ALL SELECT 'silver_customers', COUNT(*) FROM customers_base"
        " UNION ALL SELECT 'silver_claims', COUNT(*) FROM silver_claims"
        " UNION ALL SELECT 'silver_claims_enriched', COUNT(*) FROM enriched"
        " UNION ALL SELECT 'gold_claims_kpi_by_state', COUNT(*) FROM kpi"
        " UNION ALL SELECT 'gold_monthly_claim_trends', COUNT(*) FROM trends"
        " UNION ALL SELECT 'gold_high_risk_watchlist', COUNT(*) FROM watchlist"
    ),
    "trend_month_ordinal": _q(
        "SELECT claim_month, policy_type, claim_count,"
        " CAST((year(claim_month) - 2022) * 12 + month(claim_month) AS INTEGER) AS month_ordinal FROM trends"
    ),
    "distinct_months": _q("SELECT DISTINCT claim_month FROM trends"),
}


# ---- windows and forecasts ----------------------------------------------------

_FEATURES = """
SELECT claim_month, policy_type, claim_count,
  LAG(claim_count, 1) OVER (PARTITION BY policy_type ORDER BY claim_month) AS prev_claim_count,
  LAG(claim_count, 2) OVER (PARTITION BY policy_type ORDER BY claim_month) AS prev2_claim_count,
  AVG(claim_count) OVER (PARTITION BY policy_type ORDER BY claim_month
                         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_avg_3m
FROM trends
"""

_MONTHLY_TOTAL = f"""
SELECT claim_month, CAST(SUM(claim_count) AS BIGINT) AS claim_count,
  CAST(ROW_NUMBER() OVER (ORDER BY claim_month) - 1 AS INTEGER) AS t
FROM ({_FEATURES}) f GROUP BY claim_month
"""

ORACLE.update({
    "trend_lags": _q(
        f"SELECT claim_month, policy_type, claim_count, prev_claim_count, prev2_claim_count FROM ({_FEATURES}) f"
    ),
    "rolling_avg_3m": _q(f"SELECT claim_month, policy_type, claim_count, rolling_avg_3m FROM ({_FEATURES}) f"),
    "rolling_forecast": _q(
        "SELECT policy_type, claim_month, claim_count, rolling_avg_3m AS forecast_next_month_claim_count"
        f" FROM ({_FEATURES}) f"
        " QUALIFY ROW_NUMBER() OVER (PARTITION BY policy_type ORDER BY claim_month DESC) = 1"
    ),
    "monthly_total": _q(_MONTHLY_TOTAL),
    "linear_trend_forecast": _q(
        "SELECT COUNT(*) AS n_months,"
        " ROUND(REGR_SLOPE(CAST(claim_count AS DOUBLE), CAST(t AS DOUBLE)), 6) AS slope,"
        " ROUND(REGR_INTERCEPT(CAST(claim_count AS DOUBLE), CAST(t AS DOUBLE)), 6) AS intercept,"
        " CAST(MAX(t) + 1 AS INTEGER) AS next_t,"
        " ROUND(REGR_SLOPE(CAST(claim_count AS DOUBLE), CAST(t AS DOUBLE)) * (MAX(t) + 1)"
        "   + REGR_INTERCEPT(CAST(claim_count AS DOUBLE), CAST(t AS DOUBLE)), 6) AS forecast_next_month"
        f" FROM ({_MONTHLY_TOTAL}) m"
    ),
})


# ---- sampling -----------------------------------------------------------------

def unit_hash_sql(key: str, salt: str) -> str:
    return (
        f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{salt}'), 1, 8)) AS UBIGINT)"
        " / 4294967296.0E0)"
    )


_SAMPLE = f"SELECT * FROM enriched WHERE {unit_hash_sql('claim_id', 'sample42')} < 0.1"

ORACLE.update({
    "hash_sample": _q(_SAMPLE),
    "hash_split": _q(
        "SELECT claim_id, customer_id, policy_type, claim_amount,"
        f" CASE WHEN {unit_hash_sql('claim_id', 'split42')} < 0.8 THEN 'train' ELSE 'test' END AS split"
        f" FROM ({_SAMPLE}) s"
    ),
})


# ---- data quality ---------------------------------------------------------------

def _check_rows(source: str, target: str, checks: list[tuple]) -> str:
    """checks: (name, kind, column, arg) with kind in notnull, between, inset,
    unique, ratio, rowcount."""
    parts = []
    for name, kind, col, arg in checks:
        if kind == "notnull":
            elem, unexp, ok = "COUNT(*)", f"COUNT(*) FILTER (WHERE {col} IS NULL)", "NULL::BOOLEAN"
        elif kind in ("between", "inset"):
            elem, unexp, ok = "COUNT(*)", f"COUNT(*) FILTER (WHERE {col} IS NOT NULL AND NOT ({arg}))", "NULL::BOOLEAN"
        elif kind == "unique":
            elem = "COUNT(*)"
            unexp = (f"COALESCE((SELECT SUM(c) FROM (SELECT COUNT(*) AS c FROM {source} WHERE {col} IS NOT NULL"
                     f" GROUP BY {col} HAVING COUNT(*) > 1) d), 0)")
            ok = "NULL::BOOLEAN"
        elif kind == "ratio":
            elem, unexp = "NULL::BIGINT", "NULL::BIGINT"
            ok = f"COALESCE(COUNT(DISTINCT {col}) / NULLIF(COUNT({col}), 0) {arg}, false)"
        else:  # rowcount
            elem, unexp, ok = "NULL::BIGINT", "NULL::BIGINT", f"COUNT(*) {arg}"
        parts.append(f"SELECT '{name}' AS check_name, {elem} AS element_count, {unexp} AS unexpected_count,"
                     f" {ok} AS ok FROM {source}")
    union = " UNION ALL ".join(parts)
    return (
        f"SELECT '{target}' AS target_table, check_name,"
        " CASE WHEN success THEN 1.0E0"
        " WHEN element_count > 0 AND unexpected_count IS NOT NULL"
        " THEN GREATEST(0.0E0, 1.0E0 - unexpected_count / element_count) ELSE 0.0E0 END AS dq_score,"
        " success, CAST(element_count AS BIGINT) AS element_count, CAST(unexpected_count AS BIGINT) AS unexpected_count"
        " FROM (SELECT *, COALESCE(ok, unexpected_count = 0) AS success FROM (" + union + ") u) r"
    )


_STATES = "('CA', 'TX', 'FL', 'NY', 'PA', 'IL', 'OH', 'GA', 'NC', 'MI')"

_ENRICHED_CHECKS = [
    ("claim_id not null", "notnull", "claim_id", None),
    ("customer_id not null", "notnull", "customer_id", None),
    ("claim_amount positive", "between", "claim_amount", "claim_amount > 0"),
    ("fraud_risk_score in [0,1]", "between", "fraud_risk_score", "fraud_risk_score BETWEEN 0 AND 1"),
    ("state valid", "inset", "state", f"state IN {_STATES}"),
    ("fraud_risk_band valid", "inset", "fraud_risk_band", "fraud_risk_band IN ('LOW', 'MEDIUM', 'HIGH')"),
    ("claim_id mostly unique", "ratio", "claim_id", ">= 0.999"),
]

_CUSTOMER_CHECKS = [
    ("customer_id not null", "notnull", "customer_id", None),
    ("customer_id unique", "unique", "customer_id", None),
    ("age in range", "between", "age", "age BETWEEN 18 AND 100"),
    ("state valid", "inset", "state", f"state IN {_STATES}"),
    ("fraud_risk_score in [0,1]", "between", "fraud_risk_score", "fraud_risk_score BETWEEN 0 AND 1"),
    ("row count ~100k", "rowcount", None, "BETWEEN 95000 AND 105000"),
]

_LINEITEM_CHECKS = [
    ("l_orderkey not null", "notnull", "l_orderkey", None),
    ("l_orderkey unique", "unique", "l_orderkey", None),
    ("l_orderkey mostly unique", "ratio", "l_orderkey", ">= 0.999"),
    ("row count", "rowcount", None, ">= 1"),
]


def _sample_rows(source: str, checks: list[tuple], k: int = 5) -> str:
    parts = []
    for name, kind, col, arg in checks:
        if kind == "notnull":
            bad = f"SELECT DISTINCT {col} AS v FROM {source} WHERE {col} IS NULL"
        elif kind in ("between", "inset"):
            bad = f"SELECT DISTINCT {col} AS v FROM {source} WHERE {col} IS NOT NULL AND NOT ({arg})"
        elif kind == "unique":
            bad = f"SELECT {col} AS v FROM {source} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1"
        else:
            continue
        parts.append(f"(SELECT '{name}' AS check_name, CAST(v AS VARCHAR) AS unexpected_value"
                     f" FROM ({bad}) b ORDER BY v NULLS FIRST LIMIT {k})")
    return " UNION ALL ".join(parts)


ORACLE.update({
    "dq_enriched": _q(_check_rows("enriched", "silver_claims_enriched", _ENRICHED_CHECKS)),
    "dq_customers": _q(_check_rows("customers", "customers", _CUSTOMER_CHECKS)),
    "dq_unique_lineitem": _q(_check_rows("lineitem", "lineitem", _LINEITEM_CHECKS)),
    "dq_unexpected_sample": _q(_sample_rows("customers", _CUSTOMER_CHECKS)),
})


# ---- sources, sinks, the whole batch, history ------------------------------------

_DQ_BOTH = (
    "SELECT 'run-enriched' AS execution_id, TIMESTAMP '2025-01-01 06:00:00' AS execution_time, * FROM ("
    + _check_rows("enriched", "silver_claims_enriched", _ENRICHED_CHECKS)
    + ") a UNION ALL SELECT 'run-customers', TIMESTAMP '2025-01-01 06:05:00', * FROM ("
    + _check_rows("customers", "customers", _CUSTOMER_CHECKS)
    + ") b"
)

ORACLE.update({
    "bronze_customers_csv": _q("SELECT * FROM customers"),
    "medallion_run": ORACLE["layer_counts"],
    "silver_claims_stream": ORACLE["silver_claims"],
    "enriched_stream": ORACLE["claims_enriched"],
    "dq_history": _q(
        "SELECT execution_id, execution_time, target_table, check_name, dq_score, success, element_count,"
        f" unexpected_count FROM ({_DQ_BOTH}) h"
    ),
    "dq_run_summary": _q(
        "SELECT target_table, execution_id, COUNT(*) AS checks, MIN(execution_time) AS ran_at"
        f" FROM ({_DQ_BOTH}) h GROUP BY target_table, execution_id"
    ),
    "dq_gate": _q(
        "SELECT target_table, CASE WHEN COUNT(*) FILTER (WHERE NOT success) = 0 THEN 'PASSED' ELSE 'FAILED' END"
        " AS gate, COUNT(*) FILTER (WHERE NOT success) AS failed_checks"
        f" FROM ({_DQ_BOTH}) h GROUP BY target_table"
    ),
})


# ---- narrow function keys ----------------------------------------------------------

_RAW_CALENDAR = (
    f"SELECT claim_id, claim_date, {holiday_sql('claim_date')} AS is_us_federal_holiday FROM claims"
)
_RAW_MONTHS = f"SELECT claim_id, claim_date, {months_sql('claim_date')} AS months_to_book_end FROM claims"

ORACLE.update({
    "risk_band": _q("SELECT customer_id, fraud_risk_score, fraud_risk_band FROM customers_base"),
    "risk_zscore": _q("SELECT customer_id, fraud_risk_score, fraud_risk_zscore FROM silver_customers"),
    "risk_percentile": _q("SELECT customer_id, fraud_risk_score, fraud_risk_percentile FROM silver_customers"),
    "is_holiday": _q(_RAW_CALENDAR),
    "months_to_book_end": _q(_RAW_MONTHS),
    "sql_function_use": _q(
        f"SELECT claim_id, claim_date, {holiday_sql('claim_date')} AS is_us_federal_holiday,"
        f" {months_sql('claim_date')} AS months_to_book_end FROM claims"
    ),
    "forecast_split": _q(
        "SELECT claim_month, policy_type, claim_count,"
        " CASE WHEN DENSE_RANK() OVER (ORDER BY claim_month DESC) <= 3 THEN 'holdout' ELSE 'train' END AS split"
        " FROM trends"
    ),
})


# ---- the survey's key names ----------------------------------------------------------

ORACLE.update({
    "bronze_customers": ORACLE["bronze_customers_csv"],
    "watchlist": ORACLE["high_risk_watchlist"],
    "load_audit_by_policy": _q(
        "SELECT policy_type, FALSE AS is_total, COUNT(*) AS cnt FROM claims GROUP BY policy_type"
        " UNION ALL SELECT NULL, TRUE, COUNT(*) FROM claims"
    ),
    "load_audit_customers": _q(
        "SELECT COUNT(*) AS cnt, COUNT(*) - COUNT(customer_id) AS null_customer_id, COUNT(*) - COUNT(age) AS null_age,"
        " COUNT(*) - COUNT(state) AS null_state, COUNT(*) - COUNT(fraud_risk_score) AS null_fraud_risk_score FROM customers"
    ),
    "stored_silver_customers": ORACLE["silver_customers"],
    "stored_enriched": ORACLE["claims_enriched"],
    "stored_kpi": ORACLE["kpi_by_state"],
    "stored_trends": ORACLE["monthly_trends"],
    "stored_watchlist": ORACLE["high_risk_watchlist"],
    "stored_executive_view": ORACLE["executive_by_state"],
    "stored_watchlist_view": ORACLE["watchlist_report"],
    "dq_execution_results": _q(
        "SELECT execution_id, execution_time, target_table, check_name, dq_score, success, element_count,"
        f" unexpected_count FROM ({_DQ_BOTH}) h WHERE execution_id = 'run-customers'"
    ),
    "month_spine": _q(
        "SELECT s.claim_month, s.policy_type, COALESCE(m.n, 0) AS claim_count FROM ("
        "  SELECT policy_type, UNNEST(generate_series(MIN(date_trunc('month', claim_date)), MAX(date_trunc('month', claim_date)),"
        "   INTERVAL 1 MONTH)) AS claim_month FROM watchlist GROUP BY policy_type) s"
        " LEFT JOIN (SELECT policy_type, date_trunc('month', claim_date) AS claim_month, COUNT(*) AS n FROM watchlist"
        "  GROUP BY 1, 2) m ON m.policy_type = s.policy_type AND m.claim_month = s.claim_month"
    ),
    "holiday_claims_sample": _q(
        "SELECT claim_id, claim_date, is_us_federal_holiday, months_to_book_end, claim_amount"
        " FROM silver_claims WHERE is_us_federal_holiday ORDER BY claim_date, claim_id LIMIT 5"
    ),
    "dq_unique": _q(_check_rows("customers", "customers", [c for c in _CUSTOMER_CHECKS if c[1] == "unique"])),
    "dq_unique_ratio": _q(_check_rows("enriched", "silver_claims_enriched",
                                      [c for c in _ENRICHED_CHECKS if c[1] == "ratio"])),
    "dq_row_count": _q(_check_rows("customers", "customers", [c for c in _CUSTOMER_CHECKS if c[1] == "rowcount"])),
    "dq_suite": _q(
        "SELECT * FROM (" + _check_rows("enriched", "silver_claims_enriched", _ENRICHED_CHECKS)
        + ") a UNION ALL SELECT * FROM (" + _check_rows("customers", "customers", _CUSTOMER_CHECKS) + ") b"
    ),
})

ORACLE["dq_history_recent"] = _q(
    "SELECT execution_id, execution_time, check_name, dq_score, success"
    f" FROM ({_DQ_BOTH}) h WHERE target_table = 'customers' ORDER BY execution_time DESC, check_name LIMIT 12"
)

ORACLE["monthly_trends_stream"] = ORACLE["monthly_trends"]


# ---- models' tables and metrics ------------------------------------------------------

_MODELLED = f"""
SELECT *, CASE WHEN {unit_hash_sql('claim_id', 'sample42')} >= 0.1 THEN 'unsampled'
  WHEN {unit_hash_sql('claim_id', 'split42')} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM enriched
WHERE claim_amount IS NOT NULL AND age IS NOT NULL AND fraud_risk_score IS NOT NULL AND state IS NOT NULL
  AND claim_type IS NOT NULL AND policy_type IS NOT NULL AND claim_status IS NOT NULL
"""

_ENCODER = f"""
SELECT feature, category, CAST(ROW_NUMBER() OVER (PARTITION BY feature ORDER BY n DESC, category) - 1 AS DOUBLE) AS position, n
FROM (
  SELECT 'state' AS feature, state AS category, COUNT(*) AS n FROM ({_MODELLED}) m WHERE split = 'train' GROUP BY state
  UNION ALL SELECT 'claim_type', claim_type, COUNT(*) FROM ({_MODELLED}) m WHERE split = 'train' GROUP BY claim_type
  UNION ALL SELECT 'policy_type', policy_type, COUNT(*) FROM ({_MODELLED}) m WHERE split = 'train' GROUP BY policy_type) c
"""


def _class_mean(expr: str) -> str:
    return f"SUM(({expr}) * w) / SUM(w)"


ORACLE.update({
    # ranks with ties averaged; twice the rank sum is an integer, so nothing is rounded before the last division
    "score_auc": _q(
        "SELECT policy_type, CAST(p AS BIGINT) AS positives, CAST(n - p AS BIGINT) AS negatives,"
        " CASE WHEN p > 0 AND n > p THEN (r2 - p * (p + 1)) / (2.0E0 * p * (n - p)) END AS auc FROM ("
        "  SELECT policy_type, SUM(y) AS p, COUNT(*) AS n, SUM(y * r2) AS r2 FROM ("
        "   SELECT policy_type, CASE WHEN claim_status = 'DENIED' THEN 1 ELSE 0 END AS y,"
        "    2 * RANK() OVER (PARTITION BY policy_type ORDER BY fraud_risk_score)"
        "    + COUNT(*) OVER (PARTITION BY policy_type, fraud_risk_score) - 1 AS r2"
        "   FROM enriched WHERE fraud_risk_score IS NOT NULL) x GROUP BY policy_type) s"
    ),
    "rule_metrics": _q(
        "SELECT policy_type, CAST(SUM(w) AS BIGINT) AS rows, " + _class_mean("CASE WHEN w > 0 THEN hit / w ELSE 0 END") + " AS accuracy, "
        + _class_mean("CASE WHEN said > 0 THEN hit / said ELSE 0 END") + " AS precision, "
        + _class_mean("CASE WHEN w > 0 THEN hit / w ELSE 0 END") + " AS recall, "
        + _class_mean("CASE WHEN w + said > 0 THEN 2 * hit / (w + said) ELSE 0 END") + " AS f1 FROM ("
        "  SELECT policy_type, c.y, SUM(CASE WHEN (claim_status = 'DENIED') = c.y THEN 1.0E0 ELSE 0 END) AS w,"
        "   SUM(CASE WHEN (fraud_risk_band = 'HIGH') = c.y THEN 1.0E0 ELSE 0 END) AS said,"
        "   SUM(CASE WHEN (claim_status = 'DENIED') = c.y AND (fraud_risk_band = 'HIGH') = c.y THEN 1.0E0 ELSE 0 END) AS hit"
        "  FROM enriched, (VALUES (TRUE), (FALSE)) c(y) GROUP BY policy_type, c.y) k GROUP BY policy_type"
    ),
    "ml_encoder": _q(_ENCODER),
    "ml_features": _q(
        f"SELECT claim_id, split, state_idx, claim_type_idx, policy_label, is_denied, claim_amount AS feature_claim_amount,"
        " CAST(age AS DOUBLE) AS feature_age, fraud_risk_score AS feature_fraud_risk_score, state_idx AS feature_state_idx,"
        " claim_type_idx AS feature_claim_type_idx FROM ("
        "  SELECT m.*, COALESCE(s.position, (SELECT CAST(COUNT(*) AS DOUBLE) FROM enc WHERE feature = 'state')) AS state_idx,"
        "   COALESCE(t.position, (SELECT CAST(COUNT(*) AS DOUBLE) FROM enc WHERE feature = 'claim_type')) AS claim_type_idx,"
        "   p.position AS policy_label, CASE WHEN claim_status = 'DENIED' THEN 1.0E0 ELSE 0.0E0 END AS is_denied"
        "  FROM modelled m LEFT JOIN enc s ON s.feature = 'state' AND s.category = m.state"
        "  LEFT JOIN enc t ON t.feature = 'claim_type' AND t.category = m.claim_type"
        "  JOIN enc p ON p.feature = 'policy_type' AND p.category = m.policy_type) f"
    ).replace("SELECT claim_id, split, state_idx", f", modelled AS ({_MODELLED}), enc AS ({_ENCODER}) SELECT claim_id, split, state_idx", 1),
    "forecast_actuals": _q(
        "SELECT claim_month, policy_type, metric, actual_value, 'holdout' AS forecast_type FROM ("
        "  SELECT claim_month, policy_type, 'claim_count' AS metric, CAST(claim_count AS DOUBLE) AS actual_value,"
        "   DENSE_RANK() OVER (ORDER BY claim_month DESC) AS r FROM trends"
        "  UNION ALL SELECT claim_month, policy_type, 'total_claim_amount', total_claim_amount,"
        "   DENSE_RANK() OVER (ORDER BY claim_month DESC) FROM trends) x WHERE r <= 3"
    ),
    "forecast_forward_frame": _q(
        "SELECT CAST(NULL AS TIMESTAMP) AS claim_month, policy_type, CAST(NULL AS DOUBLE) AS claim_count,"
        " CAST(NULL AS DOUBLE) AS total_claim_amount, 'forward' AS forecast_type,"
        " CAST((SELECT MAX((year(claim_month) - 2022) * 12 + month(claim_month)) FROM trends) + 1 AS DOUBLE) AS step"
        " FROM (SELECT DISTINCT policy_type FROM trends) p"
    ),
})


# ---- rejects, incremental gold, stored sketches ---------------------------------------

_FAULTS = (
    ("customer_id", "not bigint", "customer_id % 19 = 0 AND customer_id % 23 <> 0", "'C' || customer_id"),
    ("customer_id", "no value", "customer_id % 23 = 0", "NULL"),
    ("age", "not int", "customer_id % 13 = 0", "'abc'"),
    ("fraud_risk_score", "not double", "customer_id % 17 = 0", "'n/a'"),
)


def _distinct_row(column: str) -> str:
    return (
        f"SELECT '{column}' AS field, COUNT(DISTINCT customer_id % 4) AS loads, CAST(COUNT(*) AS BIGINT) AS rows,"
        f" COUNT({column}) AS nonnull, COUNT(DISTINCT {column}) AS distinct_exact, TRUE AS within_bound FROM customers_base"
    )


ORACLE.update({
    "bronze_customers_rejects": _q(" UNION ALL ".join(
        f"SELECT customer_id AS row_no, '{c}' AS field, '{why}' AS reason, {value} AS value FROM customers WHERE {when}" for c, why, when, value in _FAULTS
    )),
    "gold_incremental": _q(
        ", corrected AS (SELECT state, policy_type, fraud_risk_score, fraud_risk_band,"
        " CASE WHEN claim_id % 7 = 0 THEN claim_amount * 2 ELSE claim_amount END AS claim_amount,"
        " CASE WHEN claim_id % 7 = 0 THEN 'DENIED' ELSE claim_status END AS claim_status FROM enriched)"
        " SELECT state, policy_type, COUNT(*) AS claim_count, ROUND(SUM(claim_amount), 2) AS total_claim_amount,"
        f" {exact_avg('claim_amount')} AS avg_claim_amount, ROUND(AVG(fraud_risk_score), 4) AS avg_fraud_risk_score,"
        " CAST(SUM(CASE WHEN fraud_risk_band = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_customer_claims,"
        " CAST(SUM(CASE WHEN claim_status = 'DENIED' THEN 1 ELSE 0 END) AS BIGINT) AS denied_claims"
        " FROM corrected GROUP BY state, policy_type"
    ),
    "distinct_from_states": _q(" UNION ALL ".join(_distinct_row(c) for c in ("customer_id", "state", "fraud_risk_score"))),
    "percentile_from_states": ORACLE["risk_percentile"],
    "catalog_executive_view": ORACLE["executive_by_state"],
    "catalog_watchlist_view": ORACLE["watchlist_report"],
})
