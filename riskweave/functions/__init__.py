"""Column expressions (all native Catalyst expressions, no Python UDFs)."""

from riskweave.functions.aggregates import count_where, money_avg, money_sum
from riskweave.functions.calendar import (
    is_us_federal_holiday,
    month_ordinal,
    month_start,
    months_to_book_end,
    register_sql_functions,
)
from riskweave.functions.risk import risk_band

__all__ = [
    "count_where", "is_us_federal_holiday", "money_avg", "money_sum", "month_ordinal", "month_start",
    "months_to_book_end", "register_sql_functions", "risk_band",
]
