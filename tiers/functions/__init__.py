"""Column-level building blocks (all built-in Catalyst expressions; no UDFs)."""

from tiers.functions.casts import (
    DATE_PATTERN, MONTH_PATTERN, to_date_ymd, to_double, to_int, total_amount, year_month,
)
from tiers.functions.money import cents, money_avg, money_sum, round2
from tiers.functions.predicates import (
    COMPLETED, VALID_STATUSES, all_of, is_completed, key_not_null, passes, positive,
    quality_rules, status_valid,
)

__all__ = [
    "DATE_PATTERN", "MONTH_PATTERN", "to_date_ymd", "to_double", "to_int", "total_amount",
    "year_month", "cents", "money_avg", "money_sum", "round2", "COMPLETED", "VALID_STATUSES",
    "all_of", "is_completed", "key_not_null", "passes", "positive", "quality_rules", "status_valid",
]
