"""Quality rules and the gold selection predicate.

All are plain Catalyst predicates, so they push into Parquet scans
(``PushedFilters``) and, where legal, below the dedup shuffle.  Logic is
three-valued: a NULL operand makes the rule NULL and ``filter`` drops the row.
``status`` matching is case-sensitive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted statuses and the status that counts as a sale.
VALID_STATUSES = ("completed", "pending", "cancelled")
COMPLETED = "completed"


def key_not_null(key: str = "order_id") -> Column:
    return F.col(key).isNotNull()


def positive(c: str) -> Column:
    return F.col(c) > 0


def status_valid(c: str = "status", statuses: tuple[str, ...] = VALID_STATUSES) -> Column:
    return F.col(c).isin(*statuses)


def is_completed(c: str = "status") -> Column:
    return F.col(c) == F.lit(COMPLETED)


def all_of(*preds: Column) -> Column:
    return reduce(lambda a, b: a & b, preds)


def quality_rules() -> Column:
    """The silver rule set: key present, positive quantity and price, known status."""
    return all_of(key_not_null("order_id"), positive("quantity"), positive("unit_price"),
                  status_valid("status"))


def passes(pred: Column) -> Column:
    """Two-valued view of a rule: NULL counts as a failure (what ``filter`` does)."""
    return F.coalesce(pred, F.lit(False))
