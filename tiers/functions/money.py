"""Aggregate helpers for money columns.

The pipeline's own aggregates are plain DOUBLE ``sum`` / ``avg``.  A DOUBLE sum
depends on the order rows arrive in, so two engines (or two runs with different
partitioning) can differ in the last bits.  With ``exact=True`` each value is
taken in whole cents (``round(x * 100)`` as BIGINT), the cents are summed as
DECIMAL(30,0) -- exact, order-free, map-side combined, and wide enough for totals beyond
BIGINT -- and the total is turned back into DOUBLE once, as ``cents / 100``.  The average is that total over the count of non-NULL values.

Exact mode is not the default: values that are not whole cents are rounded, and
NaN / Infinity become NULL instead of poisoning the sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(100.0)).try_cast("bigint")


def _cents_sum(c: str) -> Column:
    """The exact total in cents, as a DECIMAL(30,0): beyond BIGINT's 9.2e18 at large scale."""
    return F.sum(cents(c).cast("decimal(20,0)"))


def money_sum(c: str, exact: bool = False) -> Column:
    if not exact:
        return F.sum(c)
    return _cents_sum(c).cast("double") / F.lit(100.0)


def money_avg(c: str, exact: bool = False) -> Column:
    if not exact:
        return F.avg(c)
    return (_cents_sum(c).cast("double") / F.lit(100.0)) / F.count(cents(c))


def round2(c: str | Column) -> Column:
    """Round half-up to 2 digits (dashboard display)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 2)
