"""Scalar column functions of the silver layer: casts, date parsing, derived columns.

Two cast modes:

* ``strict``  -- plain ``cast`` / ``to_date``.  Under ANSI mode (the Spark 4 default)
  a dirty value fails the job (``CAST_INVALID_INPUT``, ``CANNOT_PARSE_TIMESTAMP``);
  with ANSI off it degrades to NULL (and ``'3.7'`` → 3 for INT).
* ``lenient`` -- ``try_cast`` / ``try_to_date``: a dirty value becomes NULL and the
  quality filter drops the row.  Default.

Inherited hole, kept on purpose: ``'NaN'`` and ``'Infinity'`` are valid doubles, pass
``> 0`` and reach the sums.  No rule is added that the pipeline did not have.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Input date pattern and month-label pattern.
DATE_PATTERN = "yyyy-MM-dd"
MONTH_PATTERN = "yyyy-MM"

MODES = ("lenient", "strict")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"cast mode must be one of {MODES}, got {mode!r}")


def to_int(c: str | Column, mode: str = "lenient") -> Column:
    _check(mode)
    c = _col(c)
    return c.try_cast("int") if mode == "lenient" else c.cast("int")


def to_double(c: str | Column, mode: str = "lenient") -> Column:
    _check(mode)
    c = _col(c)
    return c.try_cast("double") if mode == "lenient" else c.cast("double")


def to_date_ymd(c: str | Column, mode: str = "lenient", pattern: str = DATE_PATTERN) -> Column:
    _check(mode)
    c = _col(c)
    return F.try_to_date(c, pattern) if mode == "lenient" else F.to_date(c, pattern)


def total_amount(quantity: str | Column = "quantity", unit_price: str | Column = "unit_price") -> Column:
    """INT × DOUBLE → DOUBLE, NULL if either side is NULL."""
    return _col(quantity) * _col(unit_price)


def year_month(order_date: str | Column = "order_date") -> Column:
    """``yyyy-MM`` label of a DATE; lexical order equals time order; NULL stays NULL."""
    return F.date_format(_col(order_date), MONTH_PATTERN)
