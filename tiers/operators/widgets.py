"""Dashboard widget query: field expressions over a dataset.

A widget lists fields; each is either a plain column or an aggregate of one.
Unless the widget is ``disaggregated``, the result is grouped by the plain
fields and the aggregates are computed per group (no plain field → one global
row).  A disaggregated widget is a plain projection of the dataset.

Two front ends: ``widget_query`` takes structured ``Field``s (and can sum money
exactly); ``widget_sql`` takes the fields as SQL expressions, as a dashboard
stores them (``"SUM(`total_revenue`)"``), and lets Spark's ``GROUP BY ALL``
group by every non-aggregate field.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiers.functions.money import money_avg, money_sum


@dataclass(frozen=True)
class Field:
    """``name``: output column; ``column``: dataset column; ``agg``: None or an aggregate name."""

    name: str
    column: str
    agg: str | None = None


_AGGS = {
    "sum": F.sum,
    "avg": F.avg,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "count_distinct": F.count_distinct,
}


def _aggregate(f: Field, exact_money: bool) -> Column:
    if f.agg == "sum" and exact_money:
        return money_sum(f.column, exact=True)
    if f.agg == "avg" and exact_money:
        return money_avg(f.column, exact=True)
    if f.agg not in _AGGS:
        raise ValueError(f"unknown aggregate {f.agg!r} for field {f.name!r}")
    return _AGGS[f.agg](F.col(f.column))


def widget_query(dataset: DataFrame, fields: Sequence[Field], disaggregated: bool = False,
                 exact_money: bool = False) -> DataFrame:
    """Evaluate a widget over ``dataset`` (pass the dataset *unsorted*: a sort below a
    DOUBLE sum is not removed by the optimizer and would cost a range shuffle)."""
    if disaggregated:
        return dataset.select(*[F.col(f.column).alias(f.name) for f in fields])
    plain = [f for f in fields if f.agg is None]
    aggs = [_aggregate(f, exact_money).alias(f.name) for f in fields if f.agg is not None]
    if not aggs:
        return dataset.select(*[F.col(f.column).alias(f.name) for f in plain]).distinct()
    grouped = dataset.groupBy(*[F.col(f.column).alias(f.name) for f in plain])
    return grouped.agg(*aggs).select(*[f.name for f in fields])


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def widget_sql(dataset: DataFrame, fields: Sequence[tuple[str, str]], disaggregated: bool = False) -> DataFrame:
    """Evaluate ``(name, sql_expression)`` fields over ``dataset``."""
    exprs = [f"{expr} AS {_quote(name)}" for name, expr in fields]
    if disaggregated:
        return dataset.selectExpr(*exprs)
    return dataset.sparkSession.sql(f"SELECT {', '.join(exprs)} FROM {{dataset}} GROUP BY ALL", dataset=dataset)
