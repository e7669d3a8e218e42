"""Relational operators the layers are built from."""

from tiers.operators.dedup import dedup, drop_duplicates
from tiers.operators.joins import broadcast_if_small
from tiers.operators.metrics import Counter, count_rows
from tiers.operators.widgets import Field, widget_query, widget_sql

__all__ = ["dedup", "drop_duplicates", "broadcast_if_small", "Counter",
           "count_rows", "Field", "widget_query", "widget_sql"]
