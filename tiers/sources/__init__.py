"""Sources and sinks: landing CSV, catalog tables, synthetic orders, TPC-H orders feed."""

from tiers.sources.landing import landing_inventory, read_landing
from tiers.sources.synthetic import orders_from_ids, synthetic_orders
from tiers.sources.tables import (
    create_schema, create_tables, overwrite_table, preview, write_csv,
)
from tiers.sources.tpch_feed import orders_feed, sized_feed, sized_joins

__all__ = [
    "landing_inventory", "read_landing", "orders_from_ids", "synthetic_orders", "create_schema",
    "create_tables", "overwrite_table", "preview", "write_csv", "orders_feed", "sized_feed", "sized_joins",
]
