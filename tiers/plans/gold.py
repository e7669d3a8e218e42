"""Gold layer: completed orders aggregated by region × month and by product × category.

Both read only the columns they need and push ``status = 'completed'`` into the
silver scan.  Aggregates combine map-side; the exact distinct count of customers
is planned by Catalyst as one extra shuffle on (keys, customer_id), again
combined map-side, so a hot group or a hot customer never lands whole in one task.
The final sort is on the aggregated rows: few for region and month, one per product otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.functions.money import money_avg, money_sum
from tiers.functions.predicates import is_completed


def sales_by_region(silver: DataFrame, exact_money: bool = False, sort: bool = True) -> DataFrame:
    g = (silver.filter(is_completed())
         .groupBy("region", "year_month")
         .agg(money_sum("total_amount", exact_money).alias("total_revenue"),
              F.count("order_id").alias("order_count"),
              money_avg("total_amount", exact_money).alias("avg_order_value"),
              F.count_distinct("customer_id").alias("unique_customers")))
    return g.orderBy("region", "year_month") if sort else g


def top_products(silver: DataFrame, exact_money: bool = False, sort: bool = True) -> DataFrame:
    """All products by revenue (no top-k: every product is kept)."""
    g = (silver.filter(is_completed())
         .groupBy("product", "category")
         .agg(money_sum("total_amount", exact_money).alias("total_revenue"),
              F.sum("quantity").cast("bigint").alias("total_units_sold"),
              F.count("order_id").alias("order_count"),
              money_avg("unit_price", exact_money).alias("avg_unit_price")))
    return g.orderBy(F.col("total_revenue").desc()) if sort else g
