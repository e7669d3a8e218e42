"""The whole schema surface: landing/bronze, silver, the two gold tables, the preflight report."""

from __future__ import annotations

from pyspark.sql import types as T

from tiers import config

# Landing column names, in file order.
LANDING_COLUMNS = (
    "order_id", "customer_id", "product", "category", "quantity",
    "unit_price", "order_date", "region", "status",
)

BRONZE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in LANDING_COLUMNS])

SILVER_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("region", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("year_month", T.StringType()),
])

GOLD_SALES_SCHEMA = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("year_month", T.StringType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("avg_order_value", T.DoubleType()),
    T.StructField("unique_customers", T.LongType()),
])

GOLD_PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("total_units_sold", T.LongType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("avg_unit_price", T.DoubleType()),
])

PREFLIGHT_SCHEMA = T.StructType([
    T.StructField("run_date", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("csv_files", T.LongType()),
    T.StructField("csv_bytes", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("cols", T.IntegerType()),
    T.StructField("columns", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("reason", T.StringType()),
])

TABLE_SCHEMAS = {
    config.BRONZE: BRONZE_SCHEMA,
    config.SILVER: SILVER_SCHEMA,
    config.GOLD_SALES: GOLD_SALES_SCHEMA,
    config.GOLD_PRODUCTS: GOLD_PRODUCTS_SCHEMA,
}
