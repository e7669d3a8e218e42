"""Dashboard datasets (SQL-equivalent frames over the gold tables) and their widgets.

Datasets take the gold frames, so they run over stored tables (``*_from_tables``)
or straight over a gold lineage.  Widgets aggregate the *unsorted* dataset; the
sort is for display only.  Over empty gold tables every dataset still works: the
summary returns one row of NULLs, the sorted datasets none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers import config
from tiers.config import Env
from tiers.functions.money import money_sum, round2
from tiers.operators.widgets import Field, widget_query, widget_sql

REGION_SALES_COLUMNS = ("region", "year_month", "total_revenue", "order_count", "avg_order_value",
                        "unique_customers")
TOP_PRODUCTS_COLUMNS = ("product", "category", "total_revenue", "total_units_sold", "order_count",
                        "avg_unit_price")


# ---- datasets ---------------------------------------------------------------------------

def region_sales(gold_sales: DataFrame, sort: bool = True) -> DataFrame:
    df = gold_sales.select(*REGION_SALES_COLUMNS)
    return df.orderBy("region", "year_month") if sort else df


def top_products(gold_products: DataFrame, sort: bool = True) -> DataFrame:
    df = gold_products.select(*TOP_PRODUCTS_COLUMNS)
    return df.orderBy(F.col("total_revenue").desc()) if sort else df


def summary_metrics(gold_sales: DataFrame, exact_money: bool = False) -> DataFrame:
    """Headline figures; ``avg_order_value`` is the unweighted average of the
    per-(region, month) averages, exactly as the dashboard defines it."""
    return gold_sales.agg(
        round2(money_sum("total_revenue", exact_money)).alias("total_revenue"),
        F.sum("order_count").alias("total_orders"),
        round2(F.avg("avg_order_value")).alias("avg_order_value"),
    )


def datasets_from_tables(spark: SparkSession, env: Env) -> dict[str, DataFrame]:
    sales = spark.table(env.table(config.GOLD_SALES))
    products = spark.table(env.table(config.GOLD_PRODUCTS))
    return {
        "region_sales": region_sales(sales),
        "top_products": top_products(products),
        "summary_metrics": summary_metrics(sales),
    }


# ---- widgets ----------------------------------------------------------------------------
# The six data widgets (dataset, fields, disaggregated).  Counter output
# names are the dashboard's own (``sum(total_revenue)``, ...) unless ``names="plain"``.

def _counter(column: str, names: str) -> Field:
    return Field(column if names == "plain" else f"sum({column})", column, "sum")


def total_revenue_counter(summary: DataFrame, names: str = "dashboard", exact_money: bool = False) -> DataFrame:
    return widget_query(summary, [_counter("total_revenue", names)], exact_money=exact_money)


def total_orders_counter(summary: DataFrame, names: str = "dashboard") -> DataFrame:
    return widget_query(summary, [_counter("total_orders", names)])


def avg_order_value_counter(summary: DataFrame, names: str = "dashboard") -> DataFrame:
    return widget_query(summary, [_counter("avg_order_value", names)])


def revenue_by_region(region_sales_df: DataFrame, exact_money: bool = False) -> DataFrame:
    return widget_query(region_sales_df, [Field("region", "region"),
                                          Field("total_revenue", "total_revenue", "sum")],
                        exact_money=exact_money)


def revenue_trend(region_sales_df: DataFrame, exact_money: bool = False) -> DataFrame:
    return widget_query(region_sales_df, [Field("year_month", "year_month"),
                                          Field("total_revenue", "total_revenue", "sum")],
                        exact_money=exact_money)


def top_products_table(top_products_df: DataFrame) -> DataFrame:
    return widget_query(top_products_df, [Field("product", "product"), Field("category", "category"),
                                          Field("total_revenue", "total_revenue"),
                                          Field("total_units_sold", "total_units_sold")],
                        disaggregated=True)


def widgets_from_tables(spark: SparkSession, env: Env) -> dict[str, DataFrame]:
    sales = spark.table(env.table(config.GOLD_SALES))
    products = spark.table(env.table(config.GOLD_PRODUCTS))
    summary = summary_metrics(sales)
    unsorted_sales = region_sales(sales, sort=False)
    return {
        "total_revenue": total_revenue_counter(summary),
        "total_orders": total_orders_counter(summary),
        "avg_order_value": avg_order_value_counter(summary),
        "revenue_by_region": revenue_by_region(unsorted_sales),
        "revenue_trend": revenue_trend(unsorted_sales),
        "top_products": top_products_table(top_products(products)),
    }


# ---- the dashboard as stored: SQL text datasets and expression widgets -------------------
# Dataset SQL (body, display order) over a bound table name, and the six
# data widgets (dataset, fields as (name, SQL expression), disaggregated).

DATASET_SQL = {
    "region_sales": (
        "SELECT region, year_month, total_revenue, order_count, avg_order_value, unique_customers "
        "FROM IDENTIFIER(:table)",
        "region, year_month"),
    "top_products": (
        "SELECT product, category, total_revenue, total_units_sold, order_count, avg_unit_price "
        "FROM IDENTIFIER(:table)",
        "total_revenue DESC"),
    "summary_metrics": (
        "SELECT ROUND(SUM(total_revenue), 2) AS total_revenue, SUM(order_count) AS total_orders, "
        "ROUND(AVG(avg_order_value), 2) AS avg_order_value FROM IDENTIFIER(:table)",
        None),
}
DATASET_TABLE = {"region_sales": config.GOLD_SALES, "top_products": config.GOLD_PRODUCTS,
                 "summary_metrics": config.GOLD_SALES}

WIDGETS = {
    "total_revenue": ("summary_metrics", [("sum(total_revenue)", "SUM(`total_revenue`)")], False),
    "total_orders": ("summary_metrics", [("sum(total_orders)", "SUM(`total_orders`)")], False),
    "avg_order_value": ("summary_metrics", [("sum(avg_order_value)", "SUM(`avg_order_value`)")], False),
    "revenue_by_region": ("region_sales", [("region", "`region`"),
                                           ("total_revenue", "SUM(`total_revenue`)")], False),
    "revenue_trend": ("region_sales", [("year_month", "`year_month`"),
                                       ("total_revenue", "SUM(`total_revenue`)")], False),
    "top_products": ("top_products", [("product", "`product`"), ("category", "`category`"),
                                      ("total_revenue", "`total_revenue`"),
                                      ("total_units_sold", "`total_units_sold`")], True),
}


def dataset_sql(spark: SparkSession, env: Env, name: str, sort: bool = True) -> DataFrame:
    """Run a dataset's SQL text against ``env``'s gold table (bound with ``IDENTIFIER``)."""
    body, order = DATASET_SQL[name]
    text = f"{body} ORDER BY {order}" if (sort and order) else body
    return spark.sql(text, args={"table": env.table(DATASET_TABLE[name])})


def widget_from_sql(spark: SparkSession, env: Env, name: str) -> DataFrame:
    """A stored widget over its dataset; aggregating widgets read the dataset unsorted
    (a sort under a DOUBLE sum is not removed by the optimizer), table widgets keep the order."""
    dataset, fields, disaggregated = WIDGETS[name]
    return widget_sql(dataset_sql(spark, env, dataset, sort=disaggregated), fields, disaggregated)
