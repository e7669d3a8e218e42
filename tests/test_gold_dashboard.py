"""Gold aggregates, dashboard datasets and widgets, empty state."""

import pytest

from tiers.plans import dashboard, gold, silver
from tiers.schemas import GOLD_PRODUCTS_SCHEMA, GOLD_SALES_SCHEMA, SILVER_SCHEMA
from tests.test_casts import bronze_rows


@pytest.fixture
def silver_df(spark):
    rows = [
        {"order_id": "1", "customer_id": "C1", "region": "North", "order_date": "2024-01-03", "quantity": "1", "unit_price": "10.00"},
        {"order_id": "2", "customer_id": "C1", "region": "North", "order_date": "2024-01-09", "quantity": "3", "unit_price": "20.00"},
        {"order_id": "3", "customer_id": "C2", "region": "North", "order_date": "2024-01-20", "quantity": "2", "unit_price": "5.00"},
        {"order_id": "4", "customer_id": "C3", "region": "South", "order_date": "2024-02-01", "quantity": "1", "unit_price": "100.00", "product": "q"},
        {"order_id": "5", "customer_id": "C3", "region": "South", "order_date": "2024-02-01", "quantity": "1", "unit_price": "100.00", "status": "pending"},
        {"order_id": "6", "customer_id": "C4", "region": "South", "order_date": "31/12/1999", "quantity": "1", "unit_price": "7.00"},
    ]
    return silver.silver(bronze_rows(spark, rows))


def test_sales_by_region(silver_df):
    rows = {(r["region"], r["year_month"]): r for r in gold.sales_by_region(silver_df).collect()}
    n = rows[("North", "2024-01")]
    assert (n["total_revenue"], n["order_count"], n["unique_customers"]) == (80.0, 3, 2)
    assert n["avg_order_value"] == pytest.approx(80.0 / 3)
    assert rows[("South", "2024-02")]["order_count"] == 1  # pending excluded
    assert rows[("South", None)]["total_revenue"] == 7.0  # bad date: NULL month group survives


def test_sales_sorted_nulls_first(silver_df):
    keys = [(r["region"], r["year_month"]) for r in gold.sales_by_region(silver_df).collect()]
    assert keys == [("North", "2024-01"), ("South", None), ("South", "2024-02")]


def test_top_products(silver_df):
    rows = gold.top_products(silver_df).collect()
    assert [r["product"] for r in rows] == ["q", "p"]  # by revenue desc, no top-k cut
    p = rows[1]
    assert (p["total_revenue"], p["total_units_sold"], p["order_count"]) == (87.0, 7, 4)
    assert p["avg_unit_price"] == pytest.approx((10 + 20 + 5 + 7) / 4)  # unweighted by quantity


def _types(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_gold_types(silver_df):
    assert _types(gold.sales_by_region(silver_df).schema) == _types(GOLD_SALES_SCHEMA)
    assert _types(gold.top_products(silver_df).schema) == _types(GOLD_PRODUCTS_SCHEMA)
    assert _types(silver_df.schema) == _types(SILVER_SCHEMA)


def test_exact_money_matches_plain_on_clean_data(silver_df):
    a = {r[0:2]: r for r in gold.sales_by_region(silver_df).collect()}
    b = {r[0:2]: r for r in gold.sales_by_region(silver_df, exact_money=True).collect()}
    for k in a:
        assert b[k]["total_revenue"] == pytest.approx(a[k]["total_revenue"], rel=1e-9)
        assert b[k]["avg_order_value"] == pytest.approx(a[k]["avg_order_value"], rel=1e-9)


def test_summary_is_average_of_averages(spark):
    g = spark.createDataFrame([("N", "2024-01", 100.0, 1, 100.0, 1), ("S", "2024-01", 60.0, 3, 20.0, 2)],
                              GOLD_SALES_SCHEMA)
    s = dashboard.summary_metrics(g).first()
    assert (s["total_revenue"], s["total_orders"]) == (160.0, 4)
    assert s["avg_order_value"] == 60.0  # (100 + 20) / 2, not 160 / 4 = 40


def test_round_half_up(spark):
    g = spark.createDataFrame([("N", "m", 1.005, 1, 2.675, 1)], GOLD_SALES_SCHEMA)
    s = dashboard.summary_metrics(g).first()
    assert s["total_revenue"] == 1.01 and s["avg_order_value"] == 2.68


def test_empty_state(spark):
    sales = spark.createDataFrame([], GOLD_SALES_SCHEMA)
    products = spark.createDataFrame([], GOLD_PRODUCTS_SCHEMA)
    summary = dashboard.summary_metrics(sales)
    assert [tuple(r) for r in summary.collect()] == [(None, None, None)]
    assert dashboard.region_sales(sales).count() == 0
    assert dashboard.top_products(products).count() == 0
    assert [tuple(r) for r in dashboard.total_revenue_counter(summary).collect()] == [(None,)]
    assert dashboard.revenue_by_region(dashboard.region_sales(sales, sort=False)).count() == 0
    assert dashboard.top_products_table(dashboard.top_products(products)).count() == 0


def test_widgets(silver_df):
    g = gold.sales_by_region(silver_df, sort=False)
    summary = dashboard.summary_metrics(g)
    assert dashboard.total_revenue_counter(summary).columns == ["sum(total_revenue)"]
    assert dashboard.total_orders_counter(summary, names="plain").first()["total_orders"] == 5
    by_region = {r["region"]: r["total_revenue"] for r in dashboard.revenue_by_region(dashboard.region_sales(g, sort=False)).collect()}
    assert by_region == {"North": 80.0, "South": 107.0}
    trend = {r["year_month"]: r["total_revenue"] for r in dashboard.revenue_trend(dashboard.region_sales(g, sort=False)).collect()}
    assert trend == {"2024-01": 80.0, "2024-02": 100.0, None: 7.0}
    table = dashboard.top_products_table(dashboard.top_products(gold.top_products(silver_df)))
    assert table.columns == ["product", "category", "total_revenue", "total_units_sold"]
