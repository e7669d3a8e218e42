"""Property test: silver and both gold tables equal a plain-Python brute force on random dirty rows."""

import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tiers.plans import gold, silver
from tiers.schemas import BRONZE_SCHEMA

# value pools with the typed value each string must produce (None = unparsable)
QUANTITY = {"1": 1, "2": 2, "5": 5, "0": 0, "-1": -1, "": None, "abc": None, "3.7": None, " 3 ": 3, None: None}
PRICE = {"10.00": 10.0, "2.50": 2.5, "0": 0.0, "-1.00": -1.0, "": None, "abc": None, "1e3": 1000.0, None: None}
DATE = {"2024-01-05": dt.date(2024, 1, 5), "2024-02-29": dt.date(2024, 2, 29), "2023-12-31": dt.date(2023, 12, 31),
        "31/12/1999": None, "2024-02-30": None, None: None}
STATUS = ["completed", "pending", "cancelled", "Completed", "unknown", None]
ORDER_ID = ["A", "B", "C", "D", "E", None]
CUSTOMER = ["C1", "C2", "C3", None]
REGION = ["North", "South", None]
PRODUCT = [("p", "c"), ("q", "c"), ("r", "d")]

row_strategy = st.fixed_dictionaries({
    "order_id": st.sampled_from(ORDER_ID), "customer_id": st.sampled_from(CUSTOMER),
    "product": st.sampled_from(PRODUCT), "quantity": st.sampled_from(list(QUANTITY)),
    "unit_price": st.sampled_from(list(PRICE)), "order_date": st.sampled_from(list(DATE)),
    "region": st.sampled_from(REGION), "status": st.sampled_from(STATUS),
})


def _typed(r):
    q, p, d = QUANTITY[r["quantity"]], PRICE[r["unit_price"]], DATE[r["order_date"]]
    return {"order_id": r["order_id"], "customer_id": r["customer_id"], "product": r["product"][0],
            "category": r["product"][1], "quantity": q, "unit_price": p, "order_date": d,
            "region": r["region"], "status": r["status"],
            "total_amount": q * p if q is not None and p is not None else None,
            "year_month": d.strftime("%Y-%m") if d else None}


def _nulls_first(values):
    return tuple((v is not None, v) for v in values)


def brute_silver(rows):
    groups = defaultdict(list)
    for r in map(_typed, rows):
        groups[r["order_id"]].append(r)
    survivors = [min(g, key=lambda r: _nulls_first([r[c] for c in silver.DEDUP_ORDER])) for g in groups.values()]
    return [r for r in survivors if r["order_id"] is not None and (r["quantity"] or 0) > 0
            and (r["unit_price"] or 0) > 0 and r["status"] in ("completed", "pending", "cancelled")]


def brute_gold(silver_rows):
    sales, products = defaultdict(list), defaultdict(list)
    for r in silver_rows:
        if r["status"] == "completed":
            sales[(r["region"], r["year_month"])].append(r)
            products[(r["product"], r["category"])].append(r)
    s = {k: (sum(r["total_amount"] for r in g), len(g), sum(r["total_amount"] for r in g) / len(g),
             len({r["customer_id"] for r in g if r["customer_id"] is not None})) for k, g in sales.items()}
    p = {k: (sum(r["total_amount"] for r in g), sum(r["quantity"] for r in g), len(g),
             sum(r["unit_price"] for r in g) / len(g)) for k, g in products.items()}
    return s, p


def _close(a, b):
    return all(x == y or (isinstance(x, float) and abs(x - y) <= 1e-9 * max(1.0, abs(y))) for x, y in zip(a, b))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_strategy, min_size=0, max_size=40))
def test_pipeline_equals_brute_force(spark, rows):
    bronze = spark.createDataFrame(
        [{**r, "product": r["product"][0], "category": r["product"][1]} for r in rows], BRONZE_SCHEMA)
    got = silver.silver(bronze)
    cols = got.columns
    want = brute_silver(rows)
    key = lambda t: repr(t)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((tuple(r[c] for c in cols) for r in want), key=key)

    want_sales, want_products = brute_gold(want)
    got_sales = {(r[0], r[1]): tuple(r[2:]) for r in gold.sales_by_region(got).collect()}
    got_products = {(r[0], r[1]): tuple(r[2:]) for r in gold.top_products(got).collect()}
    assert got_sales.keys() == want_sales.keys() and got_products.keys() == want_products.keys()
    for k in want_sales:
        assert _close(got_sales[k], want_sales[k]), (k, got_sales[k], want_sales[k])
    for k in want_products:
        assert _close(got_products[k], want_products[k]), (k, got_products[k], want_products[k])

    m = silver.metrics(bronze).first()
    assert (m["bronze_rows"], m["silver_rows"]) == (len(rows), len(want))
    assert m["duplicates"] == len(rows) - len({r["order_id"] for r in rows})
