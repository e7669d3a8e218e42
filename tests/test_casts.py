"""Cast modes and the quality rules on hand-made rows (FIXTURES §4)."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from tiers.plans import silver
from tiers.schemas import BRONZE_SCHEMA


def bronze_rows(spark, rows):
    base = dict(order_id="ORD-1", customer_id="CUST-1", product="p", category="c", quantity="1",
                unit_price="10.00", order_date="2024-01-05", region="North", status="completed")
    return spark.createDataFrame([{**base, **r} for r in rows], BRONZE_SCHEMA)


@pytest.mark.parametrize("raw,expected", [("3", 3), (" 3 ", 3), ("0", 0), ("-1", -1), ("abc", None),
                                          ("", None), ("3.7", None), ("99999999999", None)])
def test_lenient_quantity(spark, raw, expected):
    df = silver.typed(bronze_rows(spark, [{"quantity": raw}]))
    assert df.first()["quantity"] == expected


@pytest.mark.parametrize("raw,expected", [("10.50", 10.5), ("-1.00", -1.0), ("1e3", 1000.0), ("abc", None)])
def test_lenient_price(spark, raw, expected):
    assert silver.typed(bronze_rows(spark, [{"unit_price": raw}])).first()["unit_price"] == expected


@pytest.mark.parametrize("raw,expected", [
    ("2024-01-05", dt.date(2024, 1, 5)), ("31/12/1999", None), ("2024-02-30", None),
    ("01/02/2024", None), ("2024-01-05 10:00", None)])
def test_lenient_date_and_month(spark, raw, expected):
    row = silver.typed(bronze_rows(spark, [{"order_date": raw}])).first()
    assert row["order_date"] == expected
    assert row["year_month"] == (expected.strftime("%Y-%m") if expected else None)


def test_total_amount_null_propagates(spark):
    rows = silver.typed(bronze_rows(spark, [{"order_id": "a", "quantity": "2", "unit_price": "2.50"},
                                            {"order_id": "b", "quantity": "x"}])).orderBy("order_id").collect()
    assert rows[0]["total_amount"] == 5.0 and rows[1]["total_amount"] is None


def test_strict_mode_fails_on_dirty_value(spark):
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        pytest.skip("strict casts only fail under ANSI mode")
    with pytest.raises(PySparkException):
        silver.typed(bronze_rows(spark, [{"quantity": "n/a"}]), mode="strict").collect()
    with pytest.raises(PySparkException):
        silver.typed(bronze_rows(spark, [{"order_date": "31/12/1999"}]), mode="strict").collect()


def test_strict_mode_passes_clean_rows(spark):
    row = silver.typed(bronze_rows(spark, [{}]), mode="strict").first()
    assert (row["quantity"], row["unit_price"], row["order_date"]) == (1, 10.0, dt.date(2024, 1, 5))


def test_quality_rules(spark):
    cases = [
        ({"order_id": None}, False), ({"quantity": "0"}, False), ({"quantity": "-1"}, False),
        ({"quantity": ""}, False), ({"quantity": "abc"}, False), ({"quantity": "3.7"}, False),
        ({"quantity": " 3 "}, True), ({"unit_price": "0"}, False), ({"unit_price": "-1.00"}, False),
        ({"unit_price": ""}, False), ({"unit_price": "NaN"}, True), ({"unit_price": "Infinity"}, True),
        ({"status": None}, False), ({"status": "Completed"}, False), ({"status": "unknown"}, False),
        ({"status": "pending"}, True), ({"status": "cancelled"}, True),
        ({"order_date": "31/12/1999"}, True),
    ]
    rows = [{**r, "order_id": (f"ORD-{i}" if "order_id" not in r else r["order_id"])} for i, (r, _) in enumerate(cases)]
    kept = silver.clean(silver.typed(bronze_rows(spark, rows)))
    kept_ids = {r["order_id"] for r in kept.select("order_id").collect()}
    for i, (r, ok) in enumerate(cases):
        if r.get("order_id", "x") is None:
            assert None not in kept_ids
            continue
        assert (f"ORD-{i}" in kept_ids) == ok, r


def test_bad_date_kept_with_null_month(spark):
    row = silver.clean(silver.typed(bronze_rows(spark, [{"order_date": "31/12/1999"}]))).first()
    assert row["order_date"] is None and row["year_month"] is None


def test_missing_column_fails_at_analysis(spark):
    df = bronze_rows(spark, [{}]).drop("unit_price")
    with pytest.raises(PySparkException) as e:
        silver.typed(df).columns
    assert "unit_price" in str(e.value)
