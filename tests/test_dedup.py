"""Deterministic dedup, NULL keys, and silver metrics."""

from tiers.plans import silver
from tiers.operators.dedup import dedup, drop_duplicates
from tests.test_casts import bronze_rows


def test_duplicate_key_keeps_first_by_order(spark):
    rows = [{"order_id": "A", "customer_id": "CUST-9"}, {"order_id": "A", "customer_id": "CUST-1"},
            {"order_id": "A", "customer_id": None}]
    out = silver.dedup_orders(silver.typed(bronze_rows(spark, rows))).collect()
    assert len(out) == 1 and out[0]["customer_id"] is None  # NULLs first


def test_null_keys_form_one_group(spark):
    rows = [{"order_id": None, "customer_id": "CUST-2"}, {"order_id": None, "customer_id": "CUST-1"}]
    typed = silver.typed(bronze_rows(spark, rows))
    d = silver.dedup_orders(typed).collect()
    assert len(d) == 1 and d[0]["customer_id"] == "CUST-1"
    assert silver.clean(typed).count() == 0
    assert drop_duplicates(typed, ["order_id"]).count() == 1


def test_bad_duplicate_can_displace_good_one(spark):
    # dedup runs before the filter: the survivor (quantity NULL sorts first) fails the rules
    rows = [{"order_id": "A", "quantity": "2"}, {"order_id": "A", "quantity": "abc"}]
    typed = silver.typed(bronze_rows(spark, rows))
    assert silver.dedup_orders(typed).first()["quantity"] is None
    assert silver.clean(typed).count() == 0


def test_dedup_is_stable_across_partitionings(spark):
    rows = [{"order_id": f"K{i % 7}", "customer_id": f"CUST-{(i * 37) % 11}", "quantity": str(i % 5)}
            for i in range(300)]
    typed = silver.typed(bronze_rows(spark, rows))
    a = sorted(map(tuple, silver.dedup_orders(typed.repartition(3)).collect()))
    b = sorted(map(tuple, silver.dedup_orders(typed.repartition(17)).collect()))
    assert a == b and len(a) == 7


def test_generic_dedup_default_order(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "z")], "k int, v string")
    assert sorted(map(tuple, dedup(df, ["k"]).collect()), key=lambda r: r[0]) == [(1, "a"), (2, None)]


def test_metrics_identity(spark):
    rows = [{"order_id": "A"}, {"order_id": "A", "customer_id": "CUST-0"}, {"order_id": None},
            {"order_id": None}, {"order_id": "B", "quantity": "0"}, {"order_id": "C"}]
    bronze = bronze_rows(spark, rows)
    m = silver.metrics(bronze).first().asDict()
    assert m == {"bronze_rows": 6, "duplicates": 2, "quality_drops": 2, "silver_rows": 2}
    s, counters = silver.silver_observed(bronze)
    assert s.count() == 2
    assert counters.report() == m


def test_metrics_on_empty_input(spark):
    m = silver.metrics(bronze_rows(spark, [{}]).limit(0)).first().asDict()
    assert m == {"bronze_rows": 0, "duplicates": 0, "quality_drops": 0, "silver_rows": 0}
