"""Synthetic orders: domains, determinism, scale."""

from pyspark.sql import functions as F

from tiers.sources import synthetic as syn
from tiers.plans import silver


def test_domains_500(spark):
    df = syn.synthetic_orders(spark, 500, seed=42)
    rows = df.collect()
    assert len(rows) == 500 and len({r["order_id"] for r in rows}) == 500
    assert rows[0]["order_id"].startswith("ORD-") and len(rows[0]["order_id"]) == 9
    products = {(p, c): b for p, c, b in syn.PRODUCTS}
    for r in rows:
        assert (r["product"], r["category"]) in products
        base = products[(r["product"], r["category"])]
        assert 0.95 * base - 0.01 <= float(r["unit_price"]) <= 1.05 * base + 0.01
        assert r["unit_price"].split(".")[1].__len__() == 2
        assert 1 <= int(r["quantity"]) <= 5
        assert "2024-01-01" <= r["order_date"] <= "2024-03-30"
        assert r["region"] in syn.REGIONS
        assert 1 <= int(r["customer_id"][5:]) <= 100
    t = silver.typed(df)
    assert silver.clean(t).count() == 500


def test_deterministic_and_partition_free(spark):
    a = syn.synthetic_orders(spark, 2000, seed=7, num_partitions=1).collect()
    b = syn.synthetic_orders(spark, 2000, seed=7, num_partitions=13).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    c = syn.synthetic_orders(spark, 2000, seed=8).collect()
    assert sorted(map(tuple, a)) != sorted(map(tuple, c))


def test_distribution_at_a_million(spark):
    df = syn.synthetic_orders(spark, 1_000_000, seed=42)
    stats = {r["status"]: r["n"] for r in df.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(stats["completed"] / 1e6 - 0.7) < 0.01
    assert abs(stats["pending"] / 1e6 - 0.2) < 0.01
    assert abs(stats["cancelled"] / 1e6 - 0.1) < 0.01
    agg = df.agg(F.count_distinct("customer_id").alias("c"), F.count_distinct("product").alias("p"),
                 F.count_distinct("order_date").alias("d"), F.count_distinct("region").alias("r"),
                 F.count_distinct("order_id").alias("o")).first()
    assert (agg["c"], agg["p"], agg["d"], agg["r"], agg["o"]) == (100, 10, 90, 4, 1_000_000)
    per_product = [r["n"] for r in df.groupBy("product").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(per_product) / min(per_product) < 1.05
