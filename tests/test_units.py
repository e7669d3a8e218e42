"""Small units: widgets, Env, money helpers, the broadcast bound."""

import math

import pytest
from pyspark.sql import functions as F

from tiers.config import Env
from tiers.functions.money import money_avg, money_sum
from tiers.operators.joins import broadcast_if_small
from tiers.operators.widgets import Field, widget_query, widget_sql


@pytest.fixture
def ds(spark):
    return spark.createDataFrame([("N", "a", 1.5), ("N", "b", 2.25), ("S", "a", 4.0), ("N", "a", 0.25)],
                                 "region string, ym string, rev double")


def test_widget_plain_fields_only_is_distinct(ds):
    out = widget_query(ds, [Field("region", "region")])
    assert sorted(r.region for r in out.collect()) == ["N", "S"]


def test_widget_sql_equals_structured(ds):
    a = widget_query(ds, [Field("region", "region"), Field("total", "rev", "sum"), Field("n", "rev", "count")])
    b = widget_sql(ds, [("region", "`region`"), ("total", "SUM(`rev`)"), ("n", "COUNT(`rev`)")])
    assert a.columns == b.columns == ["region", "total", "n"]
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    c = widget_sql(ds, [("r", "upper(`region`)"), ("ym", "`ym`")], disaggregated=True)
    assert c.count() == 4


def test_widget_rejects_unknown_aggregate(ds):
    with pytest.raises(ValueError):
        widget_query(ds, [Field("x", "rev", "median_of_medians")])


def test_env_landing():
    assert Env(schema="s", landing_root="hdfs:///lz/").landing == "hdfs:///lz/spark_catalog/s/raw_data"
    assert Env(schema="s", landing_path="/x/y").landing == "/x/y"
    with pytest.raises(ValueError):
        Env(schema="s").landing
    assert Env(schema="dev").with_schema("prod").table("t") == "spark_catalog.prod.t"


def test_exact_money_skips_nan_plain_keeps_it(spark):
    df = spark.createDataFrame([(1.10,), (2.20,), (float("nan"),)], "x double")
    r = df.agg(money_sum("x", exact=True).alias("e"), money_sum("x").alias("p"),
               money_avg("x", exact=True).alias("ea")).first()
    assert r["e"] == 3.3 and math.isnan(r["p"])
    assert r["ea"] == pytest.approx(1.65)


def test_broadcast_bound_is_checked(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    fact = spark.range(5000).select((F.col("id") % 10).alias("k"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only the explicit hint may broadcast
    try:
        joined_small = fact.join(broadcast_if_small(small, max_rows=100), "k")
        joined_big = fact.join(broadcast_if_small(big, max_rows=100), "k")
        assert "BroadcastHashJoin" in joined_small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in joined_big._jdf.queryExecution().executedPlan().toString()
        assert joined_small.count() == joined_big.count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_exact_money_beyond_bigint(spark):
    from pyspark.sql import functions as F

    from tiers.functions.money import money_avg, money_sum
    df = spark.range(40).select(F.lit(5e15).alias("x"))
    r = df.agg(money_sum("x", True).alias("s"), money_avg("x", True).alias("a")).first()
    assert (r["s"], r["a"]) == (2e17, 5e15)


@pytest.mark.parametrize("failing", [1, 2, 3])
def test_failing_swap_step_keeps_rows_under_the_name(spark, env, monkeypatch, failing):
    """A refresh that changes the schema: a failing rename puts the former table back."""
    from tiers.sources import tables
    name = env.table("swap_t")
    tables.overwrite_table(spark.range(3), name)
    session, calls = type(spark), []
    real = session.sql

    def sql(self, text, *a, **k):
        if "RENAME" in text or ("DROP" in text and "__previous" in text):
            calls.append(text)
            if len(calls) == failing:
                raise RuntimeError("injected")
        return real(self, text, *a, **k)

    monkeypatch.setattr(session, "sql", sql)
    with pytest.raises(RuntimeError, match="injected"):
        tables.overwrite_table(spark.range(5).selectExpr("id", "'x' AS tag"), name)
    monkeypatch.undo()
    assert spark.table(name).count() == (5 if failing == 3 else 3)
    assert tables.overwrite_table(spark.range(7), name) == 7
    assert [t.name for t in spark.catalog.listTables(env.namespace)] == ["swap_t"]


def test_synthetic_ids_beyond_the_modulus_differ(spark):
    from tiers.sources.synthetic import MODULUS, orders_from_ids
    ids = spark.createDataFrame([(k + j * MODULUS,) for k in range(1, 51) for j in (0, 1, 2)], "id long")
    rows = orders_from_ids(ids).drop("order_id").distinct().count()
    assert rows > 140
