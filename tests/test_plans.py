"""Physical-plan checks: pushdown, pruning, one dedup shuffle with map-side limit, no Python."""


from tiers import config
from tiers.plans import gold, pipeline, silver
from tiers.sources import orders_feed
from tiers.sources.synthetic import synthetic_orders
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_has_partial_limit_before_one_shuffle(spark):
    s = silver.silver(orders_feed(spark, SF_SMALL))
    p = plan(s)
    assert "WindowGroupLimit" in p
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) and final
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_gold_pushes_status_and_prunes_columns(spark, env):
    pipeline.bootstrap(spark, env, landing_rows=synthetic_orders(spark, 200))
    pipeline.run(spark, env)
    g = gold.sales_by_region(spark.table(env.table(config.SILVER)))
    p = plan(g)
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,completed)]" in p
    scan = [line for line in p.splitlines() if "ReadSchema" in line][0]
    read_schema = scan[scan.index("ReadSchema"):]
    for unused in ("product", "category", "unit_price", "order_date", "quantity"):
        assert f"{unused}:" not in read_schema
    assert "Python" not in p


def test_feed_never_broadcasts_growing_tables(spark):
    from tiers.sources.tpch_feed import build_orders_feed
    p = plan(build_orders_feed(spark, SF_SMALL))
    assert p.count("SortMergeJoin") == 3
    assert p.count("BroadcastHashJoin") == 2  # nation, region (size-checked)


def test_dedup_shuffles_no_derived_column(spark):
    typed = silver.typed(orders_feed(spark, SF_SMALL))
    kept = silver.dedup_orders(typed)
    child = kept._jdf.queryExecution().executedPlan().toString()
    below = child[child.index("Exchange hashpartitioning"):]
    assert "total_amount" not in below and "year_month" not in below
    assert kept.columns == typed.columns


def test_feed_joins_orders_last(spark):
    from tiers.sources.tpch_feed import build_orders_feed
    last = next(line for line in plan(build_orders_feed(spark, SF_SMALL)).splitlines() if "SortMergeJoin" in line)
    assert "l_orderkey" in last


def test_feed_is_sized_by_its_bytes(spark, monkeypatch):
    from tiers.sources import sized_feed, tpch_feed
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(tpch_feed, "partitions_for", lambda n: 1234 if n else 0)
    rows = sized_feed(spark, SF_SMALL)
    assert rows.sparkSession.conf.get(key) == "1234" and spark.conf.get(key, None) is None
    assert int(rows.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")) <= 16 * 1024 * 1024
    assert rows.exceptAll(orders_feed(rows.sparkSession, SF_SMALL)).count() == 0
    assert rows.count() == orders_feed(spark, SF_SMALL).count()
    assert all("zstd" in f for f in rows.inputFiles())


def test_plan_bytes_are_the_files(spark):
    import os
    from tiers.session import plan_bytes
    path = f"{SF_SMALL}/lineitem.parquet"
    assert plan_bytes(spark.read.parquet(path)) == os.path.getsize(path)


def test_partitions_follow_the_bytes():
    from tiers.session import MAX_PARTITIONS, partitions_for
    assert partitions_for(0) == 1 and partitions_for(6 * 10 ** 9) > 300 and partitions_for(10 ** 15) == MAX_PARTITIONS


def test_landing_is_written_without_a_stored_feed(spark):
    import __spark_entry__ as entry
    from tiers.sources import tpch_feed
    own = spark.newSession()
    env = entry._landing_env(own, SF_SMALL)
    assert not any(k[1] == id(own) and k[3] for k in tpch_feed._FEEDS)
    assert spark.read.option("header", "true").csv(env.landing).count() == orders_feed(spark, SF_SMALL).count()
