"""A key holding a third of all rows is cut down before the shuffle (measured, not assumed)."""

from pyspark.sql import functions as F

from tiers.operators.dedup import dedup
from tiers.plans import gold, silver
from tests.test_casts import bronze_rows

MAP_TASKS = 6


def _metrics(node):
    out, it = {}, node.metrics().iterator()
    while it.hasNext():
        kv = it.next()
        out[kv._1()] = kv._2().value()
    return out


def shuffle_records(df) -> list[int]:
    """Run ``df`` (collect) and return the records written by each shuffle of its final plan."""
    df.collect()
    found = []

    def walk(node):
        if "QueryStage" in node.nodeName():
            walk(node.plan())
            return
        if node.nodeName() == "Exchange":
            found.append(_metrics(node).get("shuffleRecordsWritten", -1))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    return found


def _hot(spark, n):
    """n rows over MAP_TASKS partitions; every third row has key HOT."""
    return spark.range(n, numPartitions=MAP_TASKS).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), F.col("id").cast("string")))
        .alias("k"),
        (F.col("id") % 97).alias("v"))


def test_dedup_hot_key_sends_one_row_per_map_task(spark):
    n = 30_000
    out = dedup(_hot(spark, n), ["k"], ["v"])
    records = shuffle_records(out)
    cold = n - n // 3
    assert records == [cold + MAP_TASKS]  # 10,000 hot rows → 6 shuffled rows
    assert out.count() == cold + 1


def test_null_key_group_is_one_row_per_map_task(spark):
    rows = [{"order_id": None if i % 3 == 0 else f"O{i}", "customer_id": f"C{i % 50}"} for i in range(3000)]
    typed = silver.typed(bronze_rows(spark, rows).repartition(MAP_TASKS))
    records = shuffle_records(silver.dedup_orders(typed))
    assert records[0] == 2000 + MAP_TASKS  # records[1] is the repartition itself


def test_gold_hot_group_is_combined_map_side(spark):
    n = 30_000
    rows = _hot(spark, n).select(
        F.lit("completed").alias("status"),
        F.when(F.col("k") == "HOT", F.lit("North")).otherwise(F.concat(F.lit("R"), (F.col("v") % 5).cast("string")))
        .alias("region"),
        F.lit("2024-01").alias("year_month"), F.col("k").alias("order_id"),
        F.concat(F.lit("C"), (F.col("v") % 7).cast("string")).alias("customer_id"),
        (F.col("v") + 1).cast("double").alias("total_amount"))
    records = shuffle_records(gold.sales_by_region(rows, sort=False))
    # (keys, customer) then keys: bounded by distinct groups × map tasks, not by rows
    assert all(r <= 6 * 7 * MAP_TASKS for r in records), records


def _scan_rows(df) -> int:
    df.collect()
    rows = []

    def walk(node):
        if "QueryStage" in node.nodeName():
            walk(node.plan())
            return
        if node.nodeName().startswith("Scan"):
            rows.append(_metrics(node)["numOutputRows"])
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    return sum(rows)


def test_clustered_silver_lets_gold_skip_row_groups(spark, env):
    from tiers import config
    from tiers.plans import pipeline
    from tiers.sources.synthetic import synthetic_orders
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = hadoop.get("parquet.block.size")
    hadoop.set("parquet.block.size", str(32 * 1024))  # many small row groups
    try:
        scanned = {}
        for cluster in ((), ("status",)):
            e = env.with_(silver_cluster_by=cluster)
            pipeline.bootstrap(spark, e, landing_rows=synthetic_orders(spark, 60_000, seed=11))
            pipeline.run(spark, e)
            silver_rows = spark.table(e.table(config.SILVER)).count()
            scanned[cluster] = _scan_rows(gold.sales_by_region(spark.table(e.table(config.SILVER)), sort=False))
        completed = spark.table(env.table(config.SILVER)).filter("status = 'completed'").count()
        assert scanned[()] == silver_rows                     # unclustered: every row group is read
        assert completed <= scanned[("status",)] < 0.8 * silver_rows  # clustered: other statuses skipped
    finally:
        if before is None:
            hadoop.unset("parquet.block.size")
        else:
            hadoop.set("parquet.block.size", before)
