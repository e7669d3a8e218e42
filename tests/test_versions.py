"""Publishing a refresh by one catalog change, recovery of killed runs, and steps with their own sizes."""

from __future__ import annotations

import re
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tiers import config
from tiers.plans import pipeline, silver
from tiers.plans.sizing import GroupEstimate, estimate
from tiers.schemas import LANDING_COLUMNS
from tiers.session import step_session
from tiers.sources import tables, versions
from tiers.sources.synthetic import synthetic_orders


class Killed(BaseException):
    """Ends a run at a point; nothing in the library handles it."""


def names(spark, env):
    return sorted(t.name for t in spark.catalog.listTables(env.namespace))


def test_readers_never_miss_the_name(spark, env):
    name = env.table("polled")
    tables.overwrite_table(spark.range(0, 10), name)
    stop, seen, failures = threading.Event(), set(), []

    def poll():
        while not stop.is_set():
            try:
                seen.add(tuple(sorted(r.id for r in spark.table(name).collect())))
            except Exception as e:  # noqa: BLE001
                failures.append(e)

    reader = threading.Thread(target=poll)
    reader.start()
    for k in range(1, 51):
        assert tables.overwrite_table(spark.range(k * 10, k * 10 + 10), name) == 10
    stop.set()
    reader.join()
    assert not failures
    assert len(seen) > 2 and all(ids == tuple(range(ids[0], ids[0] + 10)) and ids[0] % 10 == 0 for ids in seen)


def test_versions_kept_and_removed(spark, env):
    name = env.table("kept")
    for k in range(4):
        tables.overwrite_table(spark.range(k + 1), name, keep_versions=2, keep_seconds=0)
    root = versions.versions_root(spark, name)
    left = sorted(p for p, _ in versions.Folders(spark).children(root))
    assert len(left) == 2 and versions.Folders(spark).same(left[-1], versions.location(spark, name))
    assert spark.table(name).count() == 4 and versions.table_facts(spark, name) == {"rows": 4}
    tables.overwrite_table(spark.range(9), name)  # younger than an hour: all stay
    tables.overwrite_table(spark.range(9), name)
    assert len(versions.Folders(spark).children(root)) == 4
    assert versions.remove_old(spark, name, keep_versions=0, keep_seconds=0) and spark.table(name).count() == 9
    assert spark.read.parquet(versions.location(spark, name)).count() == 9
    tables.drop_table(spark, name)
    assert names(spark, env) == [] and versions.Folders(spark).children(root) == []
    assert versions.table_facts(spark, name) is None


def test_placeholder_becomes_versioned(spark, env):
    tables.create_tables(spark, env)
    name = env.table(config.SILVER)
    first = versions.location(spark, name)
    rows = silver.typed(synthetic_orders(spark, 5))
    assert tables.overwrite_table(rows, name) == 5 and spark.table(name).count() == 5
    assert not versions.Folders(spark).same(first, versions.location(spark, name))
    tables.overwrite_table(rows, name, keep_versions=0, keep_seconds=0)
    assert not versions.Folders(spark).exists(first)
    tables.drop_table(spark, name)
    tables.create_tables(spark, env)
    assert spark.table(name).count() == 0


@pytest.mark.parametrize("change", ["rows", "schema", "new"])
def test_killed_anywhere_then_rerun(spark, env, monkeypatch, change):
    """Killed before each statement and file operation in turn; the rerun leaves its rows and nothing else."""
    old, new = spark.range(3), spark.range(5).selectExpr("id", "'x' AS tag") if change == "schema" else spark.range(5)
    session, folders = type(spark), versions.Folders
    real = {(session, "sql"): session.sql, (DataFrameWriter, "save"): DataFrameWriter.save,
            (folders, "write"): folders.write, (folders, "delete"): folders.delete}
    step, reached, done = 1, True, set()
    while reached:
        name = env.table(f"{change}_{step}")
        if change != "new":
            tables.overwrite_table(old, name)
        calls = []

        def watched(f):
            def call(self, *a, **k):
                text = str(a[0]) if a else ""
                if not re.match("DESCRIBE|SHOW", text):
                    calls.append(f"{f.__name__} {text}")
                    if len(calls) == step:
                        raise Killed
                return f(self, *a, **k)
            return call

        for (owner, method), f in real.items():
            monkeypatch.setattr(owner, method, watched(f))
        try:
            tables.overwrite_table(new, name)
            reached = False
        except Killed:
            pass
        monkeypatch.undo()
        if reached and spark.catalog.tableExists(name):
            n = spark.table(name).count()
            assert n in (3, 5), calls
        if reached:
            done.add(calls[-1].split(" ")[0])
            assert tables.overwrite_table(new, name) == 5
        assert [tuple(r) for r in spark.table(name).orderBy("id").collect()] == [tuple(r) for r in new.collect()]
        assert [t for t in names(spark, env) if t.startswith(f"{change}_{step}")] == [f"{change}_{step}"], calls
        marked = [versions.Folders(spark).exists(f"{p}/{versions.MARKER}")
                  for p, _ in versions.Folders(spark).children(versions.versions_root(spark, name))]
        assert all(marked), calls
        assert versions.table_facts(spark, name) == {"rows": 5}
        step += 1
    assert done >= {"save", "write", "sql"} and step > {"rows": 4, "schema": 7, "new": 4}[change]


def test_recover_says_what_it_did(spark, env):
    name = env.table("r")
    assert tables.recover_table(spark, name) is None
    tables.overwrite_table(spark.range(3), name)
    assert tables.recover_table(spark, name) is None
    tables._rename(spark, name, name + tables.PREVIOUS)
    assert tables.recover_table(spark, name) == "rolled back" and spark.table(name).count() == 3
    tables._create_on(spark, name + tables.STAGING, spark.table(name).schema, "parquet", versions.new_version(spark, name))
    assert tables.recover_table(spark, name) == "rolled back" and names(spark, env) == ["r"]


# ---- sizes --------------------------------------------------------------------------------------

def partition_counts(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {int(n) for n in re.findall(r"(?:hash|range)partitioning\([^\n]*, (\d+)\)", plan)}


def test_group_estimate(spark):
    rows = spark.range(20_000).selectExpr("concat('k', id % 500) AS k", "id % 7 AS j", "if(id % 3 = 0, NULL, 'abcd') AS s")
    e = estimate(rows, ("k", "j", "s"), 2)
    assert e.rows == 20_000 and abs(e.groups - 7000) < 900
    assert 5 * 16 + 3 + 3.9 < e.row_bytes < 5 * 16 + 4 + 4.1
    assert estimate(rows.where("false"), ("k",), 2).partitions() == 1
    assert GroupEstimate(10 ** 9, 1000, 100.0, 8).partitions() == 1                # few groups: partial sums only
    assert GroupEstimate(10 ** 9, 10 ** 9, 100.0, 8).partitions() == 373           # a group a row: the rows
    assert GroupEstimate(10 ** 12, 10 ** 8, 100.0, 10 ** 5).partitions() > 10 ** 5


def test_gold_steps_size_their_own_shuffles(spark, env):
    pipeline.bootstrap(spark, env, landing_rows=synthetic_orders(spark, 2000, seed=1))
    pipeline.run_bronze(spark, env)
    pipeline.run_silver(spark, env)
    before = dict(spark.conf.getAll)
    sales = pipeline.gold_sales_frame(spark, env, target_bytes=2000)
    products = pipeline.gold_products_frame(spark, env, target_bytes=100)
    done = spark.table(env.table(config.SILVER)).where("status = 'completed'")
    want = estimate(done, ("region", "year_month", "customer_id"), 5).partitions(2000)
    assert partition_counts(sales) == {want} and want > 8
    assert len(partition_counts(products)) == 1 and partition_counts(products) != {want}
    # side by side, each keeps its count through its adaptive run
    ran = {}

    def write(k, df):
        df.collect()
        ran[k] = partition_counts(df)

    both = [threading.Thread(target=write, args=x) for x in (("s", sales), ("p", products))]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert ran == {"s": {want}, "p": partition_counts(products)}
    assert dict(spark.conf.getAll) == before
    # and the rows are those of the unsized plan
    pipeline.run_gold_sales(spark, env)
    assert {tuple(r) for r in spark.table(env.table(config.GOLD_SALES)).select("region", "year_month", "order_count").collect()} == \
        {tuple(r) for r in sales.select("region", "year_month", "order_count").collect()}


def test_step_session_keeps_settings_and_raises_only(spark):
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    own = step_session(spark, 4000)
    assert own.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "true"
    assert own.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "4000"
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
    assert step_session(spark, 1).conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
    spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")


def test_caller_sees_what_a_step_published(spark, env):
    pipeline.bootstrap(spark, env, landing_rows=synthetic_orders(spark, 100, seed=1))
    assert spark.table(env.table(config.GOLD_SALES)).count() == 0  # the session now remembers the empty version
    report = pipeline.run(spark, env)
    for t, n in report.rows.items():
        assert spark.table(env.table(t)).count() == n
    assert versions.table_facts(spark, env.table(config.SILVER)) == {"rows": 100} | report.silver_metrics


@pytest.mark.parametrize("nulls", [0, 1, 40])
def test_null_keys_stay_out_of_the_shuffle(spark, env, nulls):
    rows = synthetic_orders(spark, 60, seed=2)
    bronze = rows.unionByName(rows.limit(nulls).withColumn("order_id", F.lit(None).cast("string"))) \
        .unionByName(rows.limit(7)).select(*LANDING_COLUMNS)
    reports, out = [], []
    for skip in (True, False):
        df, counters = silver.silver_observed(bronze, skip_null_keys=skip)
        out.append(sorted(map(tuple, df.collect()), key=repr))
        reports.append(counters.report())
    assert reports[0] == reports[1] and out[0] == out[1]
    assert reports[0]["duplicates"] == 7 + max(0, nulls - 1)


def test_counts_survive_a_restart_after_silver(spark, env, monkeypatch):
    pipeline.bootstrap(spark, env, landing_rows=synthetic_orders(spark, 200, seed=3))
    with monkeypatch.context() as m:
        m.setattr(pipeline, "run_gold_sales", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(BaseException):
            pipeline.run(spark, env, parallel_gold=False)
    stored = versions.table_facts(spark, env.table(config.SILVER))
    report = pipeline.resume(spark, env)
    assert report.rows[config.SILVER] == 200 and {"rows": 200} | report.silver_metrics == stored
    assert report.rows[config.BRONZE] == 200 and report.rows[config.GOLD_SALES] > 0
