"""Landing folder scan, inventory and preflight gate (FIXTURES §4 landing cases)."""

import pytest
from pyspark.errors import PySparkException

from tiers.plans.bronze import bronze
from tiers.plans.preflight import (
    BAD_HEADER, MISSING, NO_CSV, NO_ROWS, PreflightError, preflight_report, require,
)
from tiers.sources.landing import landing_inventory, read_landing
from tests.conftest import write_text

HEADER = "order_id,customer_id,product,category,quantity,unit_price,order_date,region,status\n"
ROW = "ORD-1,CUST-1,p,c,2,3.50,2024-01-05,North,completed\n"


def test_missing_folder(spark, env):
    r = preflight_report(spark, env).first()
    assert (r["passed"], r["reason"]) == (False, MISSING)
    with pytest.raises(PreflightError):
        require(preflight_report(spark, env))


def test_no_csv(spark, env):
    write_text(f"{env.landing}/notes.txt", HEADER + ROW)
    r = preflight_report(spark, env).first()
    assert (r["passed"], r["reason"], r["csv_files"]) == (False, NO_CSV, 0)


def test_header_only(spark, env):
    write_text(f"{env.landing}/a.csv", HEADER)
    r = preflight_report(spark, env).first()
    assert (r["passed"], r["reason"], r["csv_files"], r["rows"]) == (False, NO_ROWS, 1, 0)


def test_passes_and_counts_every_file(spark, env):
    write_text(f"{env.landing}/a.csv", HEADER + ROW + ROW)
    write_text(f"{env.landing}/b.csv", HEADER + ROW)
    write_text(f"{env.landing}/c.txt", HEADER + ROW)      # not a CSV file, but its rows are read
    write_text(f"{env.landing}/_hidden.csv", HEADER + ROW)  # ignored by both
    r = require(preflight_report(spark, env))
    assert (r["csv_files"], r["rows"], r["cols"]) == (2, 4, 9)
    assert bronze(spark, env).count() == 4
    assert bronze(spark, env.with_(path_glob="*.csv")).count() == 3
    assert {x["file_name"] for x in landing_inventory(spark, env.landing).collect()} == {"a.csv", "b.csv"}


def test_all_strings_and_nulls(spark, env):
    write_text(f"{env.landing}/a.csv", HEADER + "ORD-1,,p,c,,3.50,2024-01-05,North\n")
    df = read_landing(spark, env.landing)
    assert all(t == "string" for _, t in df.dtypes)
    r = df.first()
    assert r["customer_id"] is None and r["quantity"] is None and r["status"] is None


def test_reordered_header(spark, env):
    write_text(f"{env.landing}/a.csv", HEADER + ROW)
    cols = HEADER.strip().split(",")
    swapped = [cols[1], cols[0]] + cols[2:]
    write_text(f"{env.landing}/b.csv", ",".join(swapped) + "\n" + "CUST-2,ORD-2,p,c,1,1.00,2024-01-05,North,completed\n")
    # default: values assigned by position
    ids = {r["order_id"] for r in read_landing(spark, env.landing).collect()}
    assert ids == {"ORD-1", "CUST-2"}
    # strict header mode: the read fails; a bare preflight still checks the header
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_landing(spark, env.landing, strict_header=True).collect()
    r = preflight_report(spark, env, strict_header=True).first()
    assert (r["passed"], r["reason"]) == (False, BAD_HEADER)


def test_missing_column_strict(spark, env):
    cols = HEADER.strip().split(",")
    write_text(f"{env.landing}/a.csv", ",".join(c for c in cols if c != "unit_price") + "\n"
               + "ORD-1,CUST-1,p,c,2,2024-01-05,North,completed\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_landing(spark, env.landing, strict_header=True).collect()
    # default mode: the header-derived frame lacks the column; silver fails at analysis
    from tiers.plans import silver
    with pytest.raises(PySparkException, match="unit_price"):
        silver.typed(read_landing(spark, env.landing))


def test_exists_mode_skips_the_count(spark, env):
    write_text(f"{env.landing}/a.csv", HEADER + ROW + ROW)
    r = preflight_report(spark, env, count="exists").first()
    assert (r["passed"], r["rows"], r["csv_files"]) == (True, None, 1)
    assert r["csv_bytes"] == len(HEADER + ROW + ROW)
    write_text(f"{env.landing}/a.csv", HEADER)
    assert preflight_report(spark, env, count="exists").first()["reason"] == NO_ROWS


def test_sized_shuffles_raise_for_one_step_only(spark):
    from tiers.session import TARGET_PARTITION_BYTES, sized_shuffles
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with sized_shuffles(spark, 1):
        assert spark.conf.get(key, None) == before
    with pytest.raises(ValueError), sized_shuffles(spark, 1000 * TARGET_PARTITION_BYTES) as n:
        assert n == 1000 and spark.conf.get(key) == "1000"
        raise ValueError
    assert spark.conf.get(key, None) == before
    with sized_shuffles(spark, 100 * 10 ** 12) as n:
        assert n <= 100_000


def test_exists_probe_runs_few_tasks(spark, env):
    for i in range(30):  # fewer than the number from which Spark lists folders by tasks
        write_text(f"{env.landing}/f{i:02d}.csv", HEADER + ROW)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    tracker, group = spark.sparkContext.statusTracker(), "exists-probe"
    spark.sparkContext.setJobGroup(group, group)
    try:
        from tiers.sources.landing import read_landing
        source = read_landing(spark, env.landing)
        assert source.rdd.getNumPartitions() >= 30
        assert source.take(1)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        tasks = sum(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds if tracker.getStageInfo(s))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tasks <= 8
