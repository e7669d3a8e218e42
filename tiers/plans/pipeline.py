"""Environment bootstrap and the full refresh: preflight → bronze → silver → golds.

Each layer is written to its own table and the next layer reads that table, not
the previous layer's lineage: a failed or lost task only recomputes its own layer,
and each write is one Spark job (silver takes its quality counts by ``observe``
in that job).  The two gold tables only read silver and are written concurrently
from two driver threads (independent jobs share the cluster).  An exception in
any step stops the steps after it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tiers import config
from tiers.config import Env
from tiers.functions.predicates import is_completed
from tiers.plans import gold, silver
from tiers.plans.bronze import bronze
from tiers.plans.preflight import preflight_report, require
from tiers.plans.sizing import TARGET_SHUFFLE_BYTES, estimate
from tiers.session import TARGET_PARTITION_BYTES, partitions_for, plan_bytes, step_session
from tiers.sources.tables import create_schema, create_tables, overwrite_table, write_csv
from tiers.sources.versions import table_facts


def bootstrap(spark: SparkSession, env: Env, landing_rows: DataFrame | None = None,
              num_files: int | None = None) -> list[str]:
    """Create the schema and the empty typed layer tables if absent (existing tables
    keep their rows), and, if given, write ``landing_rows`` as the landing CSV folder."""
    create_schema(spark, env)
    created = create_tables(spark, env)
    if landing_rows is not None:
        write_csv(landing_rows, env.landing, num_files=num_files)
    return created


@dataclass
class RunReport:
    preflight: dict
    rows: dict[str, int] = field(default_factory=dict)
    silver_metrics: dict[str, int] = field(default_factory=dict)

    def lines(self, env: Env) -> list[str]:
        """The human-readable run summary: preflight, then one line per written table."""
        p = self.preflight
        out = [] if not p else [f"preflight passed: {p['csv_files']} CSV file(s), {p['csv_bytes']:,} bytes, "
               f"{p['cols']} columns in {p['source']} (run date {p['run_date']})"]
        for table, n in self.rows.items():
            out.append(f"written: {env.table(table)} ({n:,} rows)")
            if table == config.SILVER and self.silver_metrics:
                out.append(f"  duplicates removed : {self.silver_metrics['duplicates']:,}")
                out.append(f"  quality drops      : {self.silver_metrics['quality_drops']:,}")
        return out


# ---- steps: each is one job that reads the previous layer's table -------------------------

def run_preflight(spark: SparkSession, env: Env, strict_header: bool = False, count: str = "exists") -> dict:
    """Gate on the landing folder (raises ``PreflightError``).  ``count="exists"`` only proves a
    row exists (see preflight)."""
    return require(preflight_report(spark, env, strict_header=strict_header, count=count)).asDict()


def run_bronze(spark: SparkSession, env: Env, strict_header: bool = False) -> int:
    return overwrite_table(bronze(spark, env, strict_header), env.table(config.BRONZE), env.fmt,
                           swap=env.swap_overwrite)


# Each step from silver on runs in a sibling session of its own, with the partition count that its own shuffles
# need: steps that run side by side do not see each other's, nor does the caller (``session.step_session``).

def _publish(spark: SparkSession, env: Env, table: str, frame: DataFrame, facts=None) -> int:
    rows = overwrite_table(frame, env.table(table), env.fmt, swap=env.swap_overwrite, facts=facts)
    if frame.sparkSession is not spark:
        spark.catalog.refreshTable(env.table(table))  # the caller may have looked at the former version
    return rows


def silver_write_frame(spark: SparkSession, env: Env, mode: str = "lenient", bronze_rows: int | None = None,
                       target_bytes: int = TARGET_PARTITION_BYTES) -> tuple[DataFrame, silver.SilverCounters]:
    """What the silver step writes: silver rows from the bronze table with their counters,
    each file clustered by ``env.silver_cluster_by``; the dedup shuffle sized to the bronze table's bytes."""
    size = plan_bytes(spark.table(env.table(config.BRONZE)))
    own = step_session(spark, partitions_for(size, target_bytes))
    rows, counters = silver.silver_observed(own.table(env.table(config.BRONZE)), mode, bronze_rows=bronze_rows,
                                            skip_null_keys=env.skip_null_keys)
    if env.silver_cluster_by:
        rows = rows.sortWithinPartitions(*env.silver_cluster_by)
    return rows, counters


def run_silver(spark: SparkSession, env: Env, mode: str = "lenient", bronze_rows: int | None = None) -> dict:
    """Write silver from the bronze table; returns bronze/silver rows, duplicates, quality drops.

    The counts are stored with the written version (``sources.versions.table_facts``)."""
    rows, counters = silver_write_frame(spark, env, mode, bronze_rows)
    _publish(spark, env, config.SILVER, rows, facts=counters.report)
    return counters.report()


def gold_sales_frame(spark: SparkSession, env: Env, exact_money: bool = False,
                     target_bytes: int = TARGET_SHUFFLE_BYTES) -> DataFrame:
    """Gold sales from the silver table, its shuffles sized to the distinct (region, month, customer) of the
    completed orders: the wider of its two groupings, which counts customers."""
    done = spark.table(env.table(config.SILVER)).filter(is_completed())
    own = step_session(spark, estimate(done, ("region", "year_month", "customer_id"), 5).partitions(target_bytes))
    return gold.sales_by_region(own.table(env.table(config.SILVER)), exact_money)


def gold_products_frame(spark: SparkSession, env: Env, exact_money: bool = False,
                        target_bytes: int = TARGET_SHUFFLE_BYTES) -> DataFrame:
    """Gold products from the silver table, its shuffles (the grouping's and the sort's) sized to the distinct
    (product, category) of the completed orders."""
    done = spark.table(env.table(config.SILVER)).filter(is_completed())
    own = step_session(spark, estimate(done, ("product", "category"), 6).partitions(target_bytes))
    return gold.top_products(own.table(env.table(config.SILVER)), exact_money)


def run_gold_sales(spark: SparkSession, env: Env, exact_money: bool = False) -> int:
    return _publish(spark, env, config.GOLD_SALES, gold_sales_frame(spark, env, exact_money))


def run_gold_products(spark: SparkSession, env: Env, exact_money: bool = False) -> int:
    return _publish(spark, env, config.GOLD_PRODUCTS, gold_products_frame(spark, env, exact_money))


def run(spark: SparkSession, env: Env, mode: str = "lenient", strict_header: bool = False,
        exact_money: bool = False, parallel_gold: bool = True) -> RunReport:
    """Full refresh of all four layer tables of ``env``; returns counts per step.

    The preflight proves the landing folder has rows without counting them
    (``count="exists"``); the exact count is the bronze write's own.
    """
    report = RunReport(preflight=run_preflight(spark, env, strict_header, "exists"))
    report.rows[config.BRONZE] = run_bronze(spark, env, strict_header)
    report.preflight["rows"] = report.rows[config.BRONZE]

    report.silver_metrics = run_silver(spark, env, mode, bronze_rows=report.rows[config.BRONZE])
    report.rows[config.SILVER] = report.silver_metrics["silver_rows"]

    return _run_golds(spark, env, report, exact_money, parallel_gold)


def resume(spark: SparkSession, env: Env, exact_money: bool = False, parallel_gold: bool = True) -> RunReport:
    """The rest of a refresh that stopped after silver: the golds, from the stored silver table.

    Bronze's and silver's counts are those stored with the tables' present versions, so the report is the one
    that the whole run would have given.  Raises if silver has no stored counts."""
    bronze, done = (table_facts(spark, env.table(t)) for t in (config.BRONZE, config.SILVER))
    if not done or "silver_rows" not in done:
        raise RuntimeError(f"{env.table(config.SILVER)} was not written by a refresh: run the whole refresh")
    report = RunReport(preflight={})
    report.rows[config.BRONZE] = bronze["rows"] if bronze else done["bronze_rows"]
    report.silver_metrics = {k: v for k, v in done.items() if k != "rows"}
    report.rows[config.SILVER] = done["silver_rows"]
    return _run_golds(spark, env, report, exact_money, parallel_gold)


def _run_golds(spark: SparkSession, env: Env, report: RunReport, exact_money: bool, parallel_gold: bool) -> RunReport:
    golds = {config.GOLD_SALES: run_gold_sales, config.GOLD_PRODUCTS: run_gold_products}
    if parallel_gold:
        with ThreadPoolExecutor(max_workers=len(golds)) as pool:
            futures = {t: pool.submit(inheritable_thread_target(spark)(step), spark, env, exact_money)
                       for t, step in golds.items()}
            for t, fut in futures.items():
                report.rows[t] = fut.result()
    else:
        for t, step in golds.items():
            report.rows[t] = step(spark, env, exact_money)
    return report
