"""Command line for job tasks: ``spark-submit --py-files tiers.zip tiers_job.py <step> --schema ...``.

Each step is one task of the daily refresh and reads the previous layer's table,
so an orchestrator can run, retry and fan out steps independently
(preflight → bronze → silver → gold-sales ∥ gold-products → dashboard).
Parameters are the job parameters of the refresh: catalog, schema, run date,
landing location, table format.  The session comes from the platform
(``getOrCreate``); nothing here overrides its settings.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from tiers.config import DEFAULT_RUN_DATE, Env
from tiers.plans import dashboard, pipeline
from tiers.sources.synthetic import synthetic_orders
from tiers.sources.tables import create_schema

log = logging.getLogger("tiers")

STEPS = ("bootstrap", "preflight", "bronze", "silver", "gold-sales", "gold-products", "refresh", "dashboard")


def parse(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="tiers", description=__doc__.splitlines()[0])
    ap.add_argument("step", choices=STEPS)
    ap.add_argument("--catalog", default="spark_catalog")
    ap.add_argument("--schema", default="sales_lab")
    ap.add_argument("--run-date", default=DEFAULT_RUN_DATE)
    ap.add_argument("--landing-root", default=None, help="shared root of the landing folders")
    ap.add_argument("--landing-path", default=None, help="explicit landing folder (overrides the root)")
    ap.add_argument("--path-glob", default=None, help="only ingest files matching this glob, e.g. *.csv")
    ap.add_argument("--format", default="parquet", dest="fmt")
    ap.add_argument("--mode", default="lenient", choices=("lenient", "strict"))
    ap.add_argument("--strict-header", action="store_true")
    ap.add_argument("--exact-money", action="store_true")
    ap.add_argument("--synthetic-rows", type=int, default=0,
                    help="bootstrap: also write this many synthetic orders as the landing CSV")
    ap.add_argument("--seed", type=int, default=42)
    return ap.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    spark = spark or SparkSession.builder.appName(f"tiers-{args.step}").getOrCreate()
    env = Env(schema=args.schema, catalog=args.catalog, landing_root=args.landing_root,
              landing_path=args.landing_path, fmt=args.fmt, run_date=args.run_date, path_glob=args.path_glob)
    step = args.step
    if step in ("bronze", "silver", "gold-sales", "gold-products", "refresh"):
        create_schema(spark, env)  # idempotent; a step may run first in a fresh session
    if step == "bootstrap":
        rows = synthetic_orders(spark, args.synthetic_rows, args.seed) if args.synthetic_rows else None
        for t in pipeline.bootstrap(spark, env, landing_rows=rows):
            log.info("table ready: %s", t)
        if rows is not None:
            log.info("landing written: %s (%s synthetic orders)", env.landing, args.synthetic_rows)
    elif step == "preflight":
        r = pipeline.run_preflight(spark, env, args.strict_header, count="exact")
        log.info("preflight passed: %s CSV file(s), %s rows, %s columns in %s (run date %s)",
                 r["csv_files"], r["rows"], r["cols"], r["source"], r["run_date"])
    elif step == "bronze":
        log.info("written: %s (%s rows)", env.table("bronze_orders"), pipeline.run_bronze(spark, env, args.strict_header))
    elif step == "silver":
        m = pipeline.run_silver(spark, env, args.mode)
        log.info("written: %s (%s rows); duplicates removed %s; quality drops %s",
                 env.table("silver_orders"), m["silver_rows"], m["duplicates"], m["quality_drops"])
    elif step == "gold-sales":
        log.info("written: %s (%s rows)", env.table("gold_sales_by_region"),
                 pipeline.run_gold_sales(spark, env, args.exact_money))
    elif step == "gold-products":
        log.info("written: %s (%s rows)", env.table("gold_top_products"),
                 pipeline.run_gold_products(spark, env, args.exact_money))
    elif step == "refresh":
        report = pipeline.run(spark, env, args.mode, args.strict_header, args.exact_money)
        for line in report.lines(env):
            log.info(line)
    elif step == "dashboard":
        for name, df in dashboard.datasets_from_tables(spark, env).items():
            log.info("dataset %s", name)
            print(",".join(df.columns))
            for row in df.toLocalIterator():  # every row, one partition at a time
                print(",".join("" if v is None else str(v) for v in row))
    return 0
