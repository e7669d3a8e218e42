"""Catalog tables: read, overwrite, DDL, CSV landing writer, preview."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.config import Env
from tiers.schemas import TABLE_SCHEMAS
from tiers.session import session_context
from tiers.sources import versions


def create_schema(spark: SparkSession, env: Env) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``; managed tables go under ``env.schema_location`` if set."""
    location = f" LOCATION '{env.schema_location}'" if env.schema_location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {env.namespace}{location}")


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_tables(spark: SparkSession, env: Env, schemas: dict[str, T.StructType] | None = None) -> list[str]:
    """Create the empty, typed layer tables that do not exist yet (existing ones are kept)."""
    created = []
    for table, schema in (schemas or TABLE_SCHEMAS).items():
        recover_table(spark, env.table(table))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {env.table(table)} ({ddl(schema)}) USING {env.fmt}")
        created.append(env.table(table))
    return created


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet", swap: bool | None = None,
                    facts=None, keep_versions: int = versions.KEEP_VERSIONS,
                    keep_seconds: float = versions.KEEP_SECONDS) -> int:
    """Full refresh of ``name`` with ``df``'s rows and schema; returns the rows written.

    The row count is taken by ``observe`` inside the write job itself, so the
    frame is evaluated once (no second count job, no re-scan of the result).

    Delta overwrites are atomic by themselves.  A plain Parquet ``saveAsTable``
    overwrite drops the old table first, so by default for other formats (``swap``) the rows go to a new
    version folder, and the table is pointed there by one catalog change after the write job has committed
    (``tiers.sources.versions``): the name is there all the time, readers see the former rows or the new ones,
    and a failed write leaves the former.  This also allows refreshing a table from a read of itself.

    A refresh that changes the schema cannot be one catalog change in Spark's session catalog.  It creates a staging
    table on the new folder and renames: former away, new one in, former dropped.  Only then may a reader
    miss the name for the moment between two renames.  The tables' names tell how far a run came
    (``recover_table``), so a run killed at any point is finished or rolled back by the next one.

    ``facts()``, if given, is called after the write and its dict stored with the version.
    """
    spark = df.sparkSession
    swap = (fmt != "delta") if swap is None else swap
    obs = Observation(f"rows_written_{uuid.uuid4().hex[:8]}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("overwrite")
    if fmt == "parquet":
        writer.option("compression", "zstd")  # row groups as the session has them
    if not swap:
        writer.option("overwriteSchema", "true").saveAsTable(name)
        return int(obs.get["rows"])
    recover_table(spark, name)
    if not _has_folders(spark):  # a Spark Connect session: a staged table and renames
        writer.saveAsTable(name + STAGING)
        _swap_in(spark, name)
        return int(obs.get["rows"])
    path = versions.new_version(spark, name)
    try:
        writer.save(path)
    except Exception:
        versions.Folders(spark).delete(path)
        raise
    rows = int(obs.get["rows"])
    versions.store_facts(spark, path, {"rows": rows} | (facts() if facts else {}))
    if not spark.catalog.tableExists(name):
        _create_on(spark, name, df.schema, fmt, path)
    elif _shape(spark.table(name).schema) == _shape(df.schema):
        versions.publish(spark, name, path)
    else:
        _create_on(spark, name + STAGING, df.schema, fmt, path)
        _swap_in(spark, name)
    versions.mark(spark, path)
    versions.remove_old(spark, name, keep_versions, keep_seconds)
    return rows


STAGING, PREVIOUS = "__staging", "__previous"


def _has_folders(spark: SparkSession) -> bool:
    """Whether the session reaches the store's folders (a Spark Connect session does not)."""
    return session_context(spark) is not None


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _create_on(spark: SparkSession, name: str, schema: T.StructType, fmt: str, path: str) -> None:
    spark.sql(f"CREATE TABLE {name} ({ddl(schema)}) USING {fmt} LOCATION '{path}'")


def _rename(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {'.'.join(to.split('.')[-2:])}")


def _swap_in(spark: SparkSession, name: str) -> None:
    """Put the staged table in the place of ``name``; the former is dropped only when the new one has the
    name.  A failing step renames the former table back."""
    there = spark.catalog.tableExists(name)
    if there:
        _rename(spark, name, name + PREVIOUS)
    try:
        _rename(spark, name + STAGING, name)
    except Exception:
        if there:
            _rename(spark, name + PREVIOUS, name)
        spark.sql(f"DROP TABLE IF EXISTS {name + STAGING}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name + PREVIOUS}")


def recover_table(spark: SparkSession, name: str) -> str | None:
    """Finish or roll back what a run killed in ``overwrite_table`` left; returns what was done, if anything.

    * The name is gone, the former and the staged table are there (killed between the renames): the staged rows
      are whole, so the swap is finished.  Without the staged table the former gets its name back.
    * The name and the former are there (killed before the last drop): the former is dropped.
    * The name and the staged table are there (killed before the first rename): the staged one is dropped.
    * Version folders that were never published are deleted.
    """
    there, staged, former = (spark.catalog.tableExists(n) for n in (name, name + STAGING, name + PREVIOUS))
    done = None
    if not there and former:
        _rename(spark, name + (STAGING if staged else PREVIOUS), name)
        done = "finished" if staged else "rolled back"
        staged, former = False, staged
    if former:
        spark.sql(f"DROP TABLE IF EXISTS {name + PREVIOUS}")
        done = done or "finished"
    if staged:
        spark.sql(f"DROP TABLE IF EXISTS {name + STAGING}")
        done = done or "rolled back"
    if _has_folders(spark) and versions.remove_strays(spark, name):
        done = done or "rolled back"
    return done


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table with all its versions, and what a killed run may have left of it."""
    for n in (name, name + STAGING, name + PREVIOUS):
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    if _has_folders(spark):
        versions.Folders(spark).delete(versions.versions_root(spark, name))


def write_csv(df: DataFrame, path: str, num_files: int | None = None) -> None:
    """Write a landing folder: CSV with a header, replacing what was there.

    One file per partition (a directory of parts, never ``coalesce(1)``);
    ``num_files`` repartitions round-robin first when a fixed file count is wanted.
    NULL is written as an empty field and read back as NULL.
    """
    if num_files:
        df = df.repartition(num_files)
    df.write.option("header", "true").mode("overwrite").csv(path)


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows; sorted by ``order_by`` (a top-k, so no global sort) for a stable preview."""
    if order_by:
        df = df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return df.limit(n)
