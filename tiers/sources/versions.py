"""Versioned table folders: a full refresh is published by one catalog change.

Each refresh of a table writes its rows to a folder of its own, ``<table>__versions/<version>`` under the
schema's location, and then points the table there with ``ALTER TABLE ... SET LOCATION``.  The table's name
exists all the time; a reader sees the former version or the new one, whole.  A version that readers may still
be scanning stays: the newest ``keep_versions``, and every one younger than ``keep_seconds``.

A marker file inside a folder says that it has been the table's location.  A run killed before the catalog
change leaves a folder without a marker that the table does not point to; the next refresh of that table
removes it.  The counts of the step that wrote a version lie beside its rows before it is published, so whatever
is readable has its counts (``table_facts``), also after a restart.  One writer at a time per table.

The folders are reached through Spark's own Hadoop file systems, so any shared store works.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

MARKER, FACTS = "_published", "_facts.json"      # names with an underscore are not data to Spark's readers
SUFFIX = "__versions"
KEEP_VERSIONS = 2
KEEP_SECONDS = 3600


class Folders:
    """The few file operations of a shared store."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        p, fs = self._path(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        p, fs = self._path(path)
        fs.delete(p, True)

    def children(self, path: str) -> list[tuple[str, int]]:
        """``(path, modification time in ms)`` of the folders in ``path``; none if it does not exist."""
        p, fs = self._path(path)
        if not fs.exists(p):
            return []
        return [(s.getPath().toString(), s.getModificationTime()) for s in fs.listStatus(p) if s.isDirectory()]

    def same(self, a: str, b: str) -> bool:
        return self._path(a)[0].toUri().getPath().rstrip("/") == self._path(b)[0].toUri().getPath().rstrip("/")

    def write(self, path: str, text: str) -> None:
        p, fs = self._path(path)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str | None:
        p, fs = self._path(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _parts(name: str) -> tuple[str, str]:
    """The namespace and the table of a dotted name."""
    namespace, _, table = name.rpartition(".")
    return namespace, table


def versions_root(spark: SparkSession, name: str) -> str:
    namespace, table = _parts(name)
    base = spark.catalog.getDatabase(namespace or spark.catalog.currentDatabase()).locationUri
    return f"{base.rstrip('/')}/{table}{SUFFIX}"


def new_version(spark: SparkSession, name: str) -> str:
    """The path of a version to be written; later ones sort behind earlier ones."""
    return f"{versions_root(spark, name)}/{time.time_ns():020d}-{uuid.uuid4().hex[:6]}"


def location(spark: SparkSession, name: str) -> str | None:
    """Where the table's files are now, by the catalog; None where there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").take(1)
    return rows[0]["data_type"] if rows else None


def publish(spark: SparkSession, name: str, path: str) -> None:
    """Point the table at ``path``: one catalog change."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def mark(spark: SparkSession, path: str) -> None:
    """Say that the folder has been the table's location."""
    Folders(spark).write(f"{path}/{MARKER}", "")


def store_facts(spark: SparkSession, path: str, facts: dict) -> None:
    Folders(spark).write(f"{path}/{FACTS}", json.dumps(facts, sort_keys=True))


def table_facts(spark: SparkSession, name: str) -> dict | None:
    """The counts stored with the table's present version; None if it has none."""
    here = location(spark, name)
    text = here and Folders(spark).read(f"{here}/{FACTS}")
    return json.loads(text) if text else None


def remove_strays(spark: SparkSession, name: str) -> list[str]:
    """Delete the versions that a killed run wrote and never published; returns their paths.

    The present location is marked if its own run was killed before it could."""
    folders, here = Folders(spark), location(spark, name)
    gone = []
    for path, _ in folders.children(versions_root(spark, name)):
        if folders.exists(f"{path}/{MARKER}"):
            continue
        if here and folders.same(path, here):
            mark(spark, path)
        else:
            folders.delete(path)
            gone.append(path)
    return gone


def remove_old(spark: SparkSession, name: str, keep_versions: int = KEEP_VERSIONS,
               keep_seconds: float = KEEP_SECONDS) -> list[str]:
    """Delete published versions that are neither the present one, nor among the newest ``keep_versions``,
    nor younger than ``keep_seconds``; returns their paths."""
    folders, here = Folders(spark), location(spark, name)
    root = versions_root(spark, name)
    versions = sorted(folders.children(root))
    limit = (time.time() - keep_seconds) * 1000
    old = [p for p, changed in versions[:max(0, len(versions) - keep_versions)] if changed < limit]
    schema, _, folder = root.rpartition("/")
    table = folder.removesuffix(SUFFIX)  # where a managed table lay before its first refresh
    old += [p for p, changed in folders.children(schema) if changed < limit and p.rpartition("/")[2] == table]
    gone = [p for p in old if not (here and folders.same(p, here))]
    for p in gone:
        folders.delete(p)
    return gone
