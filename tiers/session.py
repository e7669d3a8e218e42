"""Session helpers: a tuned local session for tests/bench, and the shared scratch root.

On a cluster the session comes from the platform; nothing here overrides its
settings.  Writes that must survive executor loss (landing files, layer tables)
go under the folder the cluster names in ``spark.checkpoint.dir``.  Only a
local-mode session without that setting gets a private folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the pipeline relies on.  AQE coalesces the many small shuffle
# partitions of a small run and splits skewed ones of a large run; the ANSI
# flag is left at the session default (strict casts depend on it, see
# tiers.functions.casts).
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  driver_memory: str = "8g", app_name: str = "tiers") -> SparkSession:
    """Local session for tests and the benchmark (one JVM, ``cores`` task threads)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions",
                str(shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir).  Only a local-mode session without one gets a fresh private folder;
    a cluster session without it is a configuration error, because a
    machine-local folder is not visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = session_context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: configure a shared folder (HDFS/S3/ABFS) for this cluster")
    root = tempfile.mkdtemp(prefix="tiers-ckpt-")
    if sc is None:  # a remote (Connect) session to a local server: remember it in the session conf
        spark.conf.set("spark.checkpoint.dir", root)
        return root
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/") if sc.getCheckpointDir() else root


def session_context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


# Input bytes (compressed columns, several times that as rows) per initial shuffle partition when a step sizes its
# shuffles, and per scan task of a step: what a task sorts stays in its memory, nothing is spilled.
TARGET_PARTITION_BYTES = 16 * 1024 * 1024
MAX_PARTITIONS = 100_000
#: Of the stored feed: a scan task takes whole row groups, so these are no larger than its share.
PARQUET_OPTIONS = {"compression": "zstd", "parquet.block.size": str(TARGET_PARTITION_BYTES)}


def partitions_for(input_bytes: int, target_partition_bytes: int = TARGET_PARTITION_BYTES) -> int:
    return min(MAX_PARTITIONS, max(1, -(-int(input_bytes) // target_partition_bytes)))


def plan_bytes(df) -> int:
    """The optimizer's size of a frame's input in bytes (file sizes for a stored table)."""
    if not hasattr(df, "_jdf"):  # a Spark Connect frame has no local plan
        return 0
    # Py4J may hand a Scala BigInt over as an int already, which has no toString.
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int,
                   target_partition_bytes: int = TARGET_PARTITION_BYTES) -> Iterator[int]:
    """For one step, raise the initial shuffle partition count to ``input_bytes / target``.

    AQE coalesces the small shuffle partitions of a small run but never splits a big
    non-skewed one, so the starting count must follow the bytes the step reads (up to
    ``MAX_PARTITIONS``).  Only raises, and the former setting is back afterwards, also when the
    step fails.
    """
    wanted = partitions_for(input_bytes, target_partition_bytes)
    key = _partition_key(spark)
    before = spark.conf.get(key, None)
    current = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted <= current:
        yield current
        return
    spark.conf.set(key, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def step_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A sibling session for one step, whose shuffles start with at least ``partitions`` partitions and whose scan
    tasks read at most ``TARGET_PARTITION_BYTES``.

    It shares the application, the catalog and the caller's settings, but its own setting is seen by no other step:
    two steps that run side by side each keep their count, and the caller's session is left as it is.
    (A Spark Connect session is returned itself.)
    """
    if session_context(spark) is None:
        return spark
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    key = _partition_key(own)
    if partitions > int(own.conf.get(key, None) or own.conf.get("spark.sql.shuffle.partitions")):
        own.conf.set(key, str(partitions))
    if own._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > TARGET_PARTITION_BYTES:
        own.conf.set("spark.sql.files.maxPartitionBytes", str(TARGET_PARTITION_BYTES))
    return own


def _partition_key(spark: SparkSession) -> str:
    return ("spark.sql.adaptive.coalescePartitions.initialPartitionNum"
            if spark.conf.get("spark.sql.adaptive.enabled", "true") == "true" else "spark.sql.shuffle.partitions")


def session_key(spark: SparkSession) -> tuple[str, int]:
    """Identity of a live session for per-session caches: the application id (new for
    every SparkContext) and the session object (several sessions can share a context)."""
    sc = session_context(spark)
    if sc is not None:
        return sc.applicationId, id(spark)
    return getattr(spark, "session_id", "") or spark.conf.get("spark.app.id", ""), id(spark)


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tiers/{label}-{uuid.uuid4().hex[:12]}"
