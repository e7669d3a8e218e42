"""Landing directory: CSV scan (bronze input) and file inventory (preflight input)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.schemas import BRONZE_SCHEMA

CSV_GLOB = "*.csv"


def read_landing(spark: SparkSession, path: str, strict_header: bool = False,
                 path_glob: str | None = None) -> DataFrame:
    """All files of a landing directory as one all-STRING DataFrame.

    Default (faithful): names come from the header row and no types are inferred.
    With several files Spark takes the names from one file and matches the others
    by position, so a file whose header is reordered is read mis-assigned.
    ``strict_header=True`` fixes the 9 landing columns and makes Spark verify each
    file's header against them (``enforceSchema=false``): a reordered or missing
    column fails the read (``FAILED_READ_FILE``) on the first scan that reads a column.

    Every file in the folder is read (hidden ``_``/``.`` files excepted), whatever its
    suffix; ``path_glob`` (e.g. ``"*.csv"``) narrows that.  Uncompressed CSV splits
    by ``spark.sql.files.maxPartitionBytes``, so one large file still spreads over
    many tasks.
    """
    reader = (spark.read.format("csv")
              .option("header", "true")
              .option("inferSchema", "false"))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if strict_header:
        reader = reader.schema(BRONZE_SCHEMA).option("enforceSchema", "false")
    return reader.load(path)


def landing_inventory(spark: SparkSession, path: str, glob: str = CSV_GLOB) -> DataFrame:
    """One row per landing file matching ``glob``: ``(path, file_name, length, modified)``.

    A ``binaryFile`` scan with only metadata columns selected: Spark prunes
    ``content`` (``ReadSchema: struct<path,length,modificationTime>``), so no file
    body is read, and the listing runs on any Hadoop filesystem.
    """
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", glob)
             .load(path))
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified"),
    )
