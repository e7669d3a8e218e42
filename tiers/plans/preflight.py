"""Preflight check of the landing folder: report and gate.

Two Spark scans: the file inventory (metadata only) and a row count (or a
row-exists probe) over the landing CSVs.  Both work on any Hadoop filesystem.
The report is one row; ``require`` raises with the reason so that nothing
downstream runs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tiers.config import Env
from tiers.schemas import PREFLIGHT_SCHEMA
from tiers.sources.landing import CSV_GLOB, landing_inventory, read_landing

# Failure reasons.
MISSING = "landing folder not found"
NO_CSV = "no CSV files in landing folder"
NO_ROWS = "landing folder has no rows"
BAD_HEADER = "a landing file header does not match the landing columns"


class PreflightError(RuntimeError):
    pass


def _error_class(e: Exception) -> str:
    getter = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    return (getter() if getter else None) or ""


def _report(spark: SparkSession, env: Env, csv_files: int, csv_bytes: int, rows: int | None,
            columns: list[str], reason: str | None) -> DataFrame:
    row = Row(run_date=env.run_date, source=env.landing, csv_files=csv_files, csv_bytes=csv_bytes,
              rows=rows, cols=len(columns), columns=", ".join(columns), passed=reason is None, reason=reason)
    return spark.createDataFrame([row], PREFLIGHT_SCHEMA)


COUNT_MODES = ("exact", "exists")


def preflight_report(spark: SparkSession, env: Env, strict_header: bool = False,
                     count: str = "exact") -> DataFrame:
    """``(run_date, source, csv_files, csv_bytes, rows, cols, columns, passed, reason)``.

    ``csv_files`` / ``csv_bytes`` come from one aggregate over the ``*.csv``
    inventory.  ``rows`` counts rows of every file the bronze scan will read
    (all files, or ``env.path_glob``), so it agrees with what the pipeline does.

    ``count="exact"`` scans the landing data to count rows, as a standalone
    check must.  ``count="exists"`` only proves there is a row (``take(1)``: one split
    first, further ones only while none has a row) and leaves ``rows`` NULL: the refresh uses it
    and takes the exact count from the bronze write, so a 100 TB landing folder
    is not read twice.  With ``strict_header`` and an exact count, one column is
    read so that every file's header is checked; in ``exists`` mode the header
    check happens in the bronze write itself.
    """
    if count not in COUNT_MODES:
        raise ValueError(f"count must be one of {COUNT_MODES}")
    try:
        inv = landing_inventory(spark, env.landing, CSV_GLOB).agg(
            F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in _error_class(e) or "Path does not exist" in str(e):
            return _report(spark, env, 0, 0, 0, [], MISSING)
        raise
    csv_files, csv_bytes = int(inv["files"]), int(inv["bytes"])
    if csv_files == 0:
        return _report(spark, env, 0, 0, 0, [], NO_CSV)
    try:
        source = read_landing(spark, env.landing, strict_header=strict_header, path_glob=env.path_glob)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in _error_class(e):
            return _report(spark, env, csv_files, csv_bytes, 0, [], NO_ROWS)
        raise
    columns = source.columns
    if count == "exists":
        has_rows = bool(source.take(1))
        return _report(spark, env, csv_files, csv_bytes, None, columns, None if has_rows else NO_ROWS)
    if strict_header:
        try:
            rows = source.agg(F.count(F.lit(1)).alias("n"), F.count(columns[0]).alias("c")).first()["n"]
        except Exception as e:  # the header check fails inside the scan (FAILED_READ_FILE)
            if "FAILED_READ_FILE" in str(e) or "header" in str(e).lower():
                return _report(spark, env, csv_files, csv_bytes, 0, columns, BAD_HEADER)
            raise
    else:
        rows = source.count()
    return _report(spark, env, csv_files, csv_bytes, rows, columns, None if rows > 0 else NO_ROWS)


def require(report: DataFrame) -> Row:
    """Raise ``PreflightError`` unless the report passed; return the report row."""
    row = report.first()
    if not row["passed"]:
        raise PreflightError(f"preflight failed for {row['source']}: {row['reason']}")
    return row
