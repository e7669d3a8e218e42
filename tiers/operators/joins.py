"""Join helper: broadcast a dimension only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.session import plan_bytes

# A dimension of at most this many rows and input bytes is shipped to every task.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows and ``max_bytes`` of input, else ``df``.

    The bounds are checked, not assumed: bytes by the plan's statistics, then rows by
    ``take(max_rows + 1)`` of an empty projection, which runs one task first and further ones
    only while rows are missing.  Beyond them the join is left to Catalyst (sort-merge join with
    AQE skew splitting), so a dimension that grows with the data never lands whole in every
    executor's memory.
    """
    if plan_bytes(df) > max_bytes:
        return df
    rows = len(df.select(F.lit(1)).take(max_rows + 1))
    return F.broadcast(df) if rows <= max_rows else df
