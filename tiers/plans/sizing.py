"""How many shuffle partitions an aggregation needs, from the groups it will have.

The input's bytes say little about an aggregation's shuffle: partial aggregation sends at most one row per
group from each map task.  ``estimate`` therefore measures, in one pass over the key columns alone (with the
step's own pushed filter), the rows, the distinct keys (HyperLogLog) and the keys' mean width, and bounds the
rows of the shuffle by min(rows, groups x map tasks).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.session import plan_bytes

TARGET_SHUFFLE_BYTES = 256 * 1024 * 1024
SLOT_BYTES = 16       # a fixed-width field of a row with its share of the row's header
SCAN_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class GroupEstimate:
    """What an aggregation on some keys will shuffle."""

    rows: int
    groups: int
    row_bytes: float
    map_tasks: int

    @property
    def shuffled_bytes(self) -> int:
        return int(min(self.rows, self.groups * self.map_tasks) * self.row_bytes)

    def partitions(self, target_bytes: int = TARGET_SHUFFLE_BYTES) -> int:
        return max(1, -(-self.shuffled_bytes // max(1, target_bytes)))


def estimate(rows: DataFrame, keys: Sequence[str], states: int, rsd: float = 0.05) -> GroupEstimate:
    """Of grouping ``rows`` by ``keys`` with ``states`` fixed-width aggregation buffers per group.

    NULL keys count as a value.  An empty input gives one partition."""
    wide = [F.avg(F.octet_length(k)).alias(k) for k in keys
            if isinstance(rows.schema[k].dataType, (T.StringType, T.BinaryType))]
    got = rows.agg(F.count(F.lit(1)).alias("rows_"), F.approx_count_distinct(F.xxhash64(*keys), rsd).alias("groups_"),
                   *wide).first().asDict()
    n, groups = got.pop("rows_"), got.pop("groups_")
    width = SLOT_BYTES * (len(keys) + states) + sum(x or 0 for x in got.values())
    return GroupEstimate(n, groups, width, max(1, -(-plan_bytes(rows) // SCAN_BYTES)))
