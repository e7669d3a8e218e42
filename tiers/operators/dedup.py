"""Deduplication on a key, with a reproducible survivor.

``dedup`` keeps, per key, the first row under a total order of the other
columns (ascending, NULLs first).  It is ``row_number() = 1`` over a window
partitioned by the key; Catalyst rewrites that into a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it, so every map
task forwards at most one row per key.  A key that holds a third of all rows
therefore costs one row per map task in the shuffle, not a third of the data
in one reducer.  All NULL keys form one group (as in ``dropDuplicates``).

``drop_duplicates`` is the plain ``dropDuplicates``: same row count, but the
surviving row is whichever arrives first, so it may change between runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "__dedup_rn"


def survivor_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None):
    cols = list(order_by) if order_by else [c for c in df.columns if c not in keys]
    return [F.col(c).asc_nulls_first() for c in cols]


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct ``keys``: the first under ``order_by`` (default: all other columns).

    The survivor is reproducible when ``order_by`` covers every non-key column (or
    the columns it leaves out are functions of those it covers, as in silver);
    rows tied on ``order_by`` but different elsewhere are a free choice.
    """
    w = Window.partitionBy(*keys).orderBy(*survivor_order(df, keys, order_by))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def drop_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropDuplicates(keys)``: an arbitrary survivor per key."""
    return df.dropDuplicates(list(keys))
