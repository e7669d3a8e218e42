"""Silver layer: type and enrich the bronze rows, deduplicate, apply the quality rules.

Order matters and is kept: dedup runs on the *typed* rows *before* the quality
filter, so a bad duplicate can displace a good one; the survivor is made
deterministic by ordering the other columns.  ``order_id IS NOT NULL`` is still
pushed below the dedup shuffle by Catalyst (it only removes the NULL-key group),
the other rules correctly stay above it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.functions import casts
from tiers.functions.predicates import passes, quality_rules
from tiers.operators.dedup import dedup, drop_duplicates
from tiers.operators.metrics import Counter, count_rows

KEY = "order_id"
# Survivor order for duplicate order ids (typed values, ascending, NULLs first).
DEDUP_ORDER = ("customer_id", "product", "category", "quantity", "unit_price", "order_date",
               "region", "status")


def typed(bronze: DataFrame, mode: str = "lenient") -> DataFrame:
    """Casts (quantity INT, unit_price DOUBLE, order_date DATE) then derived
    total_amount and year_month; other columns pass through unchanged."""
    cast_cols = bronze.withColumns({
        "quantity": casts.to_int("quantity", mode),
        "unit_price": casts.to_double("unit_price", mode),
        "order_date": casts.to_date_ymd("order_date", mode),
    })
    return derived(cast_cols)


def derived(typed_df: DataFrame) -> DataFrame:
    return typed_df.withColumns({
        "total_amount": casts.total_amount("quantity", "unit_price"),
        "year_month": casts.year_month("order_date"),
    })


def dedup_orders(typed_df: DataFrame, deterministic: bool = True) -> DataFrame:
    """One row per order id.  The derived columns follow from the others: they are left out of the dedup's shuffle and
    computed again for the survivors."""
    if deterministic:
        kept = dedup(typed_df.select(KEY, *DEDUP_ORDER), [KEY], DEDUP_ORDER)
        return derived(kept).select(*typed_df.columns)
    return drop_duplicates(typed_df, [KEY])


def quality_filter(df: DataFrame) -> DataFrame:
    return df.filter(quality_rules())


def clean(typed_df: DataFrame, deterministic: bool = True) -> DataFrame:
    """Dedup, then the quality filter: the rows of ``silver_orders``."""
    return quality_filter(dedup_orders(typed_df, deterministic))


def silver(bronze: DataFrame, mode: str = "lenient") -> DataFrame:
    return clean(typed(bronze, mode))


@dataclass
class SilverCounters:
    bronze_rows: int
    deduped: Counter
    silver: Counter

    null_keys: int = 0      # rows without a key that were left out before the dedup

    def report(self) -> dict[str, int]:
        b, d, s = self.bronze_rows, self.deduped.value, self.silver.value
        d += 1 if self.null_keys else 0     # dedup would have kept one of them, and the rules dropped it
        return {"bronze_rows": b, "duplicates": b - d, "quality_drops": d - s, "silver_rows": s}


def silver_observed(bronze: DataFrame, mode: str = "lenient",
                    bronze_rows: int | None = None, skip_null_keys: bool = True) -> tuple[DataFrame, SilverCounters]:
    """Silver rows with counters after dedup and after the filter, plus the input count.

    Rows without a key all form one group, of which the dedup keeps one row and the rules then none.  With
    ``skip_null_keys`` they are filtered out in the scan and never reach the shuffle; they are counted by themselves (a
    one-column scan, which skips the row groups without NULLs), and the report is the same.

    Both counters sit after the dedup shuffle, i.e. in the result stage of the
    job that writes silver: they count each written partition once even when
    tasks are retried or a lost map output forces a stage re-run (a counter
    *before* the shuffle could count a re-run map stage twice).  The input count
    is taken from the stored bronze table (``bronze_rows``; else a ``count()``,
    which reads no column of a Parquet table).  Duplicates and quality drops are
    exact for the rows actually written, with one evaluation of the dedup.
    """
    if bronze_rows is None:
        bronze_rows = bronze.count()
    null_keys = 0
    if skip_null_keys and mode == "lenient":  # strict casts look at every row
        null_keys = bronze.where(F.col(KEY).isNull()).count()
        bronze = bronze.where(F.col(KEY).isNotNull())
    d, c_dedup = count_rows(dedup_orders(typed(bronze, mode)), "deduped")
    s, c_out = count_rows(quality_filter(d), "silver")
    return s, SilverCounters(int(bronze_rows), c_dedup, c_out, null_keys)


def metrics(bronze: DataFrame, mode: str = "lenient") -> DataFrame:
    """One-row frame: bronze rows, duplicates removed, quality drops, silver rows.

    One job: the bronze row count (a scan that reads no column) unioned with one
    aggregate over the deduplicated rows (survivor count and how many pass the
    rules), then summed.  The dedup is the same ``WindowGroupLimit`` plan as
    silver's, so a hot key is cut down before the shuffle.
    """
    zero = F.lit(0).cast("bigint")
    source = bronze.agg(F.count(F.lit(1)).alias("bronze_rows"), zero.alias("deduped_rows"),
                        zero.alias("silver_rows"))
    survivors = dedup_orders(typed(bronze, mode)).agg(
        zero.alias("bronze_rows"), F.count(F.lit(1)).alias("deduped_rows"),
        F.sum(passes(quality_rules()).cast("bigint")).alias("silver_rows"))
    totals = source.unionByName(survivors).agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("bronze_rows", "deduped_rows", "silver_rows")])
    return totals.select(
        "bronze_rows",
        (F.col("bronze_rows") - F.col("deduped_rows")).alias("duplicates"),
        (F.col("deduped_rows") - F.col("silver_rows")).alias("quality_drops"),
        "silver_rows",
    )
