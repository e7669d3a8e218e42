"""tiers: a layered (bronze / silver / gold) sales-analytics pipeline on Spark DataFrames.

Landing CSVs → bronze (raw strings) → silver (typed, deduplicated, quality-filtered)
→ gold (revenue by region × month, by product × category) → dashboard datasets
and widgets.  Every step is a DataFrame function; only ``plans.pipeline`` writes.
"""

from tiers.config import Env

__all__ = ["Env"]
