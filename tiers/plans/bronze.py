"""Bronze layer: the landing files exactly as they arrive (all STRING, no filtering)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tiers.config import Env
from tiers.sources.landing import read_landing


def bronze(spark: SparkSession, env: Env, strict_header: bool = False) -> DataFrame:
    return read_landing(spark, env.landing, strict_header=strict_header, path_glob=env.path_glob)
