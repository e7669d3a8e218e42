"""Connected components of a link table, by alternating star contractions.

Every round replaces each node's neighbours by the smallest of them (large star, then small
star).  Minima come from partial aggregates and links meet them in plain equi-joins, so a
node with any number of links is split over tasks; nothing is gathered per node.  Each round's
links are written to the shared scratch folder, so a lost executor never costs a whole run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm.common import Scratch


def _summary(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())


def connected_components(spark: SparkSession, links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of ``links``; the component is its smallest node.

    Null ends, self-links and repeated links are ignored; an empty table gives no rows.
    """
    scratch = Scratch(spark, "components")
    edges = scratch.save(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).distinct())
    before = _summary(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        low = both.groupBy("node").agg(F.min("root").alias("low")).withColumn("low", F.least("low", "node"))
        large = (both.join(low, "node").where("root > node")
                 .select(F.col("root").alias("node"), F.col("low").alias("root")).distinct())
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(low, "node")
        stars = scratch.save(
            small.where("root <> low").select(F.col("root").alias("node"), F.col("low").alias("root"))
            .unionByName(low.select("node", F.col("low").alias("root"))).distinct())
        after = _summary(stars)
        scratch.drop(edges)
        edges = stars
        if after == before:
            break
        before = after
    roots = edges.select(F.col("root").alias("node"), F.col("root").alias("component")).distinct()
    return edges.select("node", F.col("root").alias("component")).unionByName(roots)
