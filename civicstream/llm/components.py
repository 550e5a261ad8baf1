"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstream.llm import common


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of the edges (a, b, longs)
    that is not itself the root. Every round links neighbours to the smallest of them; hot nodes
    are aggregated before they are joined. Rounds stop when nothing changes."""
    links = common.stored(_small_star(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                                      .where("u != v").distinct()), "links")
    state = _state(links)
    while state[0]:
        links = common.stored(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(links: DataFrame):
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("double"))
                           ).head())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` lead from larger to smaller nodes."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.where("u != v").union(least.select("u", F.col("m").alias("v"))).distinct()
