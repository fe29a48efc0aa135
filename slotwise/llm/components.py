"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import discard, written


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minimum(both).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minimum(down)
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """u, v for every node u that is not the smallest of its component, v: that smallest.

    ``links`` has longs u and v. Minima are pre-aggregated per task and the
    joins are plain shuffle joins of written tables, so a node with very many
    links is split like any skewed key. Every round is a written table.
    """
    clean = lambda e: e.where("u <> v").distinct()
    edges = written(clean(links.select("u", "v")), "edges")
    mark = None
    while True:
        for star in (_large_star, _small_star):
            former, edges = edges, written(clean(star(edges)), "edges")
            discard(former)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            return edges
        mark = now
