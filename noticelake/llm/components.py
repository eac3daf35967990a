"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.llm.store import Scratch


def _least(pairs: DataFrame) -> DataFrame:
    """Adds to (u, v) the least of u and all its v. A hot u is pre-aggregated, and the join can be split."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return pairs.join(least, F.col("u") == F.col("_u")).drop("_u")


def _step(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u > v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = _least(large)
    out = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of the nodes in ``links`` (a, b); the component is its smallest node.

    Every step is written to the shared folder. Steps end when a step changes nothing.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = scratch.save(edges, f"{name}-0")
    state, i = None, 0
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or state == tuple(now):
            break
        state, i = tuple(now), i + 1
        edges = scratch.save(_step(edges), f"{name}-{i}")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
