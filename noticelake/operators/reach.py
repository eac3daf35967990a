"""Bounded reachability over a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticelake.session import ensure_checkpoint_dir

#: Links to one page from which on the rows that meet there are dealt to several tasks.
HUB = 10_000


def bounded_reach(
    seeds: DataFrame, edges: DataFrame, max_depth: int, max_pages: int | None = None, same_host: bool = True, hub: int = HUB
) -> DataFrame:
    """Pages reached from every seed with their smallest depth.

    ``seeds`` (seed), ``edges`` (src, dst[, src_host, dst_host]). Each level is one join of the frontier with the
    links and one anti join with what was seen, written to the checkpoint folder so the lineage
    does not grow. ``max_pages`` is a crawl budget per seed: nearest levels first, then by URL.

    With a budget of k a seed never has more than k pages, so of the links of one page at most the first 2k by URL can matter: k of
    them may be seen already, and k more fill any room. Links are cut to that before they are walked, every level keeps
    what its seed has room for, and a seed without room leaves the walk. A page that many link to may be in many
    frontiers: its links stand there in several copies, and the seeds are dealt to them.
    """
    ensure_checkpoint_dir(seeds.sparkSession)
    links = edges.where(F.col("src_host") == F.col("dst_host")) if same_host else edges
    links = links.select("src", "dst").where(F.col("src") != F.col("dst")).distinct()
    into = links.groupBy("dst").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hub)
    copies = into.select(F.col("dst").alias("_page"), F.least(F.ceil(F.col("_n") / hub), F.lit(256)).cast("int").alias("_copies"))
    if max_pages is not None:
        by_url = W.partitionBy("src").orderBy("dst")
        links = links.withColumn("_rn", F.row_number().over(by_url)).where(F.col("_rn") <= 2 * max_pages).drop("_rn")
    links = links.join(copies, F.col("src") == F.col("_page"), "left").select("src", "dst", F.coalesce("_copies", F.lit(1)).alias("_copies"))
    links = links.join(copies.withColumnRenamed("_copies", "_to"), F.col("dst") == F.col("_page"), "left").select("src", "dst", "_copies", F.coalesce("_to", F.lit(1)).alias("_split"))
    links = links.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies").checkpoint()

    seen = seeds.select("seed", F.col("seed").alias("url")).distinct().withColumn("depth", F.lit(0)).checkpoint()
    frontier = seen.withColumn("_split", F.lit(1))
    # A seed is in its own frontier alone, so its page needs no split but has to find one copy: the first.
    for depth in range(1, max_depth + 1):
        at = frontier.select("seed", F.col("url").alias("_at"), F.pmod(F.xxhash64("seed"), F.col("_split")).cast("int").alias("_mine"))
        step = (
            at.join(links, (F.col("_at") == F.col("src")) & (F.col("_mine") == F.col("_copy")))
            .groupBy("seed", F.col("dst").alias("url"))
            .agg(F.max("_split").alias("_split"))
            .join(seen.select("seed", "url"), ["seed", "url"], "left_anti")
        )
        if max_pages is not None:
            used = seen.groupBy("seed").agg(F.count(F.lit(1)).alias("_used"))
            ranked = step.withColumn("_rn", F.row_number().over(W.partitionBy("seed").orderBy("url"))).where(F.col("_rn") <= max_pages)
            step = ranked.join(used, "seed").where(F.col("_rn") + F.col("_used") <= max_pages).drop("_rn", "_used")
        frontier = step.checkpoint()
        seen = seen.unionByName(frontier.select("seed", "url", F.lit(depth).alias("depth")))
        if max_pages is not None:
            open_seeds = seen.groupBy("seed").agg(F.count(F.lit(1)).alias("_used")).where(F.col("_used") < max_pages)
            frontier = frontier.join(open_seeds.select("seed"), "seed", "left_semi")
            if depth < max_depth and frontier.isEmpty():
                break
    return seen
