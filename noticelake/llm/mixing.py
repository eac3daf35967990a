"""Mixing sources to target weights by pivotal dependent rounding.

Every document is owed a fractional number of copies, the same for all documents of a source. Its
whole part is taken at once. The fractions are rounded together: two documents with a fraction
exchange words (fraction times size) by one random draw that makes one of them whole and keeps both
the sum of words and each document's expected fraction. So the words taken stay at the target up
to the last open document of a source.

The work is a reduction tree. Documents of a source are dealt by the hash of their id to buckets of
about ``BUCKET`` documents, so a hot source is many tasks. A bucket leaves one open document at most;
``FAN`` buckets hand theirs to the next round, until one is left for each source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.store import Scratch
from noticelake.operators.ranks import with_rank

WORD = r"[^\x20\x09-\x0D]+"
BUCKET = 8192
FAN = 64
#: Equal rows that are dealt out together.
DEALT = 1 << 16


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float], limit: float) -> DataFrame:
    """Adds ``target`` to (source, source_size, n): weights repeat over sources by code point, null last.

    A source stops at ``limit`` times its size. Sources are ordered by the share at which they stop;
    a source is stopped if its share at that point, with all before it stopped, is above its limit.
    One row per source: this table is the number of sources long.
    """
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("_w", F.element_at(table, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("_cap", F.col("source_size") * F.lit(float(limit))).withColumn("_stop", F.col("_cap") / F.col("_w"))
    before = Window.orderBy("_stop", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total, weight = F.sum("source_size").over(everything), F.sum("_w").over(everything)
    share = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (weight - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    s = s.withColumn("_full", F.col("_stop") <= share)
    rest = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(everything)
    given = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0.0))
    s = s.withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(F.least("_cap", F.col("_w") * (total - given) / rest)))
    return s.select("source", "source_size", "n", "target")


def pivot(share: np.ndarray, size: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds fractions in (0, 1) pairwise; returns them and the index of the open one, -1 if none.

    The pair (a, b) moves words: either a gains what b loses or the other way round, each as far as
    one of them gets whole, with the chances that leave both expectations as they were.
    """
    out = share.copy()
    a = -1
    for b in range(len(out)):
        if not 1e-12 < out[b] < 1 - 1e-12:
            out[b] = round(out[b])
            continue
        if a < 0:
            a = b
            continue
        sa, sb, pa, pb = size[a], size[b], out[a], out[b]
        up, down = min((1 - pa) * sa, pb * sb), min(pa * sa, (1 - pb) * sb)
        move = up if draws[b] * (up + down) < down else -down
        pa, pb = pa + move / sa, pb - move / sb
        open_a, open_b = 1e-12 < pa < 1 - 1e-12, 1e-12 < pb < 1 - 1e-12
        out[a], out[b] = pa if open_a else round(pa), pb if open_b else round(pb)
        a = a if open_a else b if open_b else -1
    return out, a


def _round(seed: int, level: int, last: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["weight", "_h", "_id"], kind="stable").reset_index(drop=True)
        key = [seed, level, int(group["_bucket"].iat[0]), int(group["_source_hash"].iat[0]) & 0xFFFFFFFF]
        draws = np.random.Generator(np.random.PCG64(key)).random(len(group) + 1)
        share, left = pivot(group["share"].to_numpy(float), group["weight"].to_numpy(float), draws)
        if left >= 0 and last:
            share[left], left = float(draws[-1] < share[left]), -1
        group["share"] = share
        group["open"] = np.arange(len(group)) == left
        return group

    return run


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3),
    limit: float = 3.0,
    seed: int = 17,
) -> DataFrame:
    """Copies to take of each document so that sources come near their targets.

    Returns (id_col, source, size, source_size, target, copies, taken), one row for each input row.

    * Null text: size 0. Null source: a source of its own, ordered last. Null id: rounded like any other.
    * Documents of size 0 take no words and get ``copies`` by an own draw; a source of size 0 has target 0.
    * Repeated rows (equal id, source and size) are owed copies together: their whole copies are dealt one a row, and the fraction that is left goes
      into the rounding as one row. So they end within one row of what they are owed.
    * An empty table gives an empty result. Other columns are not read, so their names don't matter.
    * The draws depend on ``seed``, ids and sizes alone, not on partitions: reruns agree.
    """
    spark = docs.sparkSession
    tables = Scratch(spark, "mixing")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    rows = tables.save(rows.groupBy("_id", "source", "size").agg(F.count(F.lit(1)).alias("_rows")), "rows")
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_rows")).alias("source_size"), F.count(F.lit(1)).alias("n"))
    goals = targets(sizes, weights, limit)
    goals = tables.save(goals, "goals").withColumnRenamed("source", "_source")
    many = goals.agg(F.max("n")).first()[0] or 0

    due = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(limit)))).otherwise(0.0)
    rows = (
        rows.join(goals, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_due", due)
        .withColumn("whole", F.floor("_due").cast("long"))
        .withColumn("share", F.col("_due") - F.col("whole"))
        # Equal rows are owed their copies together: whole ones are dealt evenly, one row alone goes into the rounding.
        .withColumn("_owed", F.floor(F.col("share") * F.col("_rows")))
        .withColumn("share", F.col("share") * F.col("_rows") - F.col("_owed"))
        .withColumn("weight", F.col("size").cast("double"))
        .withColumn("_h", F.xxhash64(F.col("_id"), F.col("size"), F.lit(seed)))
        .withColumn("_source_hash", F.xxhash64("source"))
        .withColumn("_bucket", F.pmod(F.col("_h"), F.greatest(F.lit(1), F.ceil(F.col("n") / BUCKET))).cast("long"))
    )
    own_draw = F.pmod(F.col("_h"), F.lit(1 << 52)) / float(1 << 52)
    keep = ["_id", "source", "size", "_rows", "_owed", "source_size", "target", "whole", "share", "weight", "_h", "_source_hash", "_bucket"]
    empty = rows.where("size = 0").withColumn("share", F.when(own_draw < F.col("share"), 1.0).otherwise(0.0))
    empty = empty.select(*keep, F.lit(False).alias("open"))

    schema = empty.schema
    level, width, at = 0, max(1, math.ceil(many / BUCKET)), rows.where("size > 0").select(*keep, F.lit(False).alias("open"))
    done = [empty]
    while True:
        last = width <= 1
        at = tables.save(at.groupBy("_source_hash", "source", "_bucket").applyInPandas(_round(seed, level, last), schema), f"round{level}")
        done.append(at.where("not open"))
        if last:
            break
        at = at.where("open").withColumn("_bucket", F.floor(F.col("_bucket") / FAN))
        level, width = level + 1, math.ceil(width / FAN)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    # Of n equal rows the first ``_owed`` have one copy more than the others, the rounded row among them.
    more = (F.col("_owed") + F.round("share").cast("long")) > F.col("_nth")
    copies = (F.col("whole") + more.cast("long")).alias("copies")
    starts = out.withColumn("_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1, F.lit(DEALT).cast("long"))))
    # A row for each start, so that many equal rows are dealt out by many tasks.
    starts = starts.where("_start = 0").unionByName(starts.where("_start > 0").repartition("_start", "_h"))
    out = starts.withColumn("_nth", F.explode(F.sequence("_start", F.least(F.col("_start") + DEALT, F.col("_rows")) - 1)))
    return out.select(F.col("_id").alias(id_col), "source", "size", "source_size", "target", copies, (copies * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as its decision says, with the columns of ``docs``.

    Equal rows (id, source and size) are dealt their numbers of copies in the order of the hashes of whole rows; of rows of one
    hash it doesn't matter which has which. Most rows have no equal and take theirs from the join alone.
    """
    key = ["_id", "_source", "_size"]
    d = decided.select(F.col(id_col).alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies")
    d = d.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"), F.max("copies").alias("_most"), F.sum("copies").alias("_sum")).where("_sum > 0")
    rows = docs.select(
        F.struct("*").alias("_row"), F.col(id_col).alias("_my_id"), F.col(source_col).alias("_my_source"), n_words(F.col(text_col)).alias("_my_size")
    )
    met = rows.join(
        d, F.col("_my_id").eqNullSafe(F.col("_id")) & F.col("_my_source").eqNullSafe(F.col("_source")) & (F.col("_my_size") == F.col("_size"))
    )
    copies = F.col("_most").cast("int")
    even = (F.col("_sum") == F.col("_rows") * F.col("_most")) | (F.col("_rows") == 1)
    out = met.where(even).select("_row", copies.alias("_copies"))
    if not d.where(~even).isEmpty():
        # The others have _most copies or one less: as many rows as the sum says have all of them. Places within equal rows come from
        # ranks over all of these, so that a group of any size is many ranges; the draw only parts rows of one hash, which are alike.
        several = met.where(~even)
        order = [F.col(c).asc() for c in key] + [F.xxhash64("_row").asc(), F.rand(1).asc()]
        several = with_rank(several, *order, name="_rank")
        begin = several.groupBy(*key).agg(F.min("_rank").alias("_begin")).select(*[F.col(c).alias(f"{c}_k") for c in key], "_begin")
        same = F.col("_id").eqNullSafe(F.col("_id_k")) & F.col("_source").eqNullSafe(F.col("_source_k")) & (F.col("_size") == F.col("_size_k"))
        full = F.col("_sum") - F.col("_rows") * (F.col("_most") - 1) > F.col("_rank") - F.col("_begin")
        out = out.unionByName(several.join(begin, same).select("_row", F.when(full, copies).otherwise(copies - 1).alias("_copies")))
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).select("_row.*")
