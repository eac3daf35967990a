"""Ranks and limits over all rows without a task that sees them all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticelake.sources.snapshots import staged

#: ``monotonically_increasing_id`` counts rows in the lower 33 bits and partitions above them.
ROW_BITS = 33


def with_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Adds the place of each row, from 1, in ``order``. The order has to be total for reruns to agree.

    Rows are dealt to ranges and sorted there; what a range adds to its own places is the number of rows in
    the ranges before it. That table has one row a partition and is the only thing that is windowed as a whole or broadcast.
    """
    at, part, size, before = (f"__{name}_{x}" for x in ("at", "range", "size", "before"))  # names that no caller has
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    placed = staged(ranged, "ranks").withColumn(part, F.shiftright(at, ROW_BITS))
    earlier = F.sum(size).over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1))
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias(size)).select(part, F.coalesce(earlier, F.lit(0)).alias(before))
    inside = F.col(at).bitwiseAND((1 << ROW_BITS) - 1)
    return placed.join(F.broadcast(sizes), part).select(*[F.col(f"`{c}`") for c in df.columns], (F.col(before) + inside + 1).alias(name))


@dataclass(frozen=True)
class Limited:
    """Rows inside and outside a limit, written down once, and how many there are of each."""

    accepted: DataFrame
    rejected: DataFrame
    n_accepted: int
    n_rejected: int


def first_rows(batch: DataFrame, limit: int, *order: Column) -> Limited:
    """The first ``limit`` rows in a total order, as a run that stops after so many, and the rest.

    The counts are observed while the rows are written; nothing is sorted in one task.
    """
    inside = F.col("_place") <= max(limit, 0)
    seen = Observation("limit")
    ranked = with_rank(batch, *order, name="_place").observe(seen, F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside"))
    ranked = staged(ranked, "limited")
    return Limited(ranked.where(inside).drop("_place"), ranked.where(~inside).drop("_place"), seen.get["inside"], seen.get["outside"])


def capacity_brake(batch: DataFrame, stored: int, maximum: int, *order: Column) -> Limited:
    """Rows that still fit under ``maximum`` stored rows, and those refused with their number."""
    return first_rows(batch, maximum - stored, *order)
