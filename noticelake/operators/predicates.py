"""Filters of the listing search. A parameter that is not given adds nothing to the plan."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.text import fold_accents


@dataclass(frozen=True)
class SearchParams:
    region: str | None = None
    city: str | None = None
    value_min: float | None = None
    value_max: float | None = None
    event_from: str | None = None
    event_to: str | None = None
    published_from: str | None = None
    published_to: str | None = None
    source: str | None = None
    tag: str | None = None
    text: str | None = None
    temporality: str = "future"  # future, past, all
    end_exclusive_time: bool = False
    order: str = "nearest"
    page: int = 1
    page_size: int = 20


def contains_ci(c: Column, part: str) -> Column:
    """Case-insensitive containment, both sides trimmed; wildcard characters are plain text."""
    return F.contains(F.upper(F.trim(c)), F.upper(F.trim(F.lit(part))))


def listing_filters(p: SearchParams) -> list[Column]:
    out: list[Column] = []
    if p.region is not None:
        out.append(F.col("region") == p.region)
    if p.city is not None:
        out.append(contains_ci(F.col("city"), p.city))
    if p.value_min is not None:
        out.append(F.col("value") >= F.lit(p.value_min))
    if p.value_max is not None:
        out.append(F.col("value") <= F.lit(p.value_max))
    if p.event_from is not None:
        out.append(F.col("event_at") >= F.lit(p.event_from).cast("timestamp"))
    if p.event_to is not None:
        end = F.lit(p.event_to).cast("timestamp")
        # Whole end day by default; the other mode stops at its midnight.
        out.append(F.col("event_at") <= end if p.end_exclusive_time else F.col("event_at") < end + F.expr("INTERVAL 1 DAY"))
    if p.published_from is not None:
        out.append(F.to_date("published_at") >= F.lit(p.published_from).cast("date"))
    if p.published_to is not None:
        out.append(F.to_date("published_at") <= F.lit(p.published_to).cast("date"))
    if p.source is not None:
        out.append(F.col("source_type") == p.source)
    if p.tag is not None:
        out.append(F.array_contains("tags", p.tag))
    if p.text is not None:
        needle = F.trim(fold_accents(F.lit(p.text)))
        fields = [fold_accents(F.col(c)) for c in ("title", "description", "agency", "city")]
        out.append(functools.reduce(operator.or_, [F.contains(f, needle) for f in fields]))
    if p.temporality != "all":
        out.append(F.col("temporal_status") == p.temporality)
    return out


def apply(df: DataFrame, filters: Iterable[Column]) -> DataFrame:
    for f in filters:
        df = df.where(f)
    return df


def publishable(status: Column, event_at: Column, link: Column) -> Column:
    return (status == "published") & event_at.isNotNull() & link.isNotNull()


def publishable_any_source(status: Column, event_at: Column, portal_link: Column, source: Column, own_link: Column, second: str) -> Column:
    return (status == "published") & event_at.isNotNull() & (portal_link.isNotNull() | ((source == second) & own_link.isNotNull()))


def keeps_category(tags: Column, tag: str, keep: Iterable[str]) -> Column:
    """False for rows that carry ``tag`` and none of ``keep``; NULL tags pass."""
    bad = F.array_contains(tags, tag) & ~F.arrays_overlap(tags, F.array(*[F.lit(k) for k in keep]))
    return ~F.coalesce(bad, F.lit(False))


def not_past(c: Column, as_of) -> Column:
    """Undated rows pass; dates before the day of ``as_of`` do not."""
    return c.isNull() | (c >= F.date_trunc("day", F.lit(as_of).cast("timestamp")))


def in_box(lat: Column, lon: Column, south: float, west: float, north: float, east: float) -> Column:
    return lat.between(south, north) & lon.between(west, east)


def recent(c: Column, as_of, days: int) -> Column:
    return c > F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")


def active(status: Column, collected_at: Column, statuses: Iterable[str], as_of, days: int = 7) -> Column:
    """Listing with a live status that was collected within the last days."""
    return status.isin(list(statuses)) & recent(collected_at, as_of, days)


def clamp_limit(limit: int | None, default: int = 50, maximum: int = 100) -> int:
    return min(limit if limit is not None else default, maximum)
