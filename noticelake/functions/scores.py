"""Score columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.text import let


def weighted_terms(text: Column, weights: Mapping[str, int], base: int, low: int = 0, high: int = 100) -> Column:
    """``base`` plus the weight of every term found, clamped.

    The weights are one literal array, so generated code stays small whatever the list length.
    """
    rules = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(int(w)).alias("w")) for t, w in weights.items()])
    total = let(
        text, lambda x: F.aggregate(rules, F.lit(base), lambda acc, r: acc + F.when(F.contains(x, r["t"]), r["w"]).otherwise(F.lit(0)))
    )
    return F.greatest(F.least(total, F.lit(high)), F.lit(low))


def points(parts: list[tuple[str, int, Column]], cap: int = 100) -> tuple[Column, Column]:
    """(score, breakdown text) of named conditions."""
    total = F.lit(0)
    for _, p, cond in parts:
        total = total + F.when(cond, F.lit(p)).otherwise(F.lit(0))
    names = F.concat_ws("|", *[F.when(cond, F.lit(f"{n}:+{p}")) for n, p, cond in parts])
    return F.least(total, F.lit(cap)), names


def feed_confidence(date, place, value, tag, images, files, no_city, no_region, no_notice) -> Column:
    """40 base plus parts present, at most 100, less penalties, at least 0."""
    def pts(cond: Column, n: int) -> Column:
        return F.when(F.coalesce(cond, F.lit(False)), F.lit(n)).otherwise(F.lit(0))

    plus = F.lit(40) + pts(date, 20) + pts(place, 15) + pts(value, 10) + pts(tag, 5) + pts(images, 5) + pts(files, 5)
    minus = pts(no_city, 10) + pts(no_region, 5) + pts(no_notice, 5)
    return F.greatest(F.least(plus, F.lit(100)) - minus, F.lit(0))


def page_confidence(title_quality: Column, has_location: Column, no_city: Column, no_region: Column) -> Column:
    """50 base, +30 real or +10 generated title, +20 location, less penalties."""
    plus = F.lit(50) + F.when(title_quality == "real", F.lit(30)).when(title_quality == "generated", F.lit(10)).otherwise(F.lit(0))
    plus = plus + F.when(has_location, F.lit(20)).otherwise(F.lit(0))
    minus = F.when(title_quality == "generated", F.lit(10)).otherwise(F.lit(0))
    minus = minus + F.when(no_city, F.lit(20)).otherwise(F.lit(0)) + F.when(no_region, F.lit(10)).otherwise(F.lit(0))
    return F.greatest(F.least(plus, F.lit(100)) - minus, F.lit(0))


def parse_confidence(title: Column, location: Column, vehicle: Column, value: Column, images: Column) -> Column:
    """30 title, 30 location, 20 vehicle text, 10 value, 10 images."""
    total = F.lit(0)
    for cond, n in ((title, 30), (location, 30), (vehicle, 20), (value, 10), (images, 10)):
        total = total + F.when(F.coalesce(cond, F.lit(False)), F.lit(n)).otherwise(F.lit(0))
    return total
