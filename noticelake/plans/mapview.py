"""Map and calendar views."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticelake.functions.arrays import tag_class, tag_mentions
from noticelake.operators.paging import top_k_per
from noticelake.operators.predicates import in_box
from noticelake.presets import br_notices as br


def visible(df: DataFrame, box: tuple[float, float, float, float] | None, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows inside (south, west, north, east); without a box all rows."""
    return df if box is None else df.where(in_box(F.col(lat), F.col(lon), *box))


def view(df: DataFrame, lat: str = "latitude", lon: str = "longitude", default=br.DEFAULT_VIEW) -> DataFrame:
    """One row: centre and zoom that show all points; a single point and no point have fixed views."""
    la, lo = F.col(lat).cast("double"), F.col(lon).cast("double")
    b = df.where(la.isNotNull() & lo.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.min(la).alias("s"), F.max(la).alias("t"), F.min(lo).alias("w"), F.max(lo).alias("e")
    )
    spread = F.greatest(F.col("t") - F.col("s"), F.col("e") - F.col("w"))
    zoom = F.greatest(F.lit(4.0), F.least(F.lit(12.0), F.lit(8.0) - F.log2(spread + F.lit(0.1))))
    none, one = F.col("n") == 0, F.col("n") == 1
    return b.select(
        F.col("n").alias("points"),
        F.when(none, F.lit(default[0])).otherwise((F.col("s") + F.col("t")) / 2).alias("latitude"),
        F.when(none, F.lit(default[1])).otherwise((F.col("w") + F.col("e")) / 2).alias("longitude"),
        F.when(none, F.lit(default[2])).when(one, F.lit(10.0)).otherwise(zoom).alias("zoom"),
    )


def _cell(lat: Column, lon: Column, zoom: int, radius_px: int) -> tuple[Column, Column]:
    """Web-mercator grid cell of ``radius_px`` at a zoom level (256-pixel tiles)."""
    world = F.lit(256.0 * 2**zoom)
    x = (lon + 180.0) / 360.0 * world
    sin = F.sin(F.radians(lat))
    y = (F.lit(0.5) - F.log((F.lit(1.0) + sin) / (F.lit(1.0) - sin)) / F.lit(4.0 * math.pi)) * world
    return F.floor(x / radius_px).cast("bigint"), F.floor(y / radius_px).cast("bigint")


def clusters(df: DataFrame, zoom: int, radius_px: int = 60, lat: str = "latitude", lon: str = "longitude", tags: str = "tags") -> DataFrame:
    """Points merged by grid cell: count, mean position and colour class. Partial sums per task, so a hot cell is cheap."""
    la, lo = F.col(lat).cast("double"), F.col(lon).cast("double")
    cx, cy = _cell(la, lo, zoom, radius_px)
    scrap, documented = F.bool_or(tag_mentions(F.col(tags), "SUCATA")), F.bool_or(tag_mentions(F.col(tags), "DOCUMENTADO"))
    return (
        df.where(la.isNotNull() & lo.isNotNull())
        .groupBy(cx.alias("cell_x"), cy.alias("cell_y"))
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.avg(la).alias("latitude"),
            F.avg(lo).alias("longitude"),
            F.when(scrap, F.lit("sucata")).when(documented, F.lit("documentado")).otherwise(F.lit("outro")).alias("colour_class"),
        )
    )


def calendar(df: DataFrame, event: str = "event_at", tags: str = "tags") -> DataFrame:
    """Rows and flags per day. The rows of a day are read with ``calendar_day``, not gathered into one value."""
    return (
        df.where(F.col(event).isNotNull())
        .groupBy(F.to_date(event).alias("day"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.bool_or(tag_mentions(F.col(tags), "SUCATA")).alias("has_scrap"),
            F.bool_or(tag_mentions(F.col(tags), "DOCUMENTADO")).alias("has_documented"),
        )
    )


def calendar_items(df: DataFrame, per_day: int | None = None, event: str = "event_at", tie: str = "id") -> DataFrame:
    """The rows of every day as a list: their place within the day, by time and ``tie``. A day's list stays rows, so a day of any size is no single value."""
    rows = df.where(F.col(event).isNotNull()).withColumn("day", F.to_date(event))
    order = [F.col(event).asc(), F.col(tie).asc()]
    if per_day is not None:
        return top_k_per(rows, ["day"], order, per_day, rank="place")
    return rows.withColumn("place", F.row_number().over(W.partitionBy("day").orderBy(*order)))


def calendar_day(df: DataFrame, day: str, event: str = "event_at") -> DataFrame:
    start = F.lit(day).cast("timestamp")
    return df.where((F.col(event) >= start) & (F.col(event) < start + F.expr("INTERVAL 1 DAY")))


def default_day(calendar_rows: DataFrame, as_of) -> DataFrame:
    """First day from ``as_of`` on, else the last day."""
    d = F.col("day")
    return calendar_rows.agg(F.coalesce(F.min(F.when(d >= F.lit(as_of).cast("date"), d)), F.max(d)).alias("day"))


def with_tag_class(df: DataFrame, tags: str = "tags") -> DataFrame:
    return df.withColumn("tag_class", tag_class(F.col(tags)))
