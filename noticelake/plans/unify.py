"""Serving table: two sources under one schema, joined to the location dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.dates import temporal_status
from noticelake.functions.text import blank_to_null
from noticelake.operators.joins import join_place
from noticelake.operators.predicates import publishable_any_source

SERVING_TYPES = {
    "id": "bigint", "notice_id": "string", "portal_id": "string", "agency": "string", "region": "string",
    "city": "string", "notice_no": "string", "published_at": "timestamp", "event_at": "timestamp", "title": "string",
    "description": "string", "summary": "string", "tags": "array<string>", "notice_link": "string",
    "auctioneer_link": "string", "modality": "string", "value": "decimal(15,2)", "items": "bigint",
    "auctioneer": "string", "storage_path": "string", "score": "int", "created_at": "timestamp",
    "source_type": "string", "source_name": "string", "metadata": "string",
}
SERVING_COLUMNS = tuple(SERVING_TYPES)
GEO_COLUMNS = ("place_code", "latitude", "longitude", "place_name")


def stored_or_portal_link(storage_path: Column, portal_link: Column) -> Column:
    return F.when(F.length(storage_path) > 0, storage_path).otherwise(portal_link)


def three_way_link(storage_url: Column, direct: Column, built: Column) -> Column:
    return F.coalesce(blank_to_null(storage_url), blank_to_null(direct), blank_to_null(built))


def align(df: DataFrame, types=SERVING_TYPES) -> DataFrame:
    """Serving columns in order and type; absent ones as NULL, so both sources share one schema."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def notices_side(df: DataFrame, default_source: str = "portal", second_source: str = "auctioneer") -> DataFrame:
    df = df.withColumn("source_type", F.coalesce("source_type", F.lit(default_source)))
    live = df.where(
        publishable_any_source(
            F.col("publication_status"), F.col("event_at"), F.col("portal_link"), F.col("source_type"), F.col("auctioneer_link"), second_source
        )
    )
    return align(live.withColumn("notice_link", stored_or_portal_link(F.col("storage_path"), F.col("portal_link"))))


def lots_side(df: DataFrame) -> DataFrame:
    live = df.where((F.col("publication_status") == "published") & F.col("event_at").isNotNull())
    return align(live.withColumn("items", F.lit(1)))


def unify(notices: DataFrame, lots: DataFrame, places: DataFrame, as_of) -> DataFrame:
    """Union of both sides with place columns and ``temporal_status``.

    The dimension is joined once, after the union; filters and column pruning pass through to both scans.
    """
    both = notices_side(notices).unionByName(lots_side(lots))
    joined = join_place(both, places)
    return joined.select(*SERVING_COLUMNS, *GEO_COLUMNS, temporal_status(F.col("event_at"), as_of).alias("temporal_status"))


def totals(unified: DataFrame, first: str = "portal", second: str = "auctioneer") -> DataFrame:
    return unified.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("source_type") == first).alias("total_first"),
        F.count_if(F.col("source_type") == second).alias("total_second"),
        F.count_distinct("region").alias("regions"),
        F.count_distinct("city").alias("cities"),
        F.coalesce(F.sum("value"), F.lit(0)).alias("value_total"),
        F.count_if(F.col("temporal_status") == "future").alias("future_rows"),
        F.count_if(F.col("temporal_status") == "past").alias("past_rows"),
    )
