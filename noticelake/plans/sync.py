"""New notice rows out of a storage listing, the portal's details and saved metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.ids import notice_id
from noticelake.functions.money import parse_br_money
from noticelake.functions.regions import repair_region
from noticelake.functions.text import blank_to_null, repair_mojibake
from noticelake.functions.urls import notice_link
from noticelake.operators.keyed import new_rows
from noticelake.presets import br_notices as br
from noticelake.sources.sinks import truncated


def _first(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def assemble(storage: DataFrame, portal: DataFrame, saved: DataFrame) -> DataFrame:
    """Storage rows (tax_id, year, seq, storage_path) with portal details before saved metadata.

    Both lookups are keyed by (tax_id, year, seq); the storage listing decides which notices exist.
    """
    keys = ["tax_id", "year", "seq"]
    p = portal.select(*keys, *[F.col(c).alias(f"p_{c}") for c in portal.columns if c not in keys])
    s = saved.select(*keys, *[F.col(c).alias(f"s_{c}") for c in saved.columns if c not in keys])
    j = storage.join(p, keys, "left").join(s, keys, "left")
    built = F.concat_ws("-", "tax_id", F.lit("1"), "seq", "year")
    portal_id = _first(F.translate("p_portal_id", "/", "-"), F.translate("s_portal_id", "/", "-"), built)
    title = repair_mojibake(_first(F.col("p_title"), F.col("s_title")))
    region = _first(F.col("p_region"), F.col("s_region"))
    number = _first(F.col("p_notice_no"), F.concat_ws("/", "seq", "year"))
    return j.select(
        portal_id.alias("portal_id"),
        notice_id(F.col("tax_id"), F.col("seq"), F.col("year")).alias("notice_id"),
        number.alias("notice_no"),
        F.coalesce(title, F.concat(F.lit("Leilão "), portal_id)).alias("title"),
        repair_mojibake(_first(F.col("p_agency"), F.col("s_agency"))).alias("agency"),
        F.when(F.length(region) == 2, F.upper(region)).otherwise(F.lit("XX")).alias("region"),
        repair_mojibake(_first(F.col("p_city"), F.col("s_city"))).alias("city"),
        F.substring("p_published", 1, 10).alias("published"),
        F.col("p_event").alias("event"),
        F.col("p_value").alias("value"),
        notice_link(F.col("tax_id"), F.col("year"), F.col("seq"), br.NOTICE_LINK_BASE).alias("portal_link"),
        F.coalesce("s_score", F.lit(br.RELEVANCE_BASE)).alias("score"),
        "storage_path",
    )


def new_notices(storage: DataFrame, portal: DataFrame, saved: DataFrame, stored: DataFrame) -> DataFrame:
    """Assembled rows whose portal id is not stored yet."""
    return new_rows(assemble(storage, portal, saved), stored, ["portal_id"])


#: Widths of the serving table's text columns, for a store that has them.
SERVING_WIDTHS = {"title": 500, "description": 2000, "agency": 200, "city": 100}


def to_serving(collected: DataFrame, as_of, widths: Mapping[str, int] | None = None) -> DataFrame:
    """Collector rows to serving rows: repaired region, derived numbers, default publication date.

    Texts stay whole; ``widths`` (``SERVING_WIDTHS``) cuts them to what the columns of a store hold.
    """
    region = repair_region(F.col("region"), F.col("city"), F.col("agency"), br.REGIONS, br.REGION_NAMES, br.FEDERAL_WORDS, br.FEDERAL_REGION)
    value = F.col("value") if dict(collected.dtypes)["value"] != "string" else parse_br_money(F.col("value"))
    rows = collected.select(
        "portal_id",
        "title",
        "description",
        "agency",
        region.alias("region"),
        "city",
        F.coalesce(blank_to_null(F.col("notice_no")), F.concat_ws("/", "seq", "year")).alias("notice_no"),
        F.concat_ws("/", "tax_id", "year", "seq").alias("portal_number"),
        F.coalesce("published_at", F.lit(as_of).cast("timestamp")).alias("published_at"),
        "event_at",
        value.cast("decimal(15,2)").alias("value"),
    )
    return truncated(rows, widths) if widths else rows
