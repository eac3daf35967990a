"""Lot pages and listing cards read out of HTML, and listings made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import extract as X
from noticelake.functions import urls as U
from noticelake.functions.arrays import tags_by_words
from noticelake.functions.classify import first_class
from noticelake.functions.ids import listing_id
from noticelake.functions.money import positive_or_null
from noticelake.functions.scores import page_confidence, parse_confidence
from noticelake.functions.text import blank_to_null, contains_any, title_case
from noticelake.presets import br_notices as br

def parse_pages(pages: DataFrame, max_images: int | None = None) -> DataFrame:
    """(url, html) to title with source and quality, place, amounts, images, og and JSON-LD fields."""
    html, url = F.col("html"), F.col("url")
    auction = F.nullif(F.regexp_extract(url, r"/lote/(\d+)/(\d+)", 1), F.lit(""))
    lot = F.nullif(F.regexp_extract(url, r"/lote/(\d+)/(\d+)", 2), F.lit(""))
    h2 = F.lower(F.trim(F.regexp_extract(html, X.H2_TITLE, 1)))
    tag = F.lower(F.trim(F.regexp_extract(html, X.TITLE_TAG, 1)))
    blank_page = html.isNull() | (F.length(html) == 0) | (h2.isin("", "undefined") & tag.isin("undefined", "null"))
    meta = F.nullif(F.trim(F.regexp_extract(html, X.META_DESCRIPTION, 1)), F.lit(""))
    t = X.html_title(html, F.concat(F.lit("Lote "), F.coalesce(lot, F.lit(""))))
    p = pages.select(
        "*", auction.alias("auction_id"), lot.alias("lot_id"), (~F.coalesce(blank_page, F.lit(True))).alias("is_valid_page"),
        t["title"].alias("title"), t["source"].alias("title_source"), t["quality"].alias("title_quality"),
        meta.alias("description"), X.og(html, "title").alias("og_title"), X.og(html, "description").alias("og_description"),
        X.og(html, "image").alias("og_image"), X.json_ld(html, "name").alias("ld_name"), X.json_ld(html, "description").alias("ld_description"),
        X.html_images(html, br.IMAGE_SKIP_WORDS, max_images).alias("images"),
        *[X.html_amount(html, pattern).alias(n) for n, pattern in X.HTML_VALUES.items()],
        X.first_amount(html).alias("first_amount"), X.max_page(html).alias("max_page"),
    )
    place = F.coalesce("title", "description")
    return p.withColumn("city", title_case(F.nullif(F.trim(F.regexp_extract(place, X.PLACE_IN_TITLE, 1)), F.lit("")))).withColumn(
        "region", F.upper(F.nullif(F.regexp_extract(place, X.PLACE_IN_TITLE, 2), F.lit("")))
    ).withColumn(
        "confidence",
        parse_confidence(
            F.col("title_quality") == "real", F.col("city").isNotNull() & F.col("region").isNotNull(),
            F.coalesce("ld_name", "og_title").isNotNull(), F.coalesce("valor_avaliacao", "first_amount").isNotNull(), F.size("images") > 0,
        ),
    )


def page_statistics(parsed: DataFrame) -> DataFrame:
    """One row of title-source, place and validity counts."""
    src = F.col("title_source")
    return parsed.agg(
        F.count(F.lit(1)).alias("pages"),
        *[F.count_if(src == s).alias(f"title_from_{s}") for s in ("h2", "title", "meta", "generated")],
        F.count_if(F.col("city").isNotNull()).alias("location_found"),
        F.count_if(F.col("city").isNull()).alias("location_missing"),
        F.count_if(~F.col("is_valid_page")).alias("invalid_pages"),
    )


def listings_from_pages(parsed: DataFrame, source: str, as_of) -> DataFrame:
    """Listing rows from parsed pages: blocking errors, warnings, category, tags, publication status."""
    title = F.coalesce(blank_to_null(F.col("title")), F.concat(F.lit("Lote "), F.coalesce("lot_id", F.lit(""))))
    description = F.coalesce("description", "og_description", "ld_description", F.concat(F.lit("Lote de leilão judicial. URL: "), F.col("url")))
    text = F.lower(F.concat_ws(" ", title, description))
    category = first_class(text, br.PAGE_CATEGORY_WORDS, "unknown")
    region = F.when(F.col("region").isin(*br.REGIONS), F.col("region")).otherwise(F.lit("XX"))
    city = F.coalesce(blank_to_null(F.col("city")), F.lit("Não informado"))
    tags = tags_by_words(text, br.PAGE_TAG_WORDS)
    fallback = F.when(contains_any(text, br.PAGE_VEHICLE_HINTS), F.array(F.lit("VEICULO"))).otherwise(F.array(F.lit("OUTROS")))
    link = U.base_url(F.col("url"))

    def note(cond: Column, message: str) -> Column:
        return F.when(F.coalesce(cond, F.lit(False)), F.lit(message))

    has_place = F.col("city").isNotNull() & F.col("region").isNotNull()
    key = listing_id(source, F.col("auction_id"), F.col("lot_id"))
    errors = F.array_compact(
        F.array(
            note(key.isNull(), "id_interno ausente"),
            note(F.lower(title) == "undefined", "titulo ausente ou undefined"),
            note(link.isNull(), "link_leiloeiro ausente"),
            note(~F.col("is_valid_page"), "página não renderizou corretamente"),
        )
    )
    warnings = F.array_compact(
        F.array(
            note(F.col("title_quality") == "generated", "titulo gerado automaticamente"),
            note(city == "Não informado", "municipio não identificado"),
            note(region == "XX", "uf não identificada"),
        )
    )
    rows = parsed.select(
        key.alias("listing_id"),
        title.alias("title"), description.alias("description"), F.substring(title, 1, 200).alias("summary"),
        city.alias("city"), region.alias("region"), positive_or_null(F.coalesce("valor_avaliacao", "first_amount")).alias("value"),
        F.when(F.size(tags) > 0, tags).otherwise(fallback).alias("tags"), category.alias("category"),
        category.isin("veiculo", "sucata").alias("is_vehicle_or_scrap"), link.alias("auctioneer_link"), "images",
        F.lit(as_of).cast("date").alias("published_on"),
        page_confidence(F.col("title_quality"), has_place, city == "Não informado", region == "XX").alias("confidence"),
        errors.alias("errors"), warnings.alias("warnings"),
    )
    return rows.withColumn("is_valid", F.size("errors") == 0).withColumn(
        "publication_status", F.when(F.col("is_valid") & F.col("is_vehicle_or_scrap"), F.lit("published")).otherwise(F.lit("draft"))
    )
