"""Missing notice columns filled from document text and descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import extract as X
from noticelake.functions.classify import modality, reconcile_modality
from noticelake.functions.dates import parse_any_timestamp
from noticelake.functions.text import sentinel_to_null
from noticelake.presets import br_notices as br

LABELS = (br.MODALITY_BOTH, br.MODALITY_ONLINE, br.MODALITY_ONSITE)


def extracted(document: Column, description: Column) -> dict[str, Column]:
    text = F.concat_ws(" ", document, description)
    return {
        "notice_no": X.notice_number(document),
        "event_date": X.auction_date(document, description),
        "value": X.estimated_value(document),
        "items": X.item_count(document),
        "auctioneer": X.auctioneer_name(document),
        "modality": modality(text, br.ONLINE_WORDS, br.ONSITE_WORDS, LABELS),
        "summary": X.object_summary(F.coalesce(description, document)),
        "description": X.long_description(document),
    }


def fill_if_missing(old: Column, found: Column) -> Column:
    """The stored value unless it is NULL, blank or a placeholder."""
    return F.coalesce(sentinel_to_null(old.cast("string")), found.cast("string"))


def extract_fields(df: DataFrame, document: str = "document_text", description: str = "description_text") -> DataFrame:
    """Fills columns that exist and are empty, adds those that do not exist."""
    found = extracted(F.col(document), F.col(description))
    new = {n: fill_if_missing(F.col(n), c) if n in df.columns else c.cast("string") for n, c in found.items()}
    return df.withColumns(new)


def repair_modality(df: DataFrame, column: str, title: str, description: str) -> DataFrame:
    return df.withColumn(column, reconcile_modality(F.col(column), F.concat_ws(" ", title, description), LABELS))


def mark_expired(df: DataFrame, as_of, date: str, status: str = "status") -> DataFrame:
    d = parse_any_timestamp(F.col(date)) if dict(df.dtypes)[date] == "string" else F.col(date)
    return df.withColumn(status, F.when(d < F.date_trunc("day", F.lit(as_of).cast("timestamp")), F.lit("EXPIRADO")).otherwise(F.col(status)))


def fill_dates(df: DataFrame, lookup: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with NULL dates filled from the lookup, one row of filled / still missing counts)."""
    own = F.col(column)
    j = df.join(lookup.select(key, F.col(column).alias("_found")), key, "left")
    counts = j.agg(
        F.count_if(own.isNull() & F.col("_found").isNotNull()).alias("filled"), F.count_if(own.isNull() & F.col("_found").isNull()).alias("missing")
    )
    return j.withColumn(column, F.coalesce(own, F.col("_found"))).drop("_found"), counts
