"""Paged listing search with facets and a consumption log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.functions.arrays import tags_from_text
from noticelake.operators.paging import envelope, listing_order, page, top_k
from noticelake.operators.predicates import SearchParams, apply, clamp_limit, listing_filters
from noticelake.operators.shares import counted


def matching(df: DataFrame, params: SearchParams) -> DataFrame:
    return apply(df, listing_filters(params))


def search(df: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """Rows of the asked page."""
    return page(matching(df, params), listing_order(params.order), params.page, params.page_size)


def search_envelope(df: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    given = {k: v for k, v in asdict(params).items() if v is not None and k not in ("page", "page_size")}
    return envelope(matching(df, params), params.page, params.page_size, params.source, given)


def audited_search(df: DataFrame, params: SearchParams, user: str, as_of, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Page with a clamped size, and the row to append to the consumption log."""
    size = clamp_limit(limit)
    rows = page(matching(df, params), listing_order(params.order), params.page, size)
    given = {k: v for k, v in asdict(params).items() if v is not None}
    log = rows.agg(F.count(F.lit(1)).alias("rows_returned")).select(
        F.lit(user).alias("user_id"),
        F.to_json(F.create_map(*[F.lit(str(x)) for kv in given.items() for x in kv])).alias("filter_applied"),
        "rows_returned",
        F.lit(as_of).cast("timestamp").alias("created_at"),
    )
    return rows, log


def region_facet(df: DataFrame, source: str | None = None, future_only: bool = True) -> DataFrame:
    rows = df.where(F.col("region").isNotNull())
    return _facet(rows, "region", source, future_only)


def city_facet(df: DataFrame, region: str, source: str | None = None, future_only: bool = True) -> DataFrame:
    rows = df.where((F.col("region") == region) & F.col("city").isNotNull())
    return _facet(rows, "city", source, future_only)


def _facet(rows: DataFrame, key: str, source: str | None, future_only: bool) -> DataFrame:
    if future_only:
        rows = rows.where(F.col("temporal_status") == "future")
    if source:
        rows = rows.where(F.col("source_type") == source)
    return counted(rows, [key]).orderBy(F.desc("total"), key)


def notice_summary(notices: DataFrame, limit: int | None = None, columns: Sequence[str] = ("id", "title", "published_at"), time: str = "published_at", tie: str = "id") -> DataFrame:
    """The columns of a notice that a list shows, newest publication first; undated ones come last."""
    order = [F.col(time).desc_nulls_last(), F.col(tie).asc()]
    rows = notices.select(*dict.fromkeys([*columns, time, tie]))
    return (rows.orderBy(*order) if limit is None else top_k(rows, order, limit)).select(*columns)


def distinct_values(df: DataFrame, column: str, sep: str | None = None) -> DataFrame:
    """Sorted distinct values; arrays, and with ``sep`` separated texts, are opened first."""
    kind = df.schema[column].dataType.typeName()
    if kind == "array":
        df = df.select(F.explode(column).alias(column))
    if sep is not None:
        df = df.select(F.explode(tags_from_text(F.col(column), sep)).alias(column))
    return df.select(F.trim(F.col(column)).alias(column)).where(F.length(column) > 0).distinct().orderBy(column)
