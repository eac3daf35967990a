"""Orders, pages and top-k."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def listing_order(name: str, tie: str = "id") -> list[Column]:
    """Sort keys by name, NULLs last, closed by a unique key."""
    table = {
        "nearest": F.col("event_at").asc_nulls_last(),
        "farthest": F.col("event_at").desc_nulls_last(),
        "value_desc": F.col("value").desc_nulls_last(),
        "value_asc": F.col("value").asc_nulls_last(),
        "newest": F.col("published_at").desc_nulls_last(),
        "oldest": F.col("published_at").asc_nulls_last(),
    }
    return [table[name], F.col(tie).asc()]


def page(df: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """Rows of one page; planned as a top-k, never as a full sort."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def envelope(df: DataFrame, number: int, size: int, source: str | None = None, filters: Mapping[str, object] | None = None) -> DataFrame:
    """One row: total, page, page size, page count, the echoed source filter and all filters as JSON, by name."""
    given = {k: list(v) if isinstance(v, (tuple, set, frozenset)) else v for k, v in sorted((filters or {}).items())}
    echo = json.dumps(given, ensure_ascii=False, separators=(",", ":"), default=str)
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        "total",
        F.lit(number).alias("page"),
        F.lit(size).alias("page_size"),
        F.ceil(F.greatest(F.col("total"), F.lit(1)) / F.lit(size)).alias("total_pages"),
        F.lit(source).cast("string").alias("source_filter"),
        F.lit(echo).alias("filters"),
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_per(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)


def severity_order(severity: str, time: str, tie: str) -> list[Column]:
    rank = F.when(F.col(severity) == "critical", 1).when(F.col(severity) == "warning", 2).otherwise(3)
    return [rank, F.col(time).desc(), F.col(tie)]


def natural_number(lot_no: Column) -> Column:
    """The number that the text is, or NULL. Only texts of digits are cast: a cast that fails throws inside Spark, which takes far longer than the cast."""
    return F.when(lot_no.rlike(r"^[^0-9A-Za-z]*[0-9]+[^0-9A-Za-z]*$"), lot_no.try_cast("int"))


def natural_order(lot_no: str) -> list[Column]:
    """Numbers by value first, then everything as text. A sort works an expression out for every comparison: large ones take ``natural_number`` as a column."""
    return [natural_number(F.col(lot_no)).asc_nulls_last(), F.col(lot_no).asc()]
