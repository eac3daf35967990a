"""Key migration: stable new ids, rewritten in every table, checked afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.operators.keyed import rewrite_ids


def id_mapping(tables: Sequence[DataFrame], column: str, new_id: Column, needs: Column) -> DataFrame:
    """(old_id, new_id) for every distinct old id of all tables that needs one. ``new_id`` and
    ``needs`` are expressions over ``old_id``; NULL ids are left alone."""
    every = tables[0].select(F.col(column).alias("old_id"))
    for t in tables[1:]:
        every = every.unionByName(t.select(F.col(column).alias("old_id")))
    return every.where(F.col("old_id").isNotNull() & needs).distinct().select("old_id", new_id.alias("new_id"))


def stable_new_id(old_id: str = "old_id", prefix: str = "ID_") -> Column:
    """New id derived from the old one, so a second run gives the same mapping."""
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(F.col(old_id).cast("string"), 256), 1, 12)))


def migrate(tables: dict[str, DataFrame], column: str, mapping: DataFrame) -> dict[str, DataFrame]:
    return {n: rewrite_ids(t, mapping, column) for n, t in tables.items()}


def check(before: DataFrame, after: DataFrame, column: str, needs_old: Column) -> DataFrame:
    """One row: rows before and after, distinct ids before and after, ids that still need migration."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"), F.count_distinct(column).alias("ids_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"), F.count_distinct(column).alias("ids_after"), F.count_if(needs_old).alias("open"))
    return a.select(b.select("rows_before").scalar().alias("rows_before"), "rows_after", b.select("ids_before").scalar().alias("ids_before"), "ids_after", "open")


def duplicate_ids(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("new_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
