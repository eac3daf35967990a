"""Location coverage, the location dimension and region repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.functions.money import percent
from noticelake.functions.text import place_title_case
from noticelake.operators.joins import join_place, place_key
from noticelake.operators.shares import counted


def geocode_coverage(notices: DataFrame, dim: DataFrame, fold: bool = True, code: str = "place_code") -> DataFrame:
    """One row: rows, matched rows, percentage. Rows are folded to distinct places before the join."""
    places = notices.groupBy("city", "region").agg(F.count(F.lit(1)).alias("n"))
    j = join_place(places, dim, fold=fold)
    matched = F.coalesce(F.sum(F.when(F.col(code).isNotNull(), F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return j.agg(total.alias("total"), matched.alias("matched"), percent(matched, total).alias("matched_percent"))


def unmatched_places(notices: DataFrame, dim: DataFrame, k: int = 20, fold: bool = True, code: str = "place_code") -> DataFrame:
    places = notices.groupBy("city", "region").agg(F.count(F.lit(1)).alias("total"))
    missing = join_place(places, dim, fold=fold).where(F.col(code).isNull())
    return missing.select("city", "region", "total").orderBy(F.desc("total"), F.col("city").asc_nulls_last(), F.col("region").asc_nulls_last()).limit(k)


def build_dimension(names: DataFrame, coords: DataFrame, missing: str = "omit") -> DataFrame:
    """Places with coordinates by code. ``missing``: omit the place, or zero for its coordinates."""
    c = coords.select("place_code", F.col("latitude").cast("decimal(10,6)").alias("latitude"), F.col("longitude").cast("decimal(10,6)").alias("longitude"))
    j = names.withColumn("place_name", place_title_case(F.col("place_name"))).join(c, "place_code", "left")
    if missing == "omit":
        return j.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    zero = F.lit(0).cast("decimal(10,6)")
    return j.withColumn("latitude", F.coalesce("latitude", zero)).withColumn("longitude", F.coalesce("longitude", zero))


def missing_coordinates(names: DataFrame, coords: DataFrame) -> DataFrame:
    return names.join(coords.where(F.col("latitude").isNotNull()).select("place_code"), "place_code", "left_anti")


def region_from_dimension(df: DataFrame, dim: DataFrame, regions) -> DataFrame:
    """Invalid region codes replaced from the dimension, for city names that exist in one region only."""
    unique = (
        dim.groupBy(place_key(F.col("place_name"), True).alias("_city"))
        .agg(F.count_distinct("place_region").alias("n"), F.min("place_region").alias("_region"))
        .where("n = 1")
        .drop("n")
    )
    j = df.withColumn("_city", place_key(F.col("city"), True)).join(unique, "_city", "left")
    ok = F.col("region").isin(list(regions))
    return j.withColumn("region", F.when(F.coalesce(ok, F.lit(False)), F.col("region")).otherwise(F.coalesce("_region", "region"))).drop("_city", "_region")


def region_counts(df: DataFrame) -> DataFrame:
    return counted(df, ["region"])
