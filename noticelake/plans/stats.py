"""Dashboard figures and grouped statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.money import percent
from noticelake.operators.shares import counted


def dashboard(df: DataFrame, as_of, region: str = "region", city: str = "city", value: str = "value", event: str = "event_at") -> DataFrame:
    """Rows, regions, cities, value, rows of the next seven days, future and past rows."""
    now = F.lit(as_of).cast("timestamp")
    week = (F.col(event) >= now) & (F.col(event) <= now + F.expr("INTERVAL 7 DAYS"))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(region).alias("regions"),
        F.count_distinct(city).alias("cities"),
        F.coalesce(F.sum(F.col(value).cast("decimal(18,2)")), F.lit(0)).alias("value_total"),
        F.count_if(week).alias("next_7_days"),
        F.count_if(F.col(event) >= now).alias("future_rows"),
        F.count_if(~F.coalesce(F.col(event) >= now, F.lit(False))).alias("past_rows"),
    )


def by_region(df: DataFrame, region: str, value: str, filled: Mapping[str, Column], latest: str) -> DataFrame:
    """Totals, filled counts, value sum, rounded mean and latest date per region."""
    v = F.col(value).cast("decimal(18,2)")
    return df.groupBy(region).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(c).alias(f"with_{n}") for n, c in filled.items()],
        F.sum(v).alias("value_total"),
        F.round(F.avg(v), 2).alias("value_mean"),
        F.max(latest).alias("latest"),
    )


def by_modality(df: DataFrame, modality: str, value: str) -> DataFrame:
    v = F.col(value).cast("decimal(18,2)")
    return df.groupBy(modality).agg(F.count(F.lit(1)).alias("total"), F.sum(v).alias("value_total"), F.round(F.avg(v), 2).alias("value_mean"))


def by_family(df: DataFrame, family: str, lots: str, failed: Column) -> DataFrame:
    """Documents, lots, mean lots and failures per document family."""
    return df.groupBy(family).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(lots).alias("lots"),
        F.round(F.avg(F.col(lots).cast("decimal(18,2)")), 2).alias("mean_lots"),
        F.count_if(failed).alias("failed"),
    )


def by_source(df: DataFrame, source: str, notice: str, value: str, time: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Listings, distinct notices, conditional counts and value range per source.

    Two levels: rows are first folded per (source, notice), so a source that holds a large part of
    all rows is spread over its notices.
    """
    v = F.col(value).cast("decimal(18,2)")
    inner = df.groupBy(source, notice).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(v).alias("nv"),
        F.sum(v).alias("sv"),
        F.min(v).alias("lo"),
        F.max(v).alias("hi"),
        F.max(time).alias("t"),
        *[F.count_if(c).alias(f"c_{k}") for k, c in conditions.items()],
    )
    return inner.groupBy(source).agg(
        F.sum("n").alias("total"),
        F.count(notice).alias("notices"),
        *[F.sum(f"c_{k}").alias(k) for k in conditions],
        F.min("lo").alias("value_min"),
        F.max("hi").alias("value_max"),
        F.round(F.try_divide(F.sum("sv"), F.sum("nv")), 2).alias("value_mean"),
        F.max("t").alias("latest"),
    )


def daily_summary(df: DataFrame, day: Column, region: str, modality: str, value: str, filled: Mapping[str, Column]) -> DataFrame:
    """Per day: rows, value, filled percentages and maps of counts by region and by modality.

    One pass over the rows down to (day, region, modality); everything else is built from those counts.
    """
    v = F.col(value).cast("decimal(18,2)")
    cells = (
        df.select(day.alias("day"), F.coalesce(region, F.lit("NULL")).alias("region"), F.coalesce(modality, F.lit("NULL")).alias("modality"), v.alias("v"),
                  *[c.cast("int").alias(f"f_{n}") for n, c in filled.items()])
        .groupBy("day", "region", "modality")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"), *[F.sum(f"f_{n}").alias(f"f_{n}") for n in filled])
    )

    def as_map(key: str) -> DataFrame:
        per = cells.groupBy("day", key).agg(F.sum("n").alias("n"))
        return per.groupBy("day").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias(f"by_{key}"))

    base = cells.groupBy("day").agg(
        F.sum("n").alias("total"), F.sum("v").alias("value_total"),
        *[percent(F.coalesce(F.sum(f"f_{n}"), F.lit(0)), F.sum("n")).alias(f"{n}_percent") for n in filled],
    )
    return base.join(as_map("region"), "day").join(as_map("modality"), "day")


def metric_rows(metrics: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Labelled one-value frames as (metric, value) rows."""
    out = None
    for label, df in metrics:
        row = df.select(F.lit(label).alias("metric"), F.col(df.columns[0]).cast("decimal(20,2)").alias("value"))
        out = row if out is None else out.unionByName(row)
    return out


def category_counts(df: DataFrame, category: str, names: Sequence[str], derived: Mapping[str, Sequence[str]] | None = None, rest: str | None = None) -> DataFrame:
    """One row: the total, a count per category, sums of several under the names in ``derived``, and under ``rest`` all that have none of them."""
    wide = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.coalesce(F.col(category) == n, F.lit(False))).alias(n) for n in names])
    sums = {name: sum((F.col(n) for n in members), F.lit(0).cast("bigint")) for name, members in (derived or {}).items()}
    if rest is not None:
        sums[rest] = F.col("total") - sum((F.col(n) for n in names), F.lit(0).cast("bigint"))
    return wide.withColumns(sums) if sums else wide


def temporal_counts(unified: DataFrame, region: str | None = None) -> DataFrame:
    """Rows by region and temporal status, of one region or of all."""
    rows = unified if region is None else unified.where(F.col("region") == region)
    return counted(rows, ["region", "temporal_status"])


def scraper_summary(results: DataFrame, scraper: str = "scraper") -> DataFrame:
    """Runs, rows found, new rows and errors by scraper, with the share of runs that went well and the last error.

    Results: scraper, status, found, new, error, finished_at.
    """
    failed = F.col("status") == "error"
    return results.groupBy(scraper).agg(
        F.count(F.lit(1)).alias("runs"), F.sum(F.coalesce("found", F.lit(0))).alias("found"), F.sum(F.coalesce("new", F.lit(0))).alias("new"), F.count_if(failed).alias("errors"),
        percent(F.count_if(F.col("status") == "success"), F.count(F.lit(1))).alias("success_percent"), F.max_by("error", F.when(failed, F.col("finished_at"))).alias("last_error"),
    )


def busiest(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    return counted(df, [key]).orderBy(F.desc("total"), key).limit(k)
