"""Quality reports of validated runs and of quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticelake.functions.money import percent
from noticelake.operators.paging import top_k_per
from noticelake.operators.shares import count_of, counted, distribution, fill_rates, with_share

STATUSES = ("valid", "draft", "not_sellable", "rejected")


def report(validated: DataFrame, run: str = "run_id") -> DataFrame:
    """One row per run: status counts and rates, 0 for an empty run."""
    one = validated.groupBy(run).agg(
        F.count(F.lit(1)).alias("total"), *[count_of(F.col("status") == s).alias(f"{s}_count") for s in STATUSES]
    )
    quarantined = F.col("total") - F.col("valid_count")
    return one.select(
        "*",
        quarantined.alias("quarantine_count"),
        percent(F.col("valid_count"), F.col("total")).alias("valid_percent"),
        percent(quarantined, F.col("total")).alias("quarantine_percent"),
    )


def error_counts(validated: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Occurrences per given keys of the exploded errors (code, field)."""
    # explode_outer: no filter on the array is derived and pushed below, where it would be computed again.
    exploded = validated.select(*[k for k in keys if k not in ("code", "field")], F.explode_outer("errors").alias("e"))
    flat = exploded.select("*", F.col("e.code").alias("code"), F.col("e.field").alias("field")).drop("e").where(F.col("code").isNotNull())
    if ignore:
        flat = flat.where(~F.col("code").isin(list(ignore)))
    return counted(flat, list(keys))


def top_errors(validated: DataFrame, run: str = "run_id", k: int = 10) -> DataFrame:
    """Top codes per run by count then code, with their share of all errors of the run."""
    counts = error_counts(validated, [run, "code"])
    shared = counts.withColumn("_all", F.sum("total").over(W.partitionBy(run)))
    ranked = top_k_per(shared, [run], [F.desc("total"), F.col("code")], k)
    return ranked.select(run, "rank", "code", "total", percent(F.col("total"), F.col("_all")).alias("percent"))


def top_reasons(quarantine: DataFrame, k: int = 20, null_name: str | None = None) -> DataFrame:
    key = F.coalesce("reason_code", F.lit(null_name)) if null_name else F.col("reason_code")
    counts = with_share(counted(quarantine.select(key.alias("reason_code")), ["reason_code"]))
    return counts.orderBy(F.desc("total"), "reason_code").limit(k)


def quarantine_by_run(quarantine: DataFrame) -> DataFrame:
    return counted(quarantine, ["run_id", "status"])


def quarantine_summary(quarantine: DataFrame, code: str, status: str, time: str, statuses: Sequence[str]) -> DataFrame:
    """Per code: rows, rows per review status, first and last time."""
    return quarantine.groupBy(code).agg(
        F.count(F.lit(1)).alias("total"),
        *[count_of(F.col(status) == s).alias(s) for s in statuses],
        F.min(time).alias("first_seen"),
        F.max(time).alias("last_seen"),
    )


def describe_codes(counts: DataFrame, codes: DataFrame, code: str = "code") -> DataFrame:
    """Counts joined to the description and severity of each code."""
    return counts.join(codes, code, "left")


def missing_field_profile(rows: DataFrame, missing: str, columns: Sequence[str], patterns: dict[str, Column]) -> DataFrame:
    """For rows that lack ``missing``: how often other columns are filled and patterns hit."""
    lacking = rows.where(F.col(missing).isNull() | F.trim(F.col(missing).cast("string")).isin("", "N/D"))
    return lacking.agg(
        F.count(F.lit(1)).alias("rows_missing"),
        *[F.count(F.col(c)).alias(f"has_{c}") for c in columns],
        *[F.count_if(p).alias(f"hit_{n}") for n, p in patterns.items()],
    )


__all__ = [
    "describe_codes", "distribution", "error_counts", "fill_rates", "missing_field_profile", "quarantine_by_run",
    "quarantine_summary", "report", "top_errors", "top_reasons",
]
