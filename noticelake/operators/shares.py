"""Counts with shares, fill rates and other one-pass profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.money import percent
from noticelake.functions.text import sentinel_to_null


def count_of(cond: Column) -> Column:
    return F.count_if(cond)


def counted(df: DataFrame, keys: Sequence[str], total: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(total))


def with_share(counts: DataFrame, n: str = "total", share: str = "percent", digits: int = 2) -> DataFrame:
    """Percentage of the sum over all groups; the sum is a scalar subquery over the small counts."""
    whole = counts.agg(F.sum(n).alias("w")).scalar()
    return counts.withColumn(share, percent(F.col(n), whole, digits))


def distribution(df: DataFrame, column: str, null_name: str = "NULL") -> DataFrame:
    """Count and share per value with a bucket for NULL."""
    value = F.coalesce(F.col(column).cast("string"), F.lit(null_name))
    return with_share(counted(df.select(value.alias(column)), [column]))


def long_form(one_row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One wide row of numbers as (name, value) rows."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return one_row.selectExpr(f"stack({len(columns)}, {pairs}) AS (`{name}`, `{value}`)")


def fill_rates(df: DataFrame, columns: Sequence[str], sentinels: Sequence[str] = ("N/D",)) -> DataFrame:
    """Filled rows and percentage per column, in one scan."""
    filled = [F.count(sentinel_to_null(F.col(c).cast("string"), sentinels)).alias(c) for c in columns]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *filled)
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    out = wide.selectExpr("_rows", f"stack({len(columns)}, {pairs}) AS (column_name, filled)")
    return out.select("column_name", "filled", F.col("_rows").alias("total"), percent(F.col("filled"), F.col("_rows"), 1).alias("fill_percent"))


def mean_fill_rate(rates: DataFrame) -> DataFrame:
    return rates.agg(F.round(F.avg("fill_percent"), 1).alias("mean_fill_percent"))


def flag_counts(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """One row with a row count and one count per condition."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(n) for n, c in flags.items()])


def compliance(df: DataFrame, column: str, pattern: str, good: int = 100, fair: int = 90) -> DataFrame:
    """Share of non-null values that match a pattern, with a grade. The grade goes by the counts: a share rounded up to a limit doesn't reach it."""
    one = df.agg(F.count(column).alias("checked"), F.count_if(F.col(column).rlike(pattern)).alias("compliant"))
    rate = percent(F.col("compliant"), F.col("checked"))

    def reached(limit: int) -> Column:
        return (F.col("checked") > 0) & (F.col("compliant") * 100 >= F.col("checked") * limit)

    grade = F.when(reached(good), F.lit("ok")).when(reached(fair), F.lit("warning")).otherwise(F.lit("failed"))
    return one.withColumn("compliance_percent", rate).withColumn("grade", grade)


def top_with_share(df: DataFrame, column: str, k: int, null_name: str | None = None) -> DataFrame:
    key = F.coalesce(F.col(column), F.lit(null_name)) if null_name else F.col(column)
    counts = with_share(counted(df.select(key.alias(column)), [column]))
    return counts.orderBy(F.desc("total"), F.col(column)).limit(k)
