"""Coverage of stored files and of columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.money import percent
from noticelake.operators.shares import counted, with_share


def file_coverage(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """(name, filled, total, percent) for each condition, in one scan."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(c).alias(n) for n, c in columns.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in columns)
    out = wide.selectExpr("_rows", f"stack({len(columns)}, {pairs}) AS (name, filled)")
    return out.select("name", "filled", F.col("_rows").alias("total"), percent(F.col("filled"), F.col("_rows")).alias("percent"))


def cause_shares(df: DataFrame, cause: Column) -> DataFrame:
    return with_share(counted(df.select(cause.alias("cause")), ["cause"]))


def storage_statistics(files: DataFrame, key: str = "notice_id", size: str = "bytes") -> DataFrame:
    """Files, bytes and folders of a full listing. Folded per folder first."""
    per = files.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b"))
    return per.agg(F.sum("n").alias("files"), F.sum("b").alias("bytes"), F.count(F.lit(1)).alias("notices"))
