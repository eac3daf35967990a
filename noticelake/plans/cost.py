"""Cost of runs, unit costs and usage against limits."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.money import percent
from noticelake.presets import br_notices as br


def _d(x: str) -> Column:
    return F.lit(Decimal(x))


def run_cost(documents: Column, rows: Column, tokens: Column) -> Column:
    """Struct(total, tokens, per_thousand, breakdown) of a run."""
    doc_cost = documents.cast("decimal(18,0)") * _d(br.PRICE_PER_DOCUMENT)
    row_cost = rows.cast("decimal(18,0)") * _d(br.PRICE_PER_ROW)
    token_cost = tokens.cast("decimal(18,0)") * _d(br.PRICE_PER_TOKEN)
    total = doc_cost + row_cost + token_cost
    per_thousand = F.when(rows > 0, total / rows.cast("decimal(18,0)") * 1000).otherwise(F.lit(0))

    def r(c: Column) -> Column:
        return F.round(c, 4).cast("decimal(24,4)")

    return F.struct(
        r(total).alias("total"),
        r(token_cost).alias("tokens"),
        r(per_thousand).alias("per_thousand"),
        F.struct(r(doc_cost).alias("documents"), r(row_cost).alias("rows"), r(token_cost).alias("tokens")).alias("breakdown"),
    )


def token_cost(tokens_in: Column, tokens_out: Column) -> Column:
    million = F.lit(1_000_000)
    cost = tokens_in.cast("decimal(18,0)") / million * _d(br.PRICE_INPUT_MILLION) + tokens_out.cast("decimal(18,0)") / million * _d(br.PRICE_OUTPUT_MILLION)
    return F.round(cost, 6).cast("decimal(18,6)")


def unit_economics(totals: DataFrame) -> DataFrame:
    """Adds cost per run, per row and per stored megabyte (0 where the divisor is 0).

    Totals: cost, runs, rows, storage_mb.
    """
    def per(n: str) -> Column:
        c = F.col("cost").cast("decimal(18,6)")
        return F.when(F.col(n) > 0, F.round(F.try_divide(c, F.col(n).cast("decimal(18,6)")), 6)).otherwise(F.lit(0)).cast("decimal(24,6)")

    return totals.select("*", per("runs").alias("per_run"), per("rows").alias("per_row"), per("storage_mb").alias("per_mb"))


def storage_plan(rows: Column, max_rows: int, max_mb: int, kb_per_row: int = 3) -> Column:
    """Struct(estimated_mb, plan, monthly_cost): free within both limits, else base price plus overage per GB."""
    mb = rows.cast("decimal(18,0)") * kb_per_row / F.lit(1024)
    fits = (rows <= max_rows) & (mb <= max_mb)
    over_gb = F.greatest(mb - F.lit(max_mb), F.lit(0).cast("decimal(24,6)")) / F.lit(1024)
    paid = _d(br.PLAN_BASE) + over_gb * _d(br.PLAN_PER_GB)
    return F.struct(
        F.round(mb, 2).cast("decimal(18,2)").alias("estimated_mb"),
        F.when(fits, F.lit("free")).otherwise(F.lit("paid")).alias("plan"),
        F.when(fits, F.lit(0)).otherwise(F.round(paid, 4)).cast("decimal(18,4)").alias("monthly_cost"),
    )


def usage_tier(used: Column, limit: Column) -> Column:
    """Struct(percent, level): critical above 90 %, warning above 80 %."""
    p = percent(used, limit, 1)
    level = F.when(used > limit * F.lit(Decimal("0.9")), F.lit("critical")).when(used > limit * F.lit(Decimal("0.8")), F.lit("warning")).otherwise(F.lit("ok"))
    return F.struct(p.alias("percent"), level.alias("level"))
