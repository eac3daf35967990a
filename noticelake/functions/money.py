"""Money and number columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_br_money(c: Column) -> Column:
    """Dots are always thousands, the comma is the decimal mark; placeholders give NULL."""
    digits = F.trim(F.regexp_replace(c, r"(?i)R\$|\s| ", ""))
    plain = F.translate(F.replace(digits, F.lit("."), F.lit("")), ",", ".")
    return plain.try_cast("decimal(18,2)")


def parse_money(c: Column) -> Column:
    """Decimal mark found by position: with both marks the last one is decimal, a lone comma is
    decimal, a lone dot is a thousands mark only in groups of three. No digits gives NULL."""
    t = F.trim(F.regexp_replace(c, r"(?i)R\$", ""))
    last_comma = F.length(t) - F.locate(",", F.reverse(t))
    last_dot = F.length(t) - F.locate(".", F.reverse(t))
    comma, dot = F.contains(t, F.lit(",")), F.contains(t, F.lit("."))
    no_dots = F.replace(t, F.lit("."), F.lit(""))
    no_commas = F.replace(t, F.lit(","), F.lit(""))
    plain = (
        F.when(comma & dot & (last_comma > last_dot), F.translate(no_dots, ",", "."))
        .when(comma & dot, no_commas)
        .when(comma, F.translate(t, ",", "."))
        .when(dot & t.rlike(r"^[^.]*(\.[^.]{3})+$"), no_dots)
        .otherwise(t)
    )
    return F.nullif(F.regexp_replace(plain, r"[^\d.]", ""), F.lit("")).try_cast("decimal(18,2)")


def positive_or_null(c: Column) -> Column:
    return F.when(c > 0, F.round(c, 2))


def format_br_money(c: Column, missing: str = "N/D") -> Column:
    """``R$ 1.234,56``; zero, NaN and NULL give the placeholder."""
    ok = c.isNotNull() & (c != 0) & ~F.isnan(c.cast("double"))
    text = F.translate(F.format_number(c, 2), ",.", ".,")
    return F.when(ok, F.concat(F.lit("R$ "), text)).otherwise(F.lit(missing))


def parse_int(c: Column) -> Column:
    return F.trim(c).try_cast("bigint")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole as a decimal, 0 for an empty whole."""
    p = part.cast("decimal(24,6)") * F.lit(100)
    return F.when(whole == 0, F.lit(0)).otherwise(F.round(F.try_divide(p, whole.cast("decimal(24,6)")), digits)).cast(
        f"decimal(24,{digits})"
    )
