"""Region code columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.text import contains_any, fold_accents, let


def valid_region(c: Column, regions: Iterable[str]) -> Column:
    code = F.substring(F.upper(F.trim(c)), 1, 2)
    return F.when(code.isin(list(regions)), code)


def region_in_text(c: Column, regions: Iterable[str], names: Mapping[str, str]) -> Column:
    """Region found in free text: trailing code, then a code as its own word, then a full name.

    Names are tried from longest to shortest so that a short one never wins inside a longer one.
    """
    regions = list(regions)
    text = F.trim(c)
    tail = F.upper(F.regexp_extract(text, r"[-/\s]([A-Za-z]{2})$", 1))
    tokens = F.split(F.upper(text), r"\s+")
    token = F.get(F.filter(F.slice(tokens, F.lit(2), F.size(tokens)), lambda t: t.isin(regions)), F.lit(0))
    first = F.get(F.filter(F.slice(tokens, 1, 1), lambda t: t.isin(regions)), F.lit(0))
    folded = fold_accents(text)
    ordered = sorted(names.items(), key=lambda kv: (-len(kv[0]), kv[0]))
    table = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(r).alias("region")) for n, r in ordered])
    named = let(folded, lambda t: F.get(F.filter(table, lambda e: F.contains(t, e["name"])), F.lit(0)))["region"]
    return F.coalesce(F.when(tail.isin(regions), tail), first, token, named)


def repair_region(
    region: Column,
    city: Column,
    agency: Column,
    regions: Iterable[str],
    names: Mapping[str, str],
    federal_words: Iterable[str],
    federal_region: str,
) -> Column:
    """Own code, then city text, then agency text, then the federal default."""
    code = F.upper(F.trim(region))
    return F.coalesce(
        F.when(code.isin(list(regions)), code),
        region_in_text(city, regions, names),
        region_in_text(agency, regions, names),
        F.when(contains_any(F.lower(agency), federal_words), F.lit(federal_region)),
        F.lit(federal_region),
    )
