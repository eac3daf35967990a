"""Raw payloads staged whole as variants; typed columns are taken out by path when they are needed.

A payload with fields that nobody has heard of is stored and given back as it came.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_payloads(raw: DataFrame, column: str, into: str = "payload") -> DataFrame:
    """``raw`` with the JSON text of ``column`` as a variant, and whether it could be read; text that is no JSON has a NULL payload."""
    v = F.try_parse_json(F.col(column))
    return raw.withColumn(into, v).withColumn(f"{into}_ok", v.isNotNull() | F.col(column).isNull())


def typed(staged: DataFrame, fields: Mapping[str, tuple[str, str]], payload: str = "payload") -> DataFrame:
    """Adds a column for each field (path, type). A missing field, or one that doesn't fit the type, is NULL."""
    return staged.withColumns({n: F.try_variant_get(F.col(payload), path, kind) for n, (path, kind) in fields.items()})


def foreign_fields(staged: DataFrame, known: list[str], payload: str = "payload") -> DataFrame:
    """(field, kind, payloads): fields at the top of payloads that are not among ``known``, with the types they come in."""
    fields = F.map_entries(F.try_variant_get(F.col(payload), "$", "map<string, variant>"))
    each = staged.select(F.explode(fields).alias("e")).select(F.col("e.key").alias("field"), F.schema_of_variant("e.value").alias("kind"))
    return each.where(~F.col("field").isin(*known)).groupBy("field", "kind").agg(F.count(F.lit(1)).alias("payloads"))


def as_text(payload: str = "payload"):
    """The whole payload as JSON text, fields in the order of their names."""
    return F.to_json(F.col(payload))
