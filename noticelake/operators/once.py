"""Columns that are computed in one place."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``columns``, evaluated exactly once per row.

    The optimizer copies a projected expression into every filter above it, and an expression that
    feeds several others is copied several times. For regular expressions and parsers that
    multiplies the work per row. A one-element ``explode_outer`` keeps filters on its
    output above it, while filters on other columns still pass down to the scan. The values are made in a
    projection below it, where what several of them share is computed once.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    rows = df.select(*kept, made.alias("_made"))
    return rows.select(*kept, F.explode_outer(F.array("_made")).alias("_once")).select(*kept, *[F.col("_once").getField(n).alias(n) for n in columns])
