"""Relevance of notices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.functions.scores import weighted_terms
from noticelake.presets import br_notices as br


def score_relevance(
    df: DataFrame, columns: Sequence[str], weights: Mapping[str, int] = br.RELEVANCE_WEIGHTS, base: int = br.RELEVANCE_BASE, out: str = "score"
) -> DataFrame:
    """Base plus weights of all terms found in the joined, lower-cased text; 0..100."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))
    return df.withColumn(out, weighted_terms(text, weights, base))


def relevant(df: DataFrame, minimum: int = br.RELEVANCE_MINIMUM, column: str = "score") -> DataFrame:
    return df.where(F.col(column) >= minimum)
