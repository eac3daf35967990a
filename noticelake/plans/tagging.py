"""Tags from a term table, and the difference a re-tag makes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.functions.text import fold_accents
from noticelake.operators.joins import tag_by_terms
from noticelake.operators.predicates import keeps_category
from noticelake.operators.shares import counted
from noticelake.presets import br_notices as br
from noticelake.sources.readers import or_fallback


def flat_terms(taxonomy: DataFrame) -> DataFrame:
    """Active terms and their synonyms as (term, tag), accent-folded."""
    active = taxonomy.where(F.coalesce(F.col("active"), F.lit(True)) & F.col("term").isNotNull() & F.col("tag").isNotNull())
    every = F.concat(F.array("term"), F.coalesce("synonyms", F.array().cast("array<string>")))
    return active.select(F.explode(every).alias("t"), "tag").select(F.trim(fold_accents(F.col("t"))).alias("term"), "tag").distinct()


def fallback_terms(spark) -> DataFrame:
    return spark.createDataFrame([(t, tag) for tag, ts in br.FALLBACK_TERMS.items() for t in ts], "term string, tag string")


def tag_by_taxonomy(df: DataFrame, taxonomy: DataFrame | None, columns: Sequence[str], row_id: str, whole_words: bool = False) -> DataFrame:
    """Adds sorted ``tags``. The text is folded once, before any term is looked up."""
    terms = or_fallback(flat_terms(taxonomy), fallback_terms(df.sparkSession)) if taxonomy is not None else fallback_terms(df.sparkSession)
    text = fold_accents(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))
    return tag_by_terms(df.withColumn("_text", text), terms, "_text", row_id, whole_words).drop("_text")


def drop_off_topic(df: DataFrame, tags: str = "tags") -> DataFrame:
    return df.where(keeps_category(F.col(tags), br.CATEGORY_TAG, br.CATEGORY_KEEP))


def tag_changes(df: DataFrame, old: str, new: str) -> DataFrame:
    """One row: rows whose tag set changed and rows that kept it."""
    changed = (F.size(F.array_except(old, new)) > 0) | (F.size(F.array_except(new, old)) > 0)
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(changed).alias("changed"), F.count_if(~changed).alias("unchanged")
    )


def removed_tags(df: DataFrame, old: str, new: str) -> DataFrame:
    return counted(df.select(F.explode(F.array_except(old, new)).alias("tag")), ["tag"])


def added_tags(df: DataFrame, old: str, new: str) -> DataFrame:
    return counted(df.select(F.explode(F.array_except(new, old)).alias("tag")), ["tag"])


def terms_per_category(taxonomy: DataFrame) -> DataFrame:
    return counted(taxonomy, ["category"])
