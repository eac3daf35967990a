"""Array and JSON columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.text import let


def tags_from_text(c: Column, sep: str = ",") -> Column:
    """Trimmed, non-blank parts of a separated text."""
    return F.filter(F.transform(F.split(c, sep), lambda x: F.trim(x)), lambda t: F.length(t) > 0)


def tags_to_text(c: Column) -> Column:
    return F.array_join(c, ", ")


def without_tags(c: Column, forbidden: Iterable[str]) -> Column:
    """Array without the given tags, compared without case."""
    drop = [t.lower() for t in forbidden]
    return F.filter(c, lambda t: ~F.lower(t).isin(drop))


def tags_by_words(text: Column, words: Mapping[str, Iterable[str]], default: str | None = None) -> Column:
    """Sorted tags whose word list has a hit in ``text``.

    The whole rule table is one literal array, so the plan does not grow by a branch per word.
    """
    rules = F.array(
        *[F.struct(F.lit(tag).alias("tag"), F.array(*[F.lit(w) for w in ws]).alias("words")) for tag, ws in words.items()]
    )

    def found(t: Column) -> Column:
        hit = F.filter(rules, lambda r: F.exists(r["words"], lambda w: F.coalesce(F.contains(t, w), F.lit(False))))
        return F.sort_array(F.array_distinct(F.transform(hit, lambda r: r["tag"])))

    tags = let(text, found)
    return let(tags, lambda t: F.when(F.size(t) == 0, F.array(F.lit(default))).otherwise(t)) if default else tags


def overlap(a: Column, b: Column) -> Column:
    """True when the arrays share an element; NULL arrays and NULL elements never match."""
    return F.coalesce(F.size(F.array_intersect(F.array_compact(a), F.array_compact(b))) > 0, F.lit(False))


def tag_mentions(c: Column, word: str) -> Column:
    """True when any tag contains ``word``, without case."""
    return F.coalesce(F.exists(c, lambda t: F.contains(F.upper(t), F.lit(word.upper()))), F.lit(False))


def tag_class(c: Column) -> Column:
    return (
        F.when(tag_mentions(c, "SUCATA"), F.lit("sucata"))
        .when(tag_mentions(c, "DOCUMENTADO"), F.lit("documentado"))
        .otherwise(F.lit("outro"))
    )


def json_text(c: Column, key: str) -> Column:
    """Top-level JSON value as text; empty text counts as absent."""
    return F.nullif(F.get_json_object(c, f"$.{key}"), F.lit(""))
