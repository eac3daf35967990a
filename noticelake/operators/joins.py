"""Joins that need more than a plain equality."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.text import fold_accents, let
from noticelake.functions.urls import host_suffixes

SALTS = 16


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], row_id: str, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Equi-join for a left side with hot keys: every key is spread over ``salts`` tasks.

    The salt is a hash of ``row_id``, so a retried task sends its rows to the same place.
    """
    l = left.withColumn("_salt", F.pmod(F.xxhash64(F.col(row_id)), F.lit(salts)).cast("int"))
    r = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return l.join(r, [*keys, "_salt"], how).drop("_salt")


def place_key(c: Column, fold: bool = False) -> Column:
    key = F.upper(F.trim(c))
    return F.upper(fold_accents(key)) if fold else key


def join_place(
    df: DataFrame,
    dim: DataFrame,
    city: str = "city",
    region: str = "region",
    dim_city: str = "place_name",
    dim_region: str = "place_region",
    fold: bool = False,
) -> DataFrame:
    """Left join to the location dimension on upper/trimmed name and region.

    The dimension is a few thousand rows on disk; Spark broadcasts it by its file size, and with
    a larger one adaptive execution splits the hot names.
    """
    d = dim.withColumn("_city", place_key(F.col(dim_city), fold)).withColumn("_region", F.col(dim_region)).drop(dim_region)
    left = df.withColumn("_city", place_key(F.col(city), fold)).withColumn("_region", F.col(region))
    return left.join(d, ["_city", "_region"], "left").drop("_city", "_region")


def allowed_hosts(hosts: DataFrame, allow: DataFrame, host: str = "host", domain: str = "domain") -> DataFrame:
    """Distinct hosts that equal an allowed domain or end with a dot and one.

    Suffixes turn the match into an equality; rows were reduced to distinct hosts before.
    """
    distinct = hosts.select(host).where(F.col(host).isNotNull()).distinct()
    suffixes = distinct.select(host, F.explode(host_suffixes(F.col(host))).alias("_suffix"))
    return suffixes.join(allow.select(F.lower(domain).alias("_suffix")).distinct(), "_suffix", "left_semi").select(host).distinct()


def mark_allowed(df: DataFrame, allow: DataFrame, host: str = "host", domain: str = "domain") -> DataFrame:
    """Adds ``host_allowed``. Adaptive execution broadcasts the allowed hosts or splits a hot one."""
    hits = allowed_hosts(df, allow, host, domain).withColumn("_allowed", F.lit(True))
    out = df.join(hits, host, "left")
    return out.withColumn("host_allowed", F.coalesce("_allowed", F.lit(False))).drop("_allowed")


def tag_by_terms(df: DataFrame, terms: DataFrame, text: str, row_id: str, whole_words: bool = False) -> DataFrame:
    """``terms`` (term, tag) found in a text column, as a sorted tag array per row; one way for any number of terms.

    A term is looked up by its first word (``whole_words``) or its first three characters, so all pairs are
    never compared. Texts stay out of that join: it hands on (row, fragment) pairs of fragments
    that some term has, and the texts are read again only for the terms behind them. Fragments meet the terms' in a semi join, which
    can only broadcast the terms, and all other joins are merges: a table of few different values is a small file, and
    Spark would broadcast its rows, or the many that an explode makes of them, by the size of the file.
    """
    look = as_words if whole_words else (lambda c: c)
    t = terms.select("term", "tag").where(F.length("term") > 0).distinct().withColumn("_needle", look(F.col("term")))
    if whole_words:
        t = t.where(F.length(F.trim("_needle")) > 0)
    t = t.withColumn("_part", F.get(F.split(F.trim("_needle"), " "), F.lit(0)) if whole_words else F.substring("_needle", 1, 3))
    seen = let(look(F.col(text)), lambda x: F.array_distinct(F.split(F.trim(x), " ")) if whole_words else _fragments(x))
    parts = df.select(row_id, F.explode(seen).alias("_part")).join(t.select("_part").distinct(), "_part", "left_semi")
    found = parts.join(t.hint("merge"), "_part").select(row_id, "tag", "_needle").distinct()
    texts = df.select(row_id, look(F.col(text)).alias("_looked"))
    hits = found.join(texts.hint("merge"), row_id).where(F.contains("_looked", "_needle"))
    tags = hits.groupBy(row_id).agg(F.sort_array(F.collect_set("tag")).alias("tags"))
    return df.join(tags.hint("merge"), row_id, "left").withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))


def _fragments(text: Column) -> Column:
    """Distinct pieces of one, two and three characters."""
    def of(n: int) -> Column:
        last = F.length(text) - (n - 1)
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(of(1), of(2), of(3))))


def as_words(c: Column) -> Column:
    """Words of a text between single blanks, with a blank at both ends: word match becomes containment."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def match_terms(text: Column, rules: dict[str, Iterable[str]], whole_words: bool = False) -> Column:
    """Sorted tags with a term in ``text``; substring match, or whole words on request."""
    def term(x: str) -> Column:
        return as_words(F.lit(x)) if whole_words else F.lit(x)

    table = F.array(*[F.struct(F.lit(tag).alias("tag"), F.array(*[term(x) for x in ws]).alias("terms")) for tag, ws in sorted(rules.items())])

    looked_at = as_words(text) if whole_words else text
    hit = let(looked_at, lambda t: F.filter(table, lambda r: F.exists(r["terms"], lambda w: F.coalesce(F.contains(t, w), F.lit(False)))))
    return F.sort_array(F.transform(hit, lambda r: r["tag"]))


def zip_lists(df: DataFrame, lists: dict[str, Column], keep: Sequence[str], at_least: Sequence[str]) -> DataFrame:
    """Match lists read side by side: row i holds the i-th entry of every list.

    Rows go as far as the shortest list named in ``at_least``; shorter optional lists give NULL.
    """
    length = F.least(*[F.size(lists[n]) for n in at_least]) if len(at_least) > 1 else F.size(lists[at_least[0]])
    rows = F.slice(F.arrays_zip(*[c.alias(n) for n, c in lists.items()]), F.lit(1), F.greatest(length, F.lit(0)))
    out = df.select(*keep, F.posexplode(rows).alias("position", "_row"))
    return out.select(*keep, (F.col("position") + 1).alias("position"), *[F.col("_row").getField(n).alias(n) for n in lists])


def prefer(primary: DataFrame, secondary: DataFrame, key: str) -> DataFrame:
    """Union by key where the primary row wins."""
    rest = secondary.join(primary.select(key).distinct(), key, "left_anti")
    return primary.unionByName(rest, allowMissingColumns=True)
