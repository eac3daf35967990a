"""Discovery of sources: link tables, keyword hits, official scores, recorded fetch outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.functions import urls as U
from noticelake.functions.classify import is_blocked
from noticelake.functions.extract import LINK_TAG, TITLE_TAG
from noticelake.functions.money import percent
from noticelake.functions.scores import points
from noticelake.functions.text import contains_any, matching_words, strip_html
from noticelake.operators.joins import prefer
from noticelake.operators.paging import top_k
from noticelake.operators.reach import bounded_reach
from noticelake.operators.shares import counted
from noticelake.presets import br_notices as br


def page_links(pages: DataFrame, extensions: Sequence[str] = br.BINARY_EXTENSIONS) -> DataFrame:
    """Edges (src, dst, src_host, dst_host) of absolute links; links to binary files are left out."""
    raw = pages.select(F.col("url").alias("src"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK_TAG), 1))).alias("href"))
    e = raw.select("src", F.regexp_replace(U.absolute(F.col("src"), F.col("href")), r"#.*$", "").alias("dst")).where(F.col("dst").isNotNull())
    e = e.where(~F.lower("dst").rlike(r"\.(" + "|".join(extensions) + r")$"))
    return e.select("src", "dst", U.bare_host(F.col("src")).alias("src_host"), U.bare_host(F.col("dst")).alias("dst_host")).distinct()


def page_title(pages: DataFrame) -> DataFrame:
    return pages.select("url", F.trim(F.regexp_extract("html", TITLE_TAG, 1)).alias("title"))


def enrich_candidates(pages: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Host, title, official flags and the keywords found in the title and visible text."""
    title = F.trim(F.regexp_extract("html", TITLE_TAG, 1))
    text = F.lower(F.concat_ws(" ", title, strip_html(F.col("html"))))
    rows = pages.select("url", U.host(F.col("url")).alias("domain"), title.alias("title"), matching_words(text, keywords).alias("k"))
    return rows.select(
        "url", "domain", "title", F.contains("domain", F.lit(".gov.br")).alias("is_gov_br"), F.contains("domain", F.lit("detran")).alias("is_detran"),
        F.size("k").alias("keywords_count"), F.array_join("k", "|").alias("keywords_found"),
    )


def score_sources(candidates: DataFrame, hits: DataFrame | None = None) -> DataFrame:
    """Official score 0..100 with its breakdown, class, region and blocked flag per URL.

    Columns: url, domain, title, keywords_found, status_code, error. A crawl hit counts only where
    there is no candidate row for its URL.
    """
    c = prefer(candidates, hits, "url") if hits is not None else candidates
    domain = F.lower(F.coalesce("domain", U.host(F.col("url"))))
    text = F.concat_ws(" ", "url", "title")
    p = br.OFFICIAL_POINTS
    score, breakdown = points(
        [
            ("HTTPS", p["HTTPS"], F.col("url").startswith("https://")),
            ("HTTP200", p["HTTP200"], F.coalesce(F.col("status_code").cast("string") == "200", F.lit(False))),
            ("GOV_BR", p["GOV_BR"], F.contains(domain, F.lit(".gov.br"))),
            ("DETRAN", p["DETRAN"], contains_any(domain, br.AGENCY_HOSTS)),
            ("KEYWORDS", p["KEYWORDS"], F.coalesce(F.length("keywords_found") > 0, F.lit(False))),
            ("EDITAL_REF", p["EDITAL_REF"], text.rlike(br.NOTICE_REFERENCE)),
            ("ORGAO_REF", p["ORGAO_REF"], text.rlike(br.AGENCY_REFERENCE)),
        ]
    )
    return c.select(
        "url", domain.alias("domain"), "title", score.alias("score"), breakdown.alias("score_breakdown"),
        U.host_class(domain, br.HOST_CLASSES, br.OTHER_HOST_CLASS).alias("category"), U.region_of_host(domain, br.REGIONS).alias("region"),
        F.coalesce("keywords_found", F.lit("")).alias("keywords"), "status_code",
        is_blocked(F.concat_ws(" ", "error", "title"), br.BLOCKED_WORDS).alias("is_blocked"), "error",
    )


def ranked_sources(scored: DataFrame, k: int = 30) -> DataFrame:
    return top_k(scored.where(~F.col("is_blocked")), [F.desc("score"), F.col("url")], k)


def source_report(scored: DataFrame) -> DataFrame:
    """URLs, approved and blocked per category."""
    return scored.groupBy("category").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("score") >= br.OFFICIAL_MINIMUM).alias("approved"),
        F.count_if("is_blocked").alias("blocked"),
    )


def reach(seeds: DataFrame, edges: DataFrame, max_depth: int = br.CRAWL_DEPTH, max_pages: int | None = None) -> DataFrame:
    return bounded_reach(seeds, edges, max_depth, max_pages)


def reach_hits(reached: DataFrame, titles: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Reached pages whose URL or title holds a keyword."""
    j = reached.join(titles, "url", "left")
    k = matching_words(F.lower(F.concat_ws(" ", "url", "title")), keywords)
    return j.withColumn("_k", k).where(F.size("_k") > 0).withColumn("keywords", F.array_join("_k", "|")).drop("_k")


def reach_graph(reached: DataFrame, edges: DataFrame) -> DataFrame:
    """Reached pages with the number of links they hold."""
    out_degree = edges.groupBy(F.col("src").alias("url")).agg(F.count(F.lit(1)).alias("links"))
    return reached.join(out_degree, "url", "left").withColumn("links", F.coalesce("links", F.lit(0)))


def keyword_counts(hits: DataFrame, column: str = "keywords", k: int = 10) -> DataFrame:
    words = hits.select(F.explode(F.split(column, r"\|")).alias("keyword")).where(F.length("keyword") > 0)
    return top_k(counted(words, ["keyword"]), [F.desc("total"), F.col("keyword")], k)


def fresh_responses(cache: DataFrame, as_of, hours: int = 24) -> DataFrame:
    return cache.where(F.col("cached_at") > F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS"))


def url_outcomes(checks: DataFrame) -> DataFrame:
    """One row: correct, redirected, 404 and other outcomes with percentages.

    Checks: url, url_final, status_final, ok.
    """
    same = F.col("url") == F.col("url_final")
    one = checks.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("ok") & same).alias("ok_same"),
        F.count_if(F.col("ok") & ~same).alias("ok_redirect"),
        F.count_if(F.col("status_final") == 404).alias("not_found"),
        F.count_if(~F.col("ok") & F.coalesce(F.col("status_final") != 404, F.lit(True))).alias("other_error"),
    )
    names = ("ok_same", "ok_redirect", "not_found", "other_error")
    return one.select("*", *[percent(F.col(n), F.col("total"), 1).alias(f"{n}_percent") for n in names])


def redirect_targets(checks: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent redirect targets as host and first path part."""
    moved = checks.where(F.col("ok") & (F.col("url") != F.col("url_final")))
    first = F.regexp_extract(F.regexp_replace(U.path(F.col("url_final")), r"^/+", ""), r"^([^/]*)", 1)
    target = F.concat(U.host(F.col("url_final")), F.lit("/"), first)
    return top_k(counted(moved.select(target.alias("target")), ["target"]), [F.desc("total"), F.col("target")], k)


def seed_report(seeds: DataFrame) -> DataFrame:
    return counted(seeds, ["category", "status"])


def seed_problems(seeds: DataFrame) -> DataFrame:
    """Seeds that break a structural rule, with the rule."""
    rule = (
        F.when(F.coalesce(F.length(F.trim("url")), F.lit(0)) == 0, F.lit("url_missing"))
        .when(~U.has_scheme(F.col("url")), F.lit("url_without_scheme"))
        .when(F.col("status").isNull(), F.lit("status_missing"))
        .when(F.col("category").isNull(), F.lit("category_missing"))
    )
    return seeds.withColumn("problem", rule).where(F.col("problem").isNotNull())


def newest_first(sitemap: DataFrame, k: int) -> DataFrame:
    return top_k(sitemap, [F.col("lastmod").desc_nulls_last(), F.col("loc")], k)
