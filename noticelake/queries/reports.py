"""Queries of reports and small rules: rates, lists, echoes, differences, and filters seen by no other query."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticelake.functions import arrays
from noticelake.functions.classify import vehicle_icon
from noticelake.functions.text import drop_suffix
from noticelake.operators import keyed, predicates
from noticelake.operators.joins import prefer, salted_join
from noticelake.operators.paging import natural_number
from noticelake.operators.ranks import with_rank
from noticelake.plans import discovery, links, lots, mapview, match, search, stats, unify
from noticelake.queries.base import AS_OF, NOTICES, notices, plain, table
from noticelake.queries.operations import _LINKS, _link_rows
from noticelake.queries.pages import _CANDIDATES, _candidates
from noticelake.sources.sinks import truncated

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = lambda spark, sf: plain(fn(spark, sf))
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn

    return add


# ---------------------------------------------------------------- reports
@query(
    """SELECT count(*) AS total, count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS AUTOMOBILE, count(*) FILTER (c_mktsegment = 'MACHINERY') AS MACHINERY, count(*) FILTER (c_mktsegment = 'BUILDING') AS BUILDING,
  count(*) FILTER (c_mktsegment IN ('AUTOMOBILE', 'MACHINERY')) AS movable, count(*) FILTER (c_mktsegment NOT IN ('AUTOMOBILE', 'MACHINERY', 'BUILDING')) AS unknown FROM customer"""
)
def category_totals(spark, sf):
    return stats.category_counts(table(spark, sf, "customer"), "c_mktsegment", ("AUTOMOBILE", "MACHINERY", "BUILDING"), {"movable": ("AUTOMOBILE", "MACHINERY")}, rest="unknown")


@query(
    """SELECT event_type AS scraper, count(*) AS runs, CAST(sum(floor(value)) AS BIGINT) AS found, CAST(sum(event_id % 7) AS BIGINT) AS new, count(*) FILTER (event_id % 13 = 0) AS errors,
  round(100.0 * count(*) FILTER (event_id % 13 > 1) / count(*), 2) AS success_percent, 'timeout ' || arg_max(event_id, (ts, event_id)) FILTER (event_id % 13 = 0) AS last_error FROM events GROUP BY 1"""
)
def scraper_summary(spark, sf):
    e, k = table(spark, sf, "events"), F.col("event_id") % 13
    rows = e.select(
        F.col("event_type").alias("scraper"), F.when(k == 0, "error").when(k == 1, "skipped").otherwise("success").alias("status"), F.floor("value").alias("found"), (F.col("event_id") % 7).alias("new"),
        F.when(k == 0, F.concat(F.lit("timeout "), "event_id")).alias("error"), F.struct("ts", "event_id").alias("finished_at"),
    )
    return stats.scraper_summary(rows)


@query(
    f"""WITH {NOTICES} SELECT strftime(event_at, '%Y-%m-%d') AS day, id, title, row_number() OVER (PARTITION BY CAST(event_at AS DATE) ORDER BY event_at, id) AS place FROM notices"""
)
def calendar_lists(spark, sf):
    return mapview.calendar_items(notices(spark, sf)).select("day", "id", "title", "place")


@query(
    """SELECT count(*) AS analysed, count(DISTINCT (o_custkey, o_orderpriority)) AS distinct_keys, count(*) - count(DISTINCT (o_custkey, o_orderpriority)) AS duplicates,
  count(DISTINCT (o_custkey, o_orderpriority)) FILTER (o_orderstatus <> 'P') AS dates_found, round(100.0 * (count(*) - count(DISTINCT (o_custkey, o_orderpriority))) / count(*), 2) AS dedup_rate,
  round(100.0 * count(DISTINCT (o_custkey, o_orderpriority)) FILTER (o_orderstatus <> 'P') / count(DISTINCT (o_custkey, o_orderpriority)), 2) AS date_rate FROM orders"""
)
def run_rates(spark, sf):
    o = table(spark, sf, "orders").withColumn("event_at", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return keyed.run_rates(o, ["o_custkey", "o_orderpriority"], "event_at")


@query("SELECT DISTINCT trim(t) AS tags FROM (SELECT unnest(string_split(p_type || ',' || p_brand || ', ,', ',')) AS t FROM part) WHERE trim(t) <> ''")
def tags_of_comma_texts(spark, sf):
    p = table(spark, sf, "part").select(F.concat_ws(",", "p_type", "p_brand", F.lit(" "), F.lit("")).alias("tags"))
    return search.distinct_values(p, "tags", ",")


@query(
    """WITH l AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line, CASE WHEN l_linenumber % 3 = 0 THEN 'A' || l_linenumber ELSE CAST(l_linenumber * 7 AS VARCHAR) END AS lot_no FROM lineitem)
SELECT l_orderkey, line, lot_no, row_number() OVER (ORDER BY try_cast(lot_no AS INTEGER) NULLS LAST, lot_no, l_orderkey, line, q) AS place FROM (SELECT l.*, 0 AS q FROM l)"""
)
def lots_in_natural_order(spark, sf):
    """Every lot's place by the number in its name, then as text; equal rows of the table share their places in any order."""
    number = F.col("l_linenumber")
    l = table(spark, sf, "lineitem").select("l_orderkey", number.cast("bigint").alias("line"), F.when(number % 3 == 0, F.concat(F.lit("A"), number)).otherwise((number * 7).cast("string")).alias("lot_no"))
    l = l.withColumn("_number", natural_number(F.col("lot_no")))
    return with_rank(l, F.col("_number").asc_nulls_last(), F.col("lot_no").asc(), F.col("l_orderkey").asc(), F.col("line").asc(), name="place").drop("_number")


_RETAG = "(SELECT p_partkey, [p_type, 'OLD'] AS old_tags, list_distinct([p_type, CASE WHEN p_size > 25 THEN 'BIG' ELSE p_brand END]) AS new_tags FROM part)"


@query(f"SELECT tag, count(*) AS total FROM (SELECT old_tags, unnest(new_tags) AS tag FROM {_RETAG}) WHERE NOT list_contains(old_tags, tag) GROUP BY 1")
def retag_added(spark, sf):
    from noticelake.plans import tagging

    p = table(spark, sf, "part").select(F.array("p_type", F.lit("OLD")).alias("old"), F.array_distinct(F.array("p_type", F.when(F.col("p_size") > 25, F.lit("BIG")).otherwise(F.col("p_brand")))).alias("tags"))
    return tagging.added_tags(p, "old", "tags")


@query(
    """SELECT c_custkey, coalesce(CASE WHEN c_nationkey % 4 > 0 THEN list_has_any([c_mktsegment, CASE WHEN c_nationkey % 2 = 0 THEN 'SUCATA' END], ['SUCATA', 'BUILDING']) END, false) AS met FROM customer"""
)
def tags_met(spark, sf):
    tags = F.when(F.col("c_nationkey") % 4 > 0, F.array("c_mktsegment", F.when(F.col("c_nationkey") % 2 == 0, "SUCATA")))
    return table(spark, sf, "customer").select("c_custkey", arrays.overlap(tags, F.array(F.lit("SUCATA"), F.lit(None), F.lit("BUILDING"))).alias("met"))


@query(
    f"""WITH {_LINKS} SELECT id, link, coalesce(link_origin, 'unknown') AS origin, CASE WHEN link_valid IS NULL THEN 'not_judged' WHEN NOT regexp_matches(link, '^(https?://|www\\.)') THEN 'no_address' ELSE 'rejected' END AS problem
FROM marked WHERE has AND NOT coalesce(link_valid, false)"""
)
def invalid_links(spark, sf):
    return links.invalid_links(_link_rows(spark, sf))


@query(
    f"""WITH {_LINKS}, r AS (SELECT *, CASE WHEN has AND link_origin IS NULL THEN 1 WHEN has AND link_origin = 'unknown' AND coalesce(audit_result, '') = 'found_link' THEN 2
    WHEN has AND link_origin = 'unknown' AND coalesce(audit_result, '') <> 'no_link' THEN 3 WHEN NOT has AND link_origin = 'unknown' THEN 4 ELSE 0 END AS rule,
    has AND link_valid IS NULL AS open, regexp_matches(link, '^(https?://|www\\.)') AS shaped FROM marked),
s AS (SELECT coalesce(link_origin, 'none') AS origin, coalesce(CAST(link_valid AS VARCHAR), 'none') AS valid, 0 AS side FROM r
  UNION ALL SELECT coalesce(CASE rule WHEN 1 THEN 'pncp_api' WHEN 2 THEN 'pdf_anexo' WHEN 3 THEN 'pncp_api' WHEN 4 THEN NULL ELSE link_origin END, 'none'), coalesce(CAST(CASE WHEN open THEN shaped ELSE link_valid END AS VARCHAR), 'none'), 1 FROM r)
SELECT origin, valid, count(*) FILTER (side = 0) AS rows_before, count(*) FILTER (side = 1) AS rows_after FROM s GROUP BY 1, 2"""
)
def backfill_counts(spark, sf):
    rows = _link_rows(spark, sf)
    return links.backfill_counts(rows, links.backfill_provenance(rows))


@query(
    f"""WITH {_LINKS} SELECT id AS notice_id, CASE WHEN id % 11 = 0 THEN 'skipped' WHEN id % 7 = 0 AND id % 3 > 0 THEN 'error' WHEN id % 3 > 0 AND coalesce(link_valid, false) THEN 'found' ELSE 'no_link' END AS audit_result FROM links"""
)
def audit_results(spark, sf):
    rows = _link_rows(spark, sf).select(F.col("id").alias("notice_id"), (F.col("id") % 11 == 0).alias("skip"), "link_valid")
    resolved = rows.where("notice_id % 3 > 0").select("notice_id", "link_valid", F.when(F.col("notice_id") % 7 == 0, "timeout").alias("error"))
    return links.audit_marks(rows.drop("link_valid"), resolved, "run-1", AS_OF).select("notice_id", "audit_result")


@query(
    """SELECT p_brand AS family, count(*) AS documents, CAST(sum(p_size) AS BIGINT) AS lots, CAST(round(CAST(sum(p_size) AS DECIMAL(18,2)) / count(*), 2) AS DOUBLE) AS mean_lots, count(*) FILTER (p_size < 10) AS failed FROM part GROUP BY 1"""
)
def document_families(spark, sf):
    return stats.by_family(table(spark, sf, "part").withColumnRenamed("p_brand", "family"), "family", "p_size", F.col("p_size") < 10)


# ---------------------------------------------------------------- small rules
@query(f"WITH {NOTICES} SELECT id FROM notices WHERE publication_status = 'published' AND event_at IS NOT NULL AND id % 5 > 0")
def publishable_notices(spark, sf):
    n = notices(spark, sf).withColumn("link", F.when(F.col("id") % 5 > 0, F.col("portal_link")))
    return n.where(predicates.publishable(F.col("publication_status"), F.col("event_at"), F.col("link"))).select("id")


@query(f"SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0 OR o_orderdate >= TIMESTAMP '{AS_OF}'")
def not_past(spark, sf):
    o = table(spark, sf, "orders").withColumn("at", F.when(F.col("o_orderkey") % 10 > 0, F.col("o_orderdate")))
    return o.where(predicates.not_past(F.col("at"), f"{AS_OF} 13:00:00")).select("o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 's' || o_orderkey WHEN o_orderkey % 3 = 1 THEN 'd' || o_orderkey ELSE 'b' || o_orderkey END AS link FROM orders")
def three_way_links(spark, sf):
    k, m = F.col("o_orderkey"), F.col("o_orderkey") % 3
    link = unify.three_way_link(F.when(m == 0, F.concat(F.lit("s"), k)).otherwise(F.lit(" ")), F.when(m == 1, F.concat(F.lit("d"), k)), F.concat(F.lit("b"), k))
    return table(spark, sf, "orders").select("o_orderkey", link.alias("link"))


@query("SELECT doc_id, substr(text, 1, 40) AS text, lang FROM documents")
def fitted_columns(spark, sf):
    return truncated(table(spark, sf, "documents").select("doc_id", "text", "lang"), {"text": 40, "other": 3})


@query(
    """SELECT p_partkey, trim(regexp_replace(p_name, '(?i)(?:\\s*(?:red|blue|metal))$', '')) AS name,
  CASE WHEN regexp_matches(strip_accents(lower(p_type)), 'moto|ciclo|scooter') THEN 'moto' WHEN regexp_matches(lower(p_type || p_name), 'caminhao|truck|carreta') THEN 'truck' WHEN regexp_matches(lower(p_type || p_name), 'carro|automovel|veiculo') THEN 'car'
    WHEN p_size > 40 THEN 'moto' WHEN p_size > 30 THEN 'truck' WHEN p_size > 20 THEN 'car' ELSE 'other' END AS icon FROM part"""
)
def names_and_icons(spark, sf):
    size = F.col("p_size")
    word = F.when(size > 40, "Motocicleta").when(size > 30, "CAMINHÃO").when(size > 20, "Automóvel").otherwise("")
    return table(spark, sf, "part").select(
        "p_partkey", drop_suffix(F.col("p_name"), r"\s*(?:red|blue|metal)").alias("name"), vehicle_icon(F.concat_ws(" ", "p_type", "p_name", word)).alias("icon")
    )


@query("SELECT count(*) AS files, count(DISTINCT sha256(text)) AS contents FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'en')")
def unread_files(spark, sf):
    d = table(spark, sf, "documents").withColumn("content_hash", F.sha2(F.col("text").cast("binary"), 256))
    todo = lots.skip_processed(d, d.where("lang = 'en'"))
    return todo.groupBy("content_hash").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("files"), F.count(F.lit(1)).alias("contents"))


@query(
    """SELECT e.event_id AS notification_id, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS created_at, c_name AS title, CASE WHEN e.event_id % 2 = 0 THEN 'f' || (e.event_id % 50) END AS filter_label
FROM events e JOIN customer ON c_custkey = e.user_id ORDER BY e.ts DESC, e.event_id LIMIT 10"""
)
def unread_with_labels(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("notification_id"), F.col("user_id").alias("notice_id"), (F.col("event_id") % 50).alias("filter_id"), F.col("ts").alias("created_at"))
    n = table(spark, sf, "customer").select(F.col("c_custkey").alias("notice_id"), F.col("c_name").alias("title"))
    f = table(spark, sf, "customer").where("c_custkey < 50 and c_custkey % 2 = 0").select(F.col("c_custkey").alias("filter_id"), F.concat(F.lit("f"), "c_custkey").alias("label"))
    return match.unread_list(e, n, f).select("notification_id", "created_at", "title", "filter_label")


@query("SELECT l_returnflag, n_name, count(*) AS lines FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2")
def salted_lines(spark, sf):
    """Lines of a few hot suppliers joined with every supplier's key spread over tasks."""
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "n_name")
    return salted_join(table(spark, sf, "lineitem"), s, ["l_suppkey"], "l_orderkey").groupBy("l_returnflag", "n_name").agg(F.count(F.lit(1)).alias("lines"))


@query(f"WITH {_CANDIDATES}, half AS (SELECT DISTINCT url FROM scored WHERE length(url) % 2 = 0) SELECT s.url, s.score::BIGINT AS score, h.url IS NOT NULL AS own FROM scored s LEFT JOIN half h ON h.url = s.url")
def hits_merged(spark, sf):
    """Pages of even length as candidates, all pages as hits of a crawl: a hit counts only where there is no candidate."""
    every = _candidates(spark, sf)
    own = every.where(F.length("url") % 2 == 0)
    scored = discovery.score_sources(own, every)
    marked = prefer(own.select("url").distinct().withColumn("own", F.lit(True)), every.select("url").distinct().withColumn("own", F.lit(False)), "url")
    return scored.select("url", "score").join(marked, "url").select("url", "score", "own")


@query("SELECT url, strftime(TIMESTAMP '2024-01-01' + to_hours(CAST(page_id AS BIGINT) % 72), '%Y-%m-%d %H:%M:%S') AS cached_at FROM pages WHERE page_id % 72 > 24")
def fresh_responses(spark, sf):
    p = table(spark, sf, "pages").select("url", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=(F.col("page_id") % 72).cast("int"))).alias("cached_at"))
    return discovery.fresh_responses(p, "2024-01-03", 24)


_SEEDS = """seeds AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN ' ' WHEN 1 THEN substr(url, strpos(url, '//') + 2) ELSE url END AS url, CASE WHEN page_id % 7 > 0 THEN 'confirmed' END AS status,
  CASE WHEN page_id % 3 > 0 THEN regexp_extract(url, '\\.([a-z]+)/', 1) END AS category FROM pages)"""


def _seeds(spark, sf):
    p, k = table(spark, sf, "pages"), F.col("page_id")
    url = F.when(k % 5 == 0, " ").when(k % 5 == 1, F.regexp_replace("url", "^[a-z]+://", "")).otherwise(F.col("url"))
    return p.select("page_id", url.alias("url"), F.when(k % 7 > 0, "confirmed").alias("status"), F.when(k % 3 > 0, F.regexp_extract("url", r"\.([a-z]+)/", 1)).alias("category"))


@query(f"WITH {_SEEDS} SELECT category, status, count(*) AS total FROM seeds GROUP BY 1, 2")
def seed_report(spark, sf):
    return discovery.seed_report(_seeds(spark, sf))


@query(
    f"""WITH {_SEEDS} SELECT * FROM (SELECT page_id, CASE WHEN trim(url) = '' THEN 'url_missing' WHEN page_id % 5 = 1 THEN 'url_without_scheme' WHEN status IS NULL THEN 'status_missing' WHEN category IS NULL THEN 'category_missing' END AS problem FROM seeds)
WHERE problem IS NOT NULL"""
)
def seed_problems(spark, sf):
    return discovery.seed_problems(_seeds(spark, sf)).select("page_id", "problem")
