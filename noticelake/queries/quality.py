"""Queries of the contract, quarantine, scoring, tagging and keyed-table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticelake.operators import keyed, shares
from noticelake.operators.paging import top_k_per
from noticelake.plans import contract, coverage, keys, quality, scoring, tagging
from noticelake.plans.feed import rejection_codes
from noticelake.presets import br_notices as br
from noticelake.queries.base import AS_OF, NOTICES, RECORDS, notices, plain, records, table
from noticelake.sources.sinks import status_updates

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = lambda spark, sf: plain(fn(spark, sf))
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn

    return add


def _validated(spark, sf):
    return contract.validate(records(spark, sf))


def _quarantine(spark, sf):
    return contract.route(_validated(spark, sf), "id_interno", "run_id", ["id_interno", "pncp_url", "data_leilao"])[1]


# ---------------------------------------------------------------- contract
@query(
    f"""WITH {RECORDS} SELECT id_interno, status, coalesce((SELECT string_agg(code || ':' || field, '|' ORDER BY pos) FROM errors e WHERE e.id_interno = v.id_interno), '') AS errors,
  CASE WHEN www_url THEN 'https://' || pncp_url ELSE pncp_url END AS pncp_url,
  CASE WHEN tags_empty THEN '' WHEN tags_changed THEN 'BUILDING' ELSE tags END AS tags FROM validated v"""
)
def validate_contract(spark, sf):
    v = _validated(spark, sf)
    codes = F.array_join(F.transform("errors", lambda e: F.concat_ws(":", e["code"], e["field"])), "|")
    return v.select("id_interno", "status", codes.alias("errors"), F.col("normalized.pncp_url").alias("pncp_url"), F.col("normalized.tags").alias("tags"))


@query(f"WITH {RECORDS} SELECT id_interno, run_id FROM validated WHERE status = 'valid'")
def route_main(spark, sf):
    return contract.route(_validated(spark, sf), "id_interno", "run_id", ["id_interno"])[0].select("id_interno", "run_id")


@query(f"WITH {RECORDS} SELECT run_id, id_interno AS record_id, status, reason_code FROM reasons")
def route_quarantine(spark, sf):
    return _quarantine(spark, sf).select("run_id", "record_id", "status", "reason_code")


@query(f"WITH {RECORDS} SELECT run_id, id_interno AS record_id, CASE WHEN run_id >= '200001' THEN reason_code ELSE 'old' END AS reason_code FROM reasons")
def quarantine_upsert(spark, sf):
    q = _quarantine(spark, sf).select("run_id", "record_id", "reason_code")
    stored = q.withColumn("reason_code", F.lit("old"))
    return contract.merge_quarantine(stored, q.where("run_id >= '200001'"))


@query(f"WITH {RECORDS} SELECT count(*) FILTER (WHERE a.id_interno IN (SELECT id_interno FROM reasons)) AS keys_in_both FROM validated a WHERE status = 'valid'")
def quarantine_overlap(spark, sf):
    return contract.keys_routed_to_both(_validated(spark, sf), "id_interno")


@query(
    f"""WITH {RECORDS} SELECT run_id, count(*) AS total, count(*) FILTER (WHERE status = 'valid') AS valid_count, count(*) FILTER (WHERE status = 'draft') AS draft_count,
  count(*) FILTER (WHERE status = 'not_sellable') AS not_sellable_count, count(*) FILTER (WHERE status = 'rejected') AS rejected_count,
  count(*) FILTER (WHERE status <> 'valid') AS quarantine_count, round(100.0 * count(*) FILTER (WHERE status = 'valid') / count(*), 2) AS valid_percent,
  round(100.0 * count(*) FILTER (WHERE status <> 'valid') / count(*), 2) AS quarantine_percent FROM validated GROUP BY 1"""
)
def quality_report(spark, sf):
    return quality.report(_validated(spark, sf))


@query(
    f"""WITH {RECORDS}, c AS (SELECT run_id, code, count(*) AS total FROM errors GROUP BY 1, 2)
SELECT run_id, rank, code, total, percent FROM (SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY total DESC, code) AS rank, code, total,
  round(100.0 * total / sum(total) OVER (PARTITION BY run_id), 2) AS percent FROM c) WHERE rank <= 10"""
)
def quality_top_errors(spark, sf):
    return quality.top_errors(_validated(spark, sf))


@query(f"WITH {RECORDS} SELECT code, field, count(*) AS total FROM errors GROUP BY 1, 2")
def error_occurrences(spark, sf):
    return quality.error_counts(_validated(spark, sf), ["code", "field"])


@query(
    f"""WITH {RECORDS}, c AS (SELECT reason_code, count(*) AS total FROM reasons GROUP BY 1)
SELECT reason_code, total, round(100.0 * total / sum(total) OVER (), 2) AS percent FROM c ORDER BY total DESC, reason_code LIMIT 20"""
)
def top_reason_codes(spark, sf):
    return quality.top_reasons(_quarantine(spark, sf), 20)


@query(f"WITH {RECORDS} SELECT run_id, status, count(*) AS total FROM reasons GROUP BY 1, 2")
def quarantine_by_run(spark, sf):
    return quality.quarantine_by_run(_quarantine(spark, sf))


@query(
    f"""WITH {RECORDS} SELECT reason_code, count(*) AS total, count(*) FILTER (WHERE status = 'draft') AS draft, count(*) FILTER (WHERE status = 'rejected') AS rejected,
  min(run_id) AS first_seen, max(run_id) AS last_seen FROM reasons GROUP BY 1"""
)
def quarantine_summary(spark, sf):
    return quality.quarantine_summary(_quarantine(spark, sf), "reason_code", "status", "run_id", ("draft", "rejected"))


@query(
    """SELECT code, total, CASE code WHEN 'TIPO_3' THEN 'error' WHEN 'CATEGORY_EXCLUDED' THEN 'info' WHEN 'API_ERROR' THEN 'error' END AS severity
FROM (SELECT CASE event_type WHEN 'error' THEN 'API_ERROR' WHEN 'click' THEN 'TIPO_3' WHEN 'view' THEN 'CATEGORY_EXCLUDED' ELSE 'OTHER' END AS code, count(*) AS total FROM events GROUP BY 1)"""
)
def rejections_described(spark, sf):
    code = F.when(F.col("event_type") == "error", "API_ERROR").when(F.col("event_type") == "click", "TIPO_3").when(F.col("event_type") == "view", "CATEGORY_EXCLUDED").otherwise("OTHER")
    counts = shares.counted(table(spark, sf, "events").select(code.alias("code")), ["code"])
    return quality.describe_codes(counts, rejection_codes(spark)).select("code", "total", "severity")


@query(
    """SELECT count(*) AS rows_missing, count(quality) AS has_quality, count(*) FILTER (WHERE toxic = 1) AS hit_toxic FROM
  (SELECT d.doc_id, l.quality, l.toxic, CASE WHEN d.lang = 'en' THEN d.source END AS origin FROM documents d LEFT JOIN labels l USING (doc_id)) WHERE origin IS NULL"""
)
def missing_field_profile(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").withColumn("origin", F.when(F.col("lang") == "en", F.col("source")))
    return quality.missing_field_profile(d, "origin", ["quality"], {"toxic": F.col("toxic") == 1})


# ---------------------------------------------------------------- profiles
@query(
    f"""WITH {RECORDS} SELECT column_name, filled, total, round(100.0 * filled / total, 1) AS fill_percent FROM (
  SELECT 'data_leilao' AS column_name, count(data_leilao) AS filled, count(*) AS total FROM records
  UNION ALL SELECT 'objeto_resumido', count(*) FILTER (WHERE trim(objeto_resumido) <> ''), count(*) FROM records
  UNION ALL SELECT 'valor_estimado', count(valor_estimado), count(*) FROM records
  UNION ALL SELECT 'tags', count(*) FILTER (WHERE tags <> 'FURNITURE'), count(*) FROM records)"""
)
def fill_rates(spark, sf):
    return shares.fill_rates(records(spark, sf), ["data_leilao", "objeto_resumido", "valor_estimado", "tags"], ("N/D", "FURNITURE"))


@query(
    f"""WITH {RECORDS} SELECT round((round(100.0 * count(data_leilao) / count(*), 1) + round(100.0 * count(valor_estimado) / count(*), 1)) / 2, 1) AS mean_fill_percent FROM records"""
)
def mean_fill_rate(spark, sf):
    return shares.mean_fill_rate(shares.fill_rates(records(spark, sf), ["data_leilao", "valor_estimado"]))


@query(
    f"""WITH {NOTICES}, one AS (SELECT count(l) AS checked, count(*) FILTER (WHERE regexp_matches(l, '/\\d{{3,}}$')) AS compliant FROM (SELECT CASE WHEN order_status <> 'P' THEN portal_link END AS l FROM notices))
SELECT checked, compliant, round(100.0 * compliant / checked, 2) AS compliance_percent,
  CASE WHEN 100.0 * compliant / checked >= 100 THEN 'ok' WHEN 100.0 * compliant / checked >= 90 THEN 'warning' ELSE 'failed' END AS grade FROM one"""
)
def format_compliance(spark, sf):
    n = notices(spark, sf).withColumn("l", F.when(F.col("order_status") != "P", F.col("portal_link")))
    return shares.compliance(n, "l", r"/\d{3,}$")


@query(
    """WITH c AS (SELECT coalesce(CAST(quality AS VARCHAR), 'NULL') AS quality, count(*) AS total FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1)
SELECT quality, total, round(100.0 * total / sum(total) OVER (), 2) AS percent FROM c"""
)
def distribution(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return shares.distribution(d, "quality")


@query(
    f"""WITH {NOTICES} SELECT name, filled, (SELECT count(*) FROM notices) AS total, round(100.0 * filled / (SELECT count(*) FROM notices), 2) AS percent FROM (
  SELECT 'storage' AS name, count(*) FILTER (WHERE length(storage_path) > 0) AS filled FROM notices UNION ALL SELECT 'high_value', count(*) FILTER (WHERE value > 250000) FROM notices)"""
)
def file_coverage(spark, sf):
    return coverage.file_coverage(notices(spark, sf), {"storage": F.length("storage_path") > 0, "high_value": F.col("value") > 250000})


@query("SELECT count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes, count(DISTINCT source) AS notices FROM documents")
def storage_statistics(spark, sf):
    d = table(spark, sf, "documents").select(F.col("source").alias("notice_id"), F.col("n_chars").alias("bytes"))
    return coverage.storage_statistics(d)


# ---------------------------------------------------------------- scoring and tags
_WEIGHTS = {"the": 20, "que": 12, "der": 10, "que la": -30, "and the": -25, "por": 8, "www": 15, "@": -50, "nicht": 18, "license": -40}
_WEIGHTS_SQL = " + ".join(f"CASE WHEN contains(lower(text), '{t}') THEN {w} ELSE 0 END" for t, w in _WEIGHTS.items())


@query(f"SELECT doc_id, CAST(least(greatest(50 + {_WEIGHTS_SQL}, 0), 100) AS BIGINT) AS score FROM documents")
def score_relevance(spark, sf):
    return scoring.score_relevance(table(spark, sf, "documents"), ["text"], _WEIGHTS).select("doc_id", "score")


@query(f"SELECT lang, count(*) AS total FROM documents WHERE least(greatest(50 + {_WEIGHTS_SQL}, 0), 100) >= 60 GROUP BY 1")
def relevant_by_language(spark, sf):
    return shares.counted(scoring.relevant(scoring.score_relevance(table(spark, sf, "documents"), ["text"], _WEIGHTS)), ["lang"])


_PRESET_SQL = " + ".join(f"CASE WHEN contains(t, '{w}') THEN {p} ELSE 0 END" for w, p in br.RELEVANCE_WEIGHTS.items())


@query(f"SELECT id, CAST(least(greatest(50 + {_PRESET_SQL}, 0), 100) AS BIGINT) AS score FROM (WITH {NOTICES} SELECT id, lower(title || ' ' || description) AS t FROM notices)")
def score_notices(spark, sf):
    return scoring.score_relevance(notices(spark, sf), ["title", "description"]).select("id", "score")


_TERMS = [
    ("metal", "bolt", ["gear", "nut"], "METAL", True), ("metal", "ring", ["rîng"], "RING", True), ("colour", "red", ["rot"], "COLOUR", True),
    ("colour", "blüe", [], "COLOUR", True), ("size", "small", None, "SIZE", True), ("size", "hot", [], "HIDDEN", False), ("thing", "widget", ["gizmo"], "THING", True),
]
_TERM_SCHEMA = "category string, term string, synonyms array<string>, tag string, active boolean"
_TAGS_SQL = """array_to_string(list_sort(list_filter([
  CASE WHEN contains(t, 'bolt') OR contains(t, 'gear') OR contains(t, 'nut') THEN 'METAL' END, CASE WHEN contains(t, 'ring') THEN 'RING' END,
  CASE WHEN contains(t, 'red') OR contains(t, 'rot') OR contains(t, 'blue') THEN 'COLOUR' END, CASE WHEN contains(t, 'small') THEN 'SIZE' END,
  CASE WHEN contains(t, 'widget') OR contains(t, 'gizmo') THEN 'THING' END], lambda x: x IS NOT NULL)), '|')"""


def _tagged_parts(spark, sf):
    terms = spark.createDataFrame(_TERMS, _TERM_SCHEMA)
    return tagging.tag_by_taxonomy(table(spark, sf, "part"), terms, ["p_name", "p_type"], "p_partkey")


@query(f"SELECT p_partkey, {_TAGS_SQL} AS tags FROM (SELECT p_partkey, lower(p_name || ' ' || p_type) AS t FROM part)")
def tag_by_taxonomy(spark, sf):
    return _tagged_parts(spark, sf).select("p_partkey", "tags")


@query(
    f"""WITH t AS (SELECT string_split({_TAGS_SQL}, '|') AS new_tags, ['METAL', p_size_tag] AS old_tags FROM
  (SELECT lower(p_name || ' ' || p_type) AS t, CASE WHEN p_size > 25 THEN 'BIG' ELSE 'SIZE' END AS p_size_tag FROM part))
SELECT count(*) AS total, count(*) FILTER (WHERE c) AS changed, count(*) FILTER (WHERE NOT c) AS unchanged FROM
  (SELECT list_sort(list_filter(new_tags, lambda x: x <> '')) <> list_sort(old_tags) AS c FROM t)"""
)
def retag_changes(spark, sf):
    t = _tagged_parts(spark, sf).withColumn("old", F.array(F.lit("METAL"), F.when(F.col("p_size") > 25, F.lit("BIG")).otherwise(F.lit("SIZE"))))
    return tagging.tag_changes(t, "old", "tags")


@query(
    f"""WITH t AS (SELECT string_split({_TAGS_SQL}, '|') AS new_tags, unnest(['METAL', p_size_tag]) AS tag FROM
  (SELECT lower(p_name || ' ' || p_type) AS t, CASE WHEN p_size > 25 THEN 'BIG' ELSE 'SIZE' END AS p_size_tag FROM part))
SELECT tag, count(*) AS total FROM t WHERE NOT list_contains(new_tags, tag) GROUP BY 1"""
)
def retag_removed(spark, sf):
    t = _tagged_parts(spark, sf).withColumn("old", F.array(F.lit("METAL"), F.when(F.col("p_size") > 25, F.lit("BIG")).otherwise(F.lit("SIZE"))))
    return tagging.removed_tags(t, "old", "tags")


@query("SELECT p_type AS category, count(*) AS total FROM part GROUP BY 1")
def terms_per_category(spark, sf):
    return tagging.terms_per_category(table(spark, sf, "part").withColumnRenamed("p_type", "category"))


# ---------------------------------------------------------------- keyed tables
@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, row_number() OVER (PARTITION BY l_orderkey ORDER BY lineitem.l_shipdate DESC, lineitem.l_linenumber DESC) AS rn FROM lineitem) WHERE rn = 1")
def keep_latest(spark, sf):
    return keyed.keep_latest(table(spark, sf, "lineitem"), ["l_orderkey"], "l_shipdate", "l_linenumber").select("l_orderkey", "l_linenumber", "l_shipdate")


@query("SELECT md5(text) AS content, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def first_of_equal_texts(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("content"))
    return keyed.keep_first(d, ["content"], [F.col("doc_id")]).select("content", "doc_id")


@query("SELECT count(*) AS analysed, count(DISTINCT md5(text)) AS distinct_keys, count(*) - count(DISTINCT md5(text)) AS duplicates, round(100.0 * (count(*) - count(DISTINCT md5(text))) / count(*), 2) AS dedup_rate FROM documents")
def duplicate_rate(spark, sf):
    return keyed.duplicate_counts(table(spark, sf, "documents").select(F.md5("text").alias("content")), ["content"])


def _stored_and_batch(spark, sf):
    """Stored orders, and a batch that changes open ones, empties some values and brings new keys."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(15,2)").alias("price"), F.col("o_orderdate").alias("created_at"), "o_orderpriority")
    stored = o.where("o_orderstatus <> 'P'")
    batch = o.where("o_orderstatus <> 'F'").select(
        "o_orderkey", F.lit("NEW").alias("o_orderstatus"), F.when(F.col("price") > 250000, F.col("price") + 1).alias("price"),
        (F.col("created_at") + F.expr("INTERVAL 1 DAY")).alias("created_at"), F.lit(None).cast("string").alias("o_orderpriority"),
    )
    return stored, batch


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'NEW' END AS o_orderstatus,
  CASE WHEN o_orderstatus <> 'F' AND o_totalprice > 250000 THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) + 1 AS DOUBLE) WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price,
  strftime(CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS created_at,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority FROM orders"""
)
def upsert_non_null(spark, sf):
    stored, batch = _stored_and_batch(spark, sf)
    return keyed.upsert_non_null(stored, batch, ["o_orderkey"], keep=["created_at"])


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'NEW' END AS o_orderstatus,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice WHEN o_totalprice > 250000 THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) + 1 AS DOUBLE) END AS price,
  strftime(CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS created_at,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority FROM orders"""
)
def upsert_replace(spark, sf):
    stored, batch = _stored_and_batch(spark, sf)
    return keyed.upsert_replace(stored, batch, ["o_orderkey"], keep=["created_at"])


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def insert_if_absent(spark, sf):
    stored, batch = _stored_and_batch(spark, sf)
    return keyed.insert_if_absent(stored, batch, ["o_orderkey"], [F.col("price")]).select("o_orderkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey)")
def skip_known_keys(spark, sf):
    known = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return keyed.new_rows(table(spark, sf, "orders"), known, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, o_orderstatus FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey AND l_returnflag = 'A')")
def notices_with_lots(spark, sf):
    known = table(spark, sf, "lineitem").where("l_returnflag = 'A'").withColumnRenamed("l_orderkey", "o_orderkey")
    return keyed.known_rows(table(spark, sf, "orders"), known, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def ids_in_both(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).intersect(table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def not_in_list(spark, sf):
    return keyed.not_in(table(spark, sf, "customer"), "c_custkey", table(spark, sf, "orders").where("o_totalprice > 450000"), "o_custkey").select("c_custkey")


def _id_tables(spark, sf):
    o = table(spark, sf, "orders").select(F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("ID_"), F.col("o_orderkey"))).otherwise(F.concat(F.lit("UF_"), F.col("o_orderkey"))).alias("nid"), "o_orderstatus")
    l = table(spark, sf, "lineitem").select(F.concat(F.lit("UF_"), F.col("l_orderkey")).alias("nid"), "l_linenumber")
    needs = ~F.col("old_id").startswith("ID_")
    return o, l, keys.id_mapping([o, l], "nid", keys.stable_new_id(), needs)


@query(
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'ID_' || o_orderkey ELSE 'ID_' || upper(substr(sha256('UF_' || o_orderkey), 1, 12)) END AS nid, o_orderstatus FROM orders"""
)
def migrate_keys(spark, sf):
    o, _, mapping = _id_tables(spark, sf)
    return keys.migrate({"orders": o}, "nid", mapping)["orders"]


@query("SELECT count(*) AS rows_before, count(*) AS rows_after, count(DISTINCT l_orderkey) AS ids_before, count(DISTINCT l_orderkey) AS ids_after, CAST(0 AS BIGINT) AS open FROM lineitem")
def migrate_keys_check(spark, sf):
    _, l, mapping = _id_tables(spark, sf)
    return keys.check(l, keys.migrate({"l": l}, "nid", mapping)["l"], "nid", ~F.col("nid").startswith("ID_"))


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS state FROM events GROUP BY 1")
def current_state(spark, sf):
    t = table(spark, sf, "events")
    return keyed.current_state(t, "user_id", "ts", "event_id").select("user_id", F.col("event_type").alias("state"))


@query(
    f"""WITH {RECORDS} SELECT o_orderkey, CASE WHEN r.id_interno IS NOT NULL THEN 'rejected' ELSE 'pending' END AS status, r.reason_code AS rejection_reason,
  CASE WHEN r.id_interno IS NOT NULL THEN '{AS_OF} 00:00:00' END AS processed_at FROM orders o LEFT JOIN reasons r ON r.id_interno = CAST(o_orderkey AS VARCHAR)"""
)
def status_write_back(spark, sf):
    raw = table(spark, sf, "orders").select("o_orderkey", F.lit("pending").alias("status"), F.lit(None).cast("timestamp").alias("processed_at"), F.lit(None).cast("string").alias("rejection_reason"))
    outcome = _quarantine(spark, sf).select(F.col("record_id").cast("bigint").alias("o_orderkey"), F.lit("rejected").alias("status"), F.col("reason_code").alias("reason"))
    return status_updates(raw, outcome, "o_orderkey", AS_OF)


@query("SELECT o_custkey, CAST(rank AS BIGINT) AS rank, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def top_notices_per_agency(spark, sf):
    return top_k_per(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "rank", "o_orderkey")


@query("SELECT user_id, CAST(props->>'k' AS BIGINT) AS k, count(*) AS total FROM events WHERE CAST(props->>'k' AS BIGINT) >= 90 GROUP BY 1, 2")
def json_field_access(spark, sf):
    from noticelake.functions.arrays import json_text

    e = table(spark, sf, "events").withColumn("k", json_text(F.col("props"), "k").try_cast("bigint"))
    return shares.counted(e.where("k >= 90"), ["user_id", "k"])
