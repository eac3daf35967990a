"""Queries of the serving layer: unify, search, facets, statistics, map and calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticelake.operators.predicates import SearchParams, active, keeps_category
from noticelake.plans import geo, lots, mapview, search, stats, unify
from noticelake.queries.base import AS_OF, NOTICES, PLACES, UNIFIED, notices, places, plain, second_source, table

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = lambda spark, sf: plain(fn(spark, sf))
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn

    return add


def _unified(spark, sf):
    return unify.unify(notices(spark, sf), second_source(spark, sf), places(spark, sf), AS_OF)


_OUT = ["id", "notice_id", "agency", "region", "city", "event_at", "title", "notice_link", "modality", "value", "source_type", "place_code", "temporal_status"]
_OUT_SQL = """id, notice_id, agency, region, city, strftime(event_at, '%Y-%m-%d %H:%M:%S') AS event_at, title, notice_link, modality,
  CAST(value AS DOUBLE) AS value, source_type, CAST(place_code AS BIGINT) AS place_code, temporal_status"""


@query(f"WITH {UNIFIED} SELECT {_OUT_SQL} FROM unified")
def unify_sources(spark, sf):
    return _unified(spark, sf).select(*_OUT)


@query(
    f"""WITH {UNIFIED} SELECT count(*) AS total, count(*) FILTER (WHERE source_type = 'portal') AS total_first,
  count(*) FILTER (WHERE source_type = 'auctioneer') AS total_second, count(DISTINCT region) AS regions, count(DISTINCT city) AS cities,
  CAST(coalesce(sum(value), 0) AS DOUBLE) AS value_total, count(*) FILTER (WHERE temporal_status = 'future') AS future_rows,
  count(*) FILTER (WHERE temporal_status = 'past') AS past_rows FROM unified"""
)
def unified_totals(spark, sf):
    return unify.totals(_unified(spark, sf))


_ECHO = '{"end_exclusive_time":false,"event_to":"2000-12-31","order":"nearest","region":"ASIA","temporality":"future","value_max":400000,"value_min":20000}'
_P1 = SearchParams(region="ASIA", value_min=20000, value_max=400000, event_to="2000-12-31", order="nearest", page=3, page_size=20)
_W1 = f"region = 'ASIA' AND value >= 20000 AND value <= 400000 AND event_at < TIMESTAMP '2001-01-01' AND temporal_status = 'future'"


@query(f"WITH {UNIFIED} SELECT {_OUT_SQL} FROM unified WHERE {_W1} ORDER BY unified.event_at, id LIMIT 20 OFFSET 40")
def search_page(spark, sf):
    return search.search(_unified(spark, sf), _P1).select(*_OUT)


@query(
    f"""WITH {UNIFIED} SELECT count(*) AS total, CAST(3 AS BIGINT) AS page, CAST(20 AS BIGINT) AS page_size, CAST(ceil(greatest(count(*), 1) / 20.0) AS BIGINT) AS total_pages,
  CAST(NULL AS VARCHAR) AS source_filter, '{_ECHO}' AS filters
FROM unified WHERE {_W1}"""
)
def search_envelope(spark, sf):
    return search.search_envelope(_unified(spark, sf), _P1)


@query(
    f"""WITH {UNIFIED} SELECT {_OUT_SQL} FROM unified WHERE source_type = 'portal'
  AND contains(upper(trim(city)), 'NATION_1') AND published_at >= TIMESTAMP '1996-01-01' AND published_at < TIMESTAMP '1999-01-01'
  ORDER BY value DESC, id LIMIT 50"""
)
def search_city_by_value(spark, sf):
    p = SearchParams(city=" nation_1", source="portal", published_from="1996-01-01", published_to="1998-12-31", temporality="all", order="value_desc", page_size=50)
    return search.search(_unified(spark, sf), p).select(*_OUT)


@query(
    f"""WITH {UNIFIED} SELECT {_OUT_SQL} FROM unified WHERE temporal_status = 'past' AND
  (contains(strip_accents(lower(title)), 'leilao') AND contains(strip_accents(lower(title)), 'leilao 2-high'))
  ORDER BY published_at DESC NULLS LAST, id LIMIT 30"""
)
def search_free_text(spark, sf):
    p = SearchParams(text="LEILÃO 2-High", temporality="past", order="newest", page_size=30)
    return search.search(_unified(spark, sf), p).select(*_OUT)


@query(
    f"""WITH {UNIFIED} SELECT {_OUT_SQL} FROM unified WHERE list_contains(tags, 'MACHINERY') AND event_at <= TIMESTAMP '2000-06-01'
  AND event_at >= TIMESTAMP '1999-01-01' AND temporal_status = 'future' ORDER BY unified.event_at DESC, id LIMIT 40"""
)
def search_tag_farthest(spark, sf):
    p = SearchParams(tag="MACHINERY", event_from="1999-01-01", event_to="2000-06-01", end_exclusive_time=True, order="farthest", page_size=40)
    return search.search(_unified(spark, sf), p).select(*_OUT)


@query(f"WITH {UNIFIED} SELECT 'u1' AS user_id, count(*) AS rows_returned FROM (SELECT * FROM unified WHERE temporal_status = 'future' LIMIT 100)")
def search_audit_log(spark, sf):
    return search.audited_search(_unified(spark, sf), SearchParams(), "u1", AS_OF, limit=500)[1].select("user_id", "rows_returned")


@query(f"WITH {UNIFIED} SELECT region, count(*) AS total FROM unified WHERE region IS NOT NULL AND temporal_status = 'future' GROUP BY 1")
def facet_regions(spark, sf):
    return search.region_facet(_unified(spark, sf))


@query(
    f"""WITH {UNIFIED} SELECT city, count(*) AS total FROM unified WHERE region = 'EUROPE' AND source_type = 'portal'
  AND temporal_status = 'future' GROUP BY 1"""
)
def facet_cities(spark, sf):
    return search.city_facet(_unified(spark, sf), "EUROPE", source="portal")


@query(f"WITH {UNIFIED} SELECT DISTINCT trim(t) AS tags FROM (SELECT unnest(tags) AS t FROM unified) WHERE length(trim(t)) > 0")
def distinct_tags(spark, sf):
    return search.distinct_values(_unified(spark, sf), "tags")


@query(
    f"""WITH {NOTICES} SELECT count(*) AS total, count(DISTINCT region) AS regions, count(DISTINCT city) AS cities,
  CAST(sum(value) AS DOUBLE) AS value_total,
  count(*) FILTER (WHERE event_at >= TIMESTAMP '{AS_OF}' AND event_at <= TIMESTAMP '{AS_OF}' + INTERVAL 7 DAY) AS next_7_days,
  count(*) FILTER (WHERE event_at >= TIMESTAMP '{AS_OF}') AS future_rows,
  count(*) FILTER (WHERE NOT coalesce(event_at >= TIMESTAMP '{AS_OF}', false)) AS past_rows FROM notices"""
)
def dashboard_stats(spark, sf):
    return stats.dashboard(notices(spark, sf), AS_OF)


@query(
    f"""WITH {NOTICES} SELECT region, count(*) AS total, count(*) FILTER (WHERE length(storage_path) > 0) AS with_file,
  CAST(sum(value) AS DOUBLE) AS value_total, round(CAST(sum(value) AS DOUBLE) / count(*), 2) AS value_mean,
  strftime(max(event_at), '%Y-%m-%d %H:%M:%S') AS latest FROM notices GROUP BY 1"""
)
def region_statistics(spark, sf):
    return stats.by_region(notices(spark, sf), "region", "value", {"file": F.length("storage_path") > 0}, "event_at")


@query(
    f"""WITH {NOTICES} SELECT modality, count(*) AS total, CAST(sum(value) AS DOUBLE) AS value_total,
  round(CAST(sum(value) AS DOUBLE) / count(*), 2) AS value_mean FROM notices GROUP BY 1"""
)
def modality_statistics(spark, sf):
    return stats.by_modality(notices(spark, sf), "modality", "value")


@query(
    """SELECT l_returnflag AS source, count(*) AS total, count(DISTINCT l_orderkey) AS notices,
  count(*) FILTER (WHERE l_linestatus = 'O') AS open_rows, count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
  min(l_extendedprice) AS value_min, max(l_extendedprice) AS value_max,
  round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS value_mean,
  strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS latest FROM lineitem GROUP BY 1"""
)
def source_statistics(spark, sf):
    l = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "source")
    return stats.by_source(l, "source", "l_orderkey", "l_extendedprice", "l_shipdate", {"open_rows": F.col("l_linestatus") == "O", "discounted": F.col("l_discount") > 0.05})


@query(
    f"""WITH {NOTICES}, days AS (SELECT *, CAST(event_at AS DATE) AS day FROM notices)
SELECT strftime(d.day, '%Y-%m-%d') AS day, d.total, CAST(d.v AS DOUBLE) AS value_total, round(100.0 * d.f / d.total, 2) AS file_percent, r.by_region, m.by_modality
FROM (SELECT day, count(*) AS total, sum(value) AS v, count(*) FILTER (WHERE length(storage_path) > 0) AS f FROM days GROUP BY 1) d
JOIN (SELECT day, string_agg(k || '=' || n, ',' ORDER BY k) AS by_region FROM (SELECT day, region AS k, count(*) AS n FROM days GROUP BY 1, 2) GROUP BY 1) r USING (day)
JOIN (SELECT day, string_agg(k || '=' || n, ',' ORDER BY k) AS by_modality FROM (SELECT day, modality AS k, count(*) AS n FROM days GROUP BY 1, 2) GROUP BY 1) m USING (day)"""
)
def daily_summary(spark, sf):
    d = stats.daily_summary(notices(spark, sf), F.to_date("event_at"), "region", "modality", "value", {"file": F.length("storage_path") > 0})

    def text(c):
        return F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")

    return d.withColumn("by_region", text("by_region")).withColumn("by_modality", text("by_modality"))


@query(
    f"""WITH {NOTICES} SELECT 'total' AS metric, CAST(count(*) AS DOUBLE) AS value FROM notices
  UNION ALL SELECT 'value', CAST(sum(value) AS DOUBLE) FROM notices UNION ALL SELECT 'cities', count(DISTINCT city) FROM notices"""
)
def metric_rows(spark, sf):
    n = notices(spark, sf)
    return stats.metric_rows([("total", n.agg(F.count(F.lit(1)))), ("value", n.agg(F.sum("value"))), ("cities", n.agg(F.count_distinct("city")))])


@query("SELECT l_orderkey, count(*) AS total FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def busiest_notices(spark, sf):
    return stats.busiest(table(spark, sf, "lineitem"), "l_orderkey")


@query(
    """SELECT count(*) AS total, count(*) FILTER (WHERE p_type = 'ECONOMY') AS "ECONOMY", count(*) FILTER (WHERE p_type = 'SMALL') AS "SMALL",
  count(*) FILTER (WHERE p_type = 'MEDIUM') AS "MEDIUM" FROM part"""
)
def category_counts(spark, sf):
    return stats.category_counts(table(spark, sf, "part"), "p_type", ("ECONOMY", "SMALL", "MEDIUM"))


# ---------------------------------------------------------------- lots of a notice
def _lots(spark, sf, *places):
    """Lines as lots. ``places``: columns of the file that a line is read from."""
    l, p = table(spark, sf, "lineitem").select("*", *places), table(spark, sf, "part")
    return l.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("notice_key"), F.col("l_linenumber").alias("line_no"), F.col("l_linenumber").cast("string").alias("lot_no"),
        F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).alias("value"), F.col("p_brand").alias("brand"), F.col("p_name").alias("model"),
        F.col("p_size").alias("model_year"), *[p_.rpartition(".")[2] for p_ in places],
    )


@query(
    """SELECT o_orderkey AS notice_key, o_orderstatus, count(l_orderkey) AS lots, count(CASE WHEN l_discount > 0.02 THEN 1 END) AS lots_with_value,
  CAST(sum(CASE WHEN l_discount > 0.02 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS value_total,
  count(DISTINCT p_brand) AS brands, array_to_string(list_sort(list(DISTINCT p_brand) FILTER (WHERE p_brand IS NOT NULL)), '|') AS brand_list
FROM orders LEFT JOIN (lineitem JOIN part ON l_partkey = p_partkey) ON l_orderkey = o_orderkey GROUP BY 1, 2"""
)
def lot_summary(spark, sf):
    n = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "notice_key")
    return lots.lot_summary(n, _lots(spark, sf), "notice_key", "value", "brand", ["notice_key", "o_orderstatus"])


@query(
    """WITH p AS (SELECT l_orderkey AS notice_key, string_agg(l_linenumber || ': ' || p_brand || ' ' || p_name || ' ' || p_size, ' | ' ORDER BY l_linenumber) AS t
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT notice_key, CASE WHEN length(t) > 100 THEN substr(t, 1, 97) || '...' ELSE t END AS preview FROM p"""
)
def lot_preview(spark, sf):
    """Lots of one number follow each other as they stand in the table."""
    label = lots.lot_label(F.col("lot_no"), F.col("brand"), F.col("model"), F.col("model_year"), F.lit(None).cast("string"))
    return lots.lot_preview(_lots(spark, sf, "_metadata.file_path", "_metadata.row_index"), "notice_key", "line_no", label, tie=["file_path", "row_index"])


@query(
    """SELECT l_orderkey AS notice_key, CAST(l_linenumber AS BIGINT) AS line_no, CAST(l_linenumber AS VARCHAR) AS lot_no, p_brand AS brand
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey = (SELECT max(o_orderkey) FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders))"""
)
def lots_of_notice(spark, sf):
    o = table(spark, sf, "orders")
    top = o.agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("k")).scalar()
    n = o.select(F.col("o_orderkey").alias("notice_key"), F.col("o_orderkey").alias("natural"))
    return lots.lots_of_notice(n, _lots(spark, sf), "natural", top, "notice_key").select("notice_key", "line_no", "lot_no", "brand")


@query(
    f"""SELECT o_orderkey AS notice_key FROM orders WHERE o_orderdate >= TIMESTAMP '{AS_OF}' AND o_orderstatus <> 'P'
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')"""
)
def future_notices_without_lots(spark, sf):
    n = table(spark, sf, "orders").select(F.col("o_orderkey").alias("notice_key"), F.col("o_orderdate").alias("event_at"), "o_orderstatus")
    l = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("notice_key"))
    return lots.notices_without_lots(n, l, AS_OF, has_file=F.col("o_orderstatus") != "P", key="notice_key").select("notice_key")


# ---------------------------------------------------------------- places
def _odd_places(spark, sf):
    """Dimension with accents and lower case, and without the places of one region."""
    p = places(spark, sf).where("place_region <> 'ASIA'")
    return p.withColumn("place_name", F.regexp_replace(F.initcap("place_name"), "a", "ã"))


@query(
    f"""WITH {NOTICES} SELECT count(*) AS total, count(*) FILTER (WHERE m) AS matched, round(100.0 * count(*) FILTER (WHERE m) / count(*), 2) AS matched_percent
FROM (SELECT EXISTS (SELECT 1 FROM places p WHERE p.place_region <> 'ASIA' AND upper(trim(n.city)) = upper(trim(place_name)) AND n.region = place_region) AS m FROM notices n)"""
)
def geocode_coverage(spark, sf):
    return geo.geocode_coverage(notices(spark, sf), _odd_places(spark, sf))


@query(
    f"""WITH {NOTICES} SELECT n.city, n.region, count(*) AS total FROM notices n LEFT JOIN places p
  ON upper(trim(n.city)) = upper(trim(p.place_name)) AND n.region = p.place_region AND p.place_region <> 'ASIA'
WHERE p.place_code IS NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20"""
)
def unmatched_places(spark, sf):
    return geo.unmatched_places(notices(spark, sf), _odd_places(spark, sf))


@query(
    f"""WITH {PLACES} SELECT CAST(place_code AS BIGINT) AS place_code, upper(substr(place_name, 1, 1)) || lower(substr(place_name, 2)) AS place_name, place_region,
  CAST(CASE WHEN place_region <> 'ASIA' THEN latitude ELSE 0 END AS DOUBLE) AS latitude, CAST(CASE WHEN place_region <> 'ASIA' THEN longitude ELSE 0 END AS DOUBLE) AS longitude FROM places"""
)
def place_dimension(spark, sf):
    p = places(spark, sf)
    return geo.build_dimension(p.select("place_code", "place_name", "place_region"), p.where("place_region <> 'ASIA'"), missing="zero")


@query(
    f"""WITH {NOTICES} SELECT region, count(*) AS total FROM (
  SELECT coalesce(p.place_region, n.bad) AS region FROM (SELECT *, CASE WHEN order_status = 'F' THEN 'XX' ELSE region END AS bad FROM notices) n
  LEFT JOIN places p ON upper(trim(n.city)) = p.place_name AND n.bad = 'XX') GROUP BY 1"""
)
def region_repair_from_places(spark, sf):
    n = notices(spark, sf).withColumn("region", F.when(F.col("order_status") == "F", F.lit("XX")).otherwise(F.col("region")))
    valid = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    return geo.region_counts(geo.region_from_dimension(n, places(spark, sf), valid))


# ---------------------------------------------------------------- map and calendar
@query(
    f"""WITH {UNIFIED} SELECT count(*) AS points, (min(latitude) + max(latitude)) / 2 AS latitude, (min(longitude) + max(longitude)) / 2 AS longitude,
  round(greatest(4, least(12, 8 - log2(greatest(max(latitude) - min(latitude), max(longitude) - min(longitude)) + 0.1))), 6) AS zoom
FROM unified WHERE latitude BETWEEN -15 AND 12 AND longitude BETWEEN -58 AND -40"""
)
def map_view(spark, sf):
    v = mapview.view(mapview.visible(_unified(spark, sf), (-15.0, -58.0, 12.0, -40.0)))
    return v.withColumn("zoom", F.round("zoom", 6))


@query(
    f"""WITH {UNIFIED} SELECT CAST(floor((longitude + 180) / 360 * 4096 / 60) AS BIGINT) AS cell_x,
  CAST(floor((0.5 - ln((1 + sin(radians(latitude))) / (1 - sin(radians(latitude)))) / (4 * pi())) * 4096 / 60) AS BIGINT) AS cell_y,
  count(*) AS points, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude,
  CASE WHEN bool_or(coalesce(list_contains(tags, 'SUCATA'), false)) THEN 'sucata' WHEN bool_or(coalesce(list_contains(tags, 'DOCUMENTADO'), false)) THEN 'documentado' ELSE 'outro' END AS colour_class
FROM unified WHERE latitude IS NOT NULL GROUP BY 1, 2"""
)
def map_clusters(spark, sf):
    c = mapview.clusters(_unified(spark, sf), zoom=4)
    return c.withColumn("latitude", F.round("latitude", 6)).withColumn("longitude", F.round("longitude", 6))


@query(
    f"""WITH {NOTICES} SELECT strftime(event_at, '%Y-%m-%d') AS day, count(*) AS total, bool_or(list_contains(tags, 'SUCATA')) AS has_scrap,
  bool_or(list_contains(tags, 'DOCUMENTADO')) AS has_documented FROM notices WHERE event_at IS NOT NULL GROUP BY 1"""
)
def calendar(spark, sf):
    return mapview.calendar(notices(spark, sf))


@query(f"WITH {NOTICES} SELECT strftime(min(event_at), '%Y-%m-%d') AS day FROM notices WHERE event_at >= TIMESTAMP '{AS_OF}'")
def calendar_default_day(spark, sf):
    return mapview.default_day(mapview.calendar(notices(spark, sf)), AS_OF)


@query(f"WITH {NOTICES} SELECT CASE WHEN order_status = 'F' THEN 'sucata' ELSE 'documentado' END AS tag_class, count(*) AS total FROM notices GROUP BY 1")
def tag_classes(spark, sf):
    return mapview.with_tag_class(notices(spark, sf)).groupBy("tag_class").agg(F.count(F.lit(1)).alias("total"))


@query(f"WITH {NOTICES} SELECT id, region FROM notices WHERE NOT (list_contains(tags, 'BUILDING') AND NOT list_contains(tags, 'SUCATA'))")
def category_exclusion(spark, sf):
    return notices(spark, sf).where(keeps_category(F.col("tags"), "BUILDING", ("SUCATA", "MOTO"))).select("id", "region")


@query(f"WITH {NOTICES} SELECT id, title, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM notices ORDER BY notices.published_at DESC, id LIMIT 100")
def newest_publications(spark, sf):
    n = notices(spark, sf)
    return search.notice_summary(n, 100)


@query(f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem WHERE l_linestatus IN ('O', 'ABERTO') AND l_shipdate > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY")
def active_listings(spark, sf):
    l = table(spark, sf, "lineitem")
    return l.where(active(F.col("l_linestatus"), F.col("l_shipdate"), ("O", "ABERTO"), AS_OF)).select("l_orderkey", "l_linenumber")


@query(f"WITH {UNIFIED} SELECT region, temporal_status, count(*) AS total FROM unified GROUP BY 1, 2")
def temporal_counts_by_region(spark, sf):
    return stats.temporal_counts(_unified(spark, sf))


__all__ = ["ORACLE", "QUERIES"]
