"""The given tables read as notices, lots, places, runs and contract records.

Every frame here is derived by Spark from the whole of a given table. The SQL strings say the same
for the comparison engine and are put in front of a query as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.functions.money import percent

AS_OF = "1998-08-01"
EVENTS_AS_OF = "2024-01-31"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and times as text, arrays as joined text: comparable everywhere."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|", "NULL")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- places
def places(spark: SparkSession, sf: str) -> DataFrame:
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("int").alias("place_code"),
        F.col("n_name").alias("place_name"),
        F.col("r_name").alias("place_region"),
        (F.col("n_nationkey") * F.lit(1.5) - 20).cast("decimal(10,6)").alias("latitude"),
        (F.col("n_nationkey").cast("double") - 60).cast("decimal(10,6)").alias("longitude"),
    )


PLACES = """places AS (
  SELECT n_nationkey AS place_code, n_name AS place_name, r_name AS place_region,
         n_nationkey * 1.5 - 20 AS latitude, n_nationkey - 60.0 AS longitude
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


# ---------------------------------------------------------------- notices (orders)
def notices(spark: SparkSession, sf: str) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    p = places(spark, sf).select("place_code", "place_name", "place_region")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(p, F.col("c_nationkey") == F.col("place_code"))
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("N"), F.col("o_orderkey")).alias("notice_id"),
        F.concat(F.lit("P"), F.col("o_orderkey")).alias("portal_id"),
        F.col("c_name").alias("agency"),
        F.col("place_region").alias("region"),
        F.when(urgent, F.concat(F.lit(" "), F.lower("place_name"), F.lit(" "))).otherwise(F.col("place_name")).alias("city"),
        (F.col("o_orderdate") - F.expr("INTERVAL 45 DAYS")).alias("published_at"),
        F.col("o_orderdate").alias("event_at"),
        F.concat_ws(" ", F.lit("Leilão"), "o_orderpriority", "c_mktsegment").alias("title"),
        F.concat_ws(" ", F.lit("Bens do setor"), "c_mktsegment").alias("description"),
        F.array(F.col("c_mktsegment"), F.when(F.col("o_orderstatus") == "F", F.lit("SUCATA")).otherwise(F.lit("DOCUMENTADO"))).alias("tags"),
        F.concat(F.lit("https://portal.example.org/"), F.col("o_orderkey")).alias("portal_link"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("store/"), F.col("o_orderkey"))).otherwise(F.lit("")).alias("storage_path"),
        F.lit(None).cast("string").alias("auctioneer_link"),
        F.col("o_orderpriority").alias("modality"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("value"),
        F.when(F.col("o_orderstatus") == "P", F.lit("draft")).otherwise(F.lit("published")).alias("publication_status"),
        F.lit(None).cast("string").alias("source_type"),
        F.col("o_orderstatus").alias("order_status"),
    )


NOTICES = PLACES + """, notices AS (
  SELECT o_orderkey AS id, 'N' || o_orderkey AS notice_id, 'P' || o_orderkey AS portal_id, c_name AS agency,
         place_region AS region,
         CASE WHEN o_orderpriority = '1-URGENT' THEN ' ' || lower(place_name) || ' ' ELSE place_name END AS city,
         o_orderdate - INTERVAL 45 DAY AS published_at, o_orderdate AS event_at,
         'Leilão ' || o_orderpriority || ' ' || c_mktsegment AS title, 'Bens do setor ' || c_mktsegment AS description,
         [c_mktsegment, CASE WHEN o_orderstatus = 'F' THEN 'SUCATA' ELSE 'DOCUMENTADO' END] AS tags,
         'https://portal.example.org/' || o_orderkey AS portal_link,
         CASE WHEN o_orderstatus = 'F' THEN 'store/' || o_orderkey ELSE '' END AS storage_path,
         o_orderpriority AS modality, CAST(o_totalprice AS DECIMAL(15,2)) AS value,
         CASE WHEN o_orderstatus = 'P' THEN 'draft' ELSE 'published' END AS publication_status,
         o_orderstatus AS order_status
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = place_code)"""


# ---------------------------------------------------------------- lots of a second source (lineitem)
def second_source(spark: SparkSession, sf: str) -> DataFrame:
    l, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    p = places(spark, sf).select("place_code", "place_name", "place_region")
    j = l.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("s_nationkey") == F.col("place_code"))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("L"), F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("notice_id"),
        F.col("s_name").alias("agency"),
        F.col("place_region").alias("region"),
        F.col("place_name").alias("city"),
        F.col("l_shipdate").alias("event_at"),
        F.concat_ws(" ", F.lit("Lote"), F.col("l_linenumber")).alias("title"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("value"),
        F.when(F.col("l_linestatus") == "O", F.lit("published")).otherwise(F.lit("draft")).alias("publication_status"),
        F.lit("auctioneer").alias("source_type"),
        F.col("l_returnflag").alias("modality"),
    )


SECOND_SOURCE = """second_source AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, 'L' || (l_orderkey * 10 + l_linenumber) AS notice_id, s_name AS agency,
         place_region AS region, place_name AS city, l_shipdate AS event_at, 'Lote ' || l_linenumber AS title,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS value,
         CASE WHEN l_linestatus = 'O' THEN 'published' ELSE 'draft' END AS publication_status, l_returnflag AS modality
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN places ON s_nationkey = place_code)"""

UNIFIED = NOTICES + ", " + SECOND_SOURCE + f""", both_sources AS (
  SELECT id, notice_id, agency, region, city, published_at, event_at, title, description, tags,
         CASE WHEN length(storage_path) > 0 THEN storage_path ELSE portal_link END AS notice_link, modality, value,
         CAST(NULL AS BIGINT) AS items, 'portal' AS source_type
  FROM notices WHERE publication_status = 'published' AND event_at IS NOT NULL
  UNION ALL
  SELECT id, notice_id, agency, region, city, NULL, event_at, title, NULL, NULL, NULL, modality, value, 1, 'auctioneer'
  FROM second_source WHERE publication_status = 'published' AND event_at IS NOT NULL),
unified AS (
  SELECT b.*, p.place_code, p.place_name, p.latitude, p.longitude,
         CASE WHEN event_at >= TIMESTAMP '{AS_OF}' THEN 'future' ELSE 'past' END AS temporal_status
  FROM both_sources b LEFT JOIN places p ON upper(trim(b.city)) = upper(trim(p.place_name)) AND b.region = p.place_region)"""


# ---------------------------------------------------------------- runs (events per user and day)
def runs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")

    def n(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    g = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("processed"), n("error").alias("quarantined"),
        n("signup").alias("new_rows"), n("click").alias("discarded"), n("purchase").alias("downloads_ok"), n("view").alias("downloads_failed"),
    )
    running = (F.col("processed") == 1) & (F.col("downloads_failed") == 1)
    return g.select(
        F.concat_ws("-", "user_id", F.date_format("day", "yyyyMMdd")).alias("run_id"),
        F.col("user_id").alias("pipeline"), "day", "started_at",
        F.when(~running, F.col("last_ts")).alias("ended_at"),
        "processed", (F.col("processed") - F.col("quarantined")).alias("valid"), "quarantined", "new_rows", "discarded", "downloads_ok", "downloads_failed",
        percent(F.col("quarantined"), F.col("processed")).alias("quarantine_percent"),
        (F.unix_timestamp("last_ts") - F.unix_timestamp("started_at")).alias("duration_s"),
        F.when(running, F.lit("RUNNING")).when(F.col("quarantined") * 2 > F.col("processed"), F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
    )


RUNS = """run_base AS (
  SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS started_at, max(ts) AS last_ts, count(*) AS processed,
         count(*) FILTER (WHERE event_type = 'error') AS quarantined, count(*) FILTER (WHERE event_type = 'signup') AS new_rows,
         count(*) FILTER (WHERE event_type = 'click') AS discarded, count(*) FILTER (WHERE event_type = 'purchase') AS downloads_ok,
         count(*) FILTER (WHERE event_type = 'view') AS downloads_failed
  FROM events GROUP BY 1, 2),
runs AS (
  SELECT user_id || '-' || strftime(day, '%Y%m%d') AS run_id, user_id AS pipeline, day, started_at,
         CASE WHEN NOT (processed = 1 AND downloads_failed = 1) THEN last_ts END AS ended_at, processed,
         processed - quarantined AS valid, quarantined, new_rows, discarded, downloads_ok, downloads_failed,
         round(100.0 * quarantined / processed, 2) AS quarantine_percent,
         CAST(floor(epoch(last_ts)) - floor(epoch(started_at)) AS BIGINT) AS duration_s,
         CASE WHEN processed = 1 AND downloads_failed = 1 THEN 'RUNNING' WHEN quarantined * 2 > processed THEN 'FAILED' ELSE 'SUCCESS' END AS status
  FROM run_base)"""


# ---------------------------------------------------------------- contract records (orders)
def records(spark: SparkSession, sf: str) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    key, pri, st, seg = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("c_mktsegment")
    day = F.date_format("o_orderdate", "dd-MM-yyyy")
    return j.select(
        F.date_format("o_orderdate", "yyyyMM").alias("run_id"),
        key.cast("string").alias("id_interno"),
        F.col("n_name").alias("municipio"),
        F.lit("SP").alias("uf"),
        F.when((pri == "4-NOT SPECIFIED") & (st == "O"), F.date_format("o_orderdate", "dd/MM/yyyy")).when((pri != "5-LOW") | (st != "P"), day).alias("data_leilao"),
        F.when(pri == "1-URGENT", F.concat(F.lit("www.portal.example.com/"), key))
        .when((pri == "3-MEDIUM") & (st == "P"), F.lit("COMEMORA"))
        .when((pri == "2-HIGH") & (st == "P"), F.lit("sem endereco"))
        .otherwise(F.concat(F.lit("https://portal.example.com/"), key))
        .alias("pncp_url"),
        day.alias("data_atualizacao"),
        day.alias("data_publicacao"),
        F.concat_ws(" ", F.lit("Leilão"), seg).alias("titulo"),
        F.concat_ws(" ", F.lit("Bens"), seg).alias("descricao"),
        F.col("c_name").alias("orgao"),
        F.when(seg != "FURNITURE", seg).otherwise(F.lit(" ")).alias("objeto_resumido"),
        F.when(seg == "BUILDING", F.lit("BUILDING, SEM CLASSIFICAÇÃO")).when(seg == "MACHINERY", F.lit("SEM CLASSIFICAÇÃO")).otherwise(seg).alias("tags"),
        F.when(F.col("c_acctbal") >= 0, F.col("o_totalprice").cast("decimal(15,2)")).alias("valor_estimado"),
    )


RECORDS = """records AS (
  SELECT strftime(o_orderdate, '%Y%m') AS run_id, CAST(o_orderkey AS VARCHAR) AS id_interno, n_name AS municipio, 'SP' AS uf,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN strftime(o_orderdate, '%d/%m/%Y')
              WHEN o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P' THEN strftime(o_orderdate, '%d-%m-%Y') END AS data_leilao,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'www.portal.example.com/' || o_orderkey
              WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN 'COMEMORA'
              WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 'sem endereco'
              ELSE 'https://portal.example.com/' || o_orderkey END AS pncp_url,
         CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment ELSE ' ' END AS objeto_resumido,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'BUILDING, SEM CLASSIFICAÇÃO' WHEN 'MACHINERY' THEN 'SEM CLASSIFICAÇÃO' ELSE c_mktsegment END AS tags,
         CASE WHEN c_acctbal >= 0 THEN o_totalprice END AS valor_estimado
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
flags AS (
  SELECT *, contains(data_leilao, '/') AS slash_date, pncp_url = 'COMEMORA' AS text_url, starts_with(pncp_url, 'www.') AS www_url,
         pncp_url <> 'COMEMORA' AND NOT regexp_matches(CASE WHEN starts_with(pncp_url, 'www.') THEN 'https://' || pncp_url ELSE pncp_url END,
           '^https?://([a-z0-9-]+\\.)+[a-z]{2,}(/|$)') AS bad_url,
         contains(tags, 'SEM CLASSIFICAÇÃO') AS tags_changed, tags = 'SEM CLASSIFICAÇÃO' AS tags_empty,
         trim(objeto_resumido) = '' AS no_summary
  FROM records),
validated AS (
  SELECT *, CASE WHEN coalesce(slash_date, false) OR bad_url OR text_url THEN 'rejected'
                 WHEN data_leilao IS NULL OR tags_empty OR valor_estimado IS NULL THEN 'not_sellable'
                 WHEN no_summary THEN 'draft' ELSE 'valid' END AS status
  FROM flags),
errors AS (
  SELECT run_id, id_interno, status, 1 AS pos, 'tags_normalized' AS code, 'tags' AS field FROM validated WHERE tags_changed
  UNION ALL SELECT run_id, id_interno, status, 2, 'tags_empty_after_normalization', 'tags' FROM validated WHERE tags_empty
  UNION ALL SELECT run_id, id_interno, status, 3, 'invalid_date_format', 'data_leilao' FROM validated WHERE slash_date
  UNION ALL SELECT run_id, id_interno, status, 4, 'text_as_url', 'pncp_url' FROM validated WHERE text_url
  UNION ALL SELECT run_id, id_interno, status, 5, 'url_normalized', 'pncp_url' FROM validated WHERE www_url
  UNION ALL SELECT run_id, id_interno, status, 6, 'invalid_url', 'pncp_url' FROM validated WHERE bad_url
  UNION ALL SELECT run_id, id_interno, status, 7, 'missing_required_field', 'data_leilao' FROM validated WHERE data_leilao IS NULL
  UNION ALL SELECT run_id, id_interno, status, 8, 'missing_required_field', 'objeto_resumido' FROM validated WHERE no_summary
  UNION ALL SELECT run_id, id_interno, status, 9, 'missing_required_field', 'tags' FROM validated WHERE tags_empty
  UNION ALL SELECT run_id, id_interno, status, 10, 'missing_required_field', 'valor_estimado' FROM validated WHERE valor_estimado IS NULL),
reasons AS (
  SELECT v.run_id, v.id_interno, v.status,
         coalesce((SELECT arg_min(code, pos + CASE WHEN code IN ('url_normalized', 'tags_normalized') THEN 100 ELSE 0 END)
                   FROM errors e WHERE e.id_interno = v.id_interno), v.status) AS reason_code
  FROM validated v WHERE v.status <> 'valid')"""
