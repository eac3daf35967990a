"""Queries of work that goes on over time: merges, known keys, changes from two sides, states, limits, crawls, audits, staged files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from noticelake.operators.joins import zip_lists
from noticelake.operators.ranks import capacity_brake
from noticelake.operators.transitions import follow, state_times
from noticelake.plans import audits, cards, discovery, payloads
from noticelake.presets import br_notices as br
from noticelake.queries.base import NOTICES, plain, table
from noticelake.queries.operations import _FILTERS, _matchable, saved_filters
from noticelake.session import ensure_checkpoint_dir
from noticelake.sources.keyed_table import KeyedTable
from noticelake.sources.readers import read_csv_any_encoding
from noticelake.sources.sinks import upsert
from noticelake.sources.snapshots import Snapshots
from noticelake.streaming.notify import Matches

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = lambda spark, sf: plain(fn(spark, sf))
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn

    return add


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- tables that grow
@query(
    """SELECT o_orderkey, o_orderkey % 8 AS part, CASE WHEN o_orderkey % 2 = 0 AND o_custkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 2 = 0 THEN 'second' ELSE 'first' END AS batch, 'first' AS created_at FROM orders"""
)
def merged_snapshots(spark, sf):
    """Orders merged by a second batch that changes every second part of the table, some values being NULL, and leaves the other parts alone."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 8).alias("part"), F.col("o_totalprice").alias("price"), F.lit("first").alias("batch"), F.lit("first").alias("created_at"), F.col("o_custkey").alias("_c")
    )
    path = _folder(spark, "merged")
    upsert(spark, path, rows.drop("_c"), ["o_orderkey", "part"], "part")
    change = rows.where("part % 2 = 0").select(
        "o_orderkey", "part", F.when(F.col("_c") % 2 == 0, F.col("price") + 1).alias("price"), F.lit("second").alias("batch"), F.lit("second").alias("created_at")
    )
    upsert(spark, path, change, ["o_orderkey", "part"], "part")
    return Snapshots(spark, path).read()


@query("SELECT o_custkey, min(o_orderkey) AS first_order, count(*) OVER () AS customers FROM orders GROUP BY 1")
def known_keys(spark, sf):
    """First order of each customer out of three batches, the last of which repeats the first: only unseen keys go on."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    third = F.percentile_approx("o_orderkey", [1 / 3, 2 / 3])
    low, high = o.agg(third.alias("p")).first()["p"]
    keyed = KeyedTable(Snapshots(spark, _folder(spark, "known")), ["o_custkey"])
    first = o.where(F.col("o_orderkey") <= low)
    for batch in (first, o.where((F.col("o_orderkey") > low) & (F.col("o_orderkey") <= high)), o.where(F.col("o_orderkey") > high), first):
        keyed.append_new(batch, [F.col("o_orderkey")])
    rows = keyed.rows()
    return rows.select("o_custkey", F.col("o_orderkey").alias("first_order")).join(rows.agg(F.count(F.lit(1)).alias("customers")))  # one row


@query(f"WITH {NOTICES}, {_FILTERS} SELECT user_id, notice_id, min(filter_id) AS filter_id FROM hits GROUP BY 1, 2")
def matches_of_both_sides(spark, sf):
    """Notices and filters that arrive in halves, each half after the other side's: what is known in the end is what one batch finds."""
    n, f = _matchable(spark, sf).select("notice_id", "region", "city", "tags", "value"), saved_filters(spark, sf).drop("label")
    state = Matches(spark, _folder(spark, "matches"), buckets=8)
    state.change(n.where("notice_id % 2 = 0"), f.where("filter_id % 2 = 1"))
    state.change(None, f.where("filter_id % 2 = 0"))
    state.change(n.where("notice_id % 2 = 1"), None)
    return state.known()


# ---------------------------------------------------------------- states
STATES = ("open", "acknowledged", "resolved", "discarded")
_TO = {"view": "acknowledged", "click": "resolved", "purchase": "open", "error": "discarded"}


def _named(names: dict[str, str], column: str):
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col(column))


def _requests(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", "user_id", "ts", F.coalesce(_named(_TO, "event_type"), F.lit("unheard_of")).alias("to_state"))


_FOLLOWED = """WITH RECURSIVE q AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'view' THEN 'acknowledged' WHEN 'click' THEN 'resolved' WHEN 'purchase' THEN 'open' WHEN 'error' THEN 'discarded' ELSE 'unheard_of' END AS to_state,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events),
moves(a, b) AS (VALUES ('open', 'acknowledged'), ('open', 'resolved'), ('acknowledged', 'resolved'), ('open', 'discarded'), ('acknowledged', 'discarded'), ('resolved', 'open')),
f AS (SELECT event_id, user_id, ts, to_state, place, 'open' AS from_state, CASE WHEN to_state IN (SELECT b FROM moves WHERE a = 'open') THEN to_state ELSE 'open' END AS state FROM q WHERE place = 1
  UNION ALL SELECT q.event_id, q.user_id, q.ts, q.to_state, q.place, f.state, coalesce(m.b, f.state) FROM f JOIN q ON q.user_id = f.user_id AND q.place = f.place + 1 LEFT JOIN moves m ON m.a = f.state AND m.b = q.to_state)
"""


@query(_FOLLOWED + "SELECT event_id, user_id, to_state, from_state, state, from_state <> state AS legal FROM f")
def alert_transitions(spark, sf):
    done = follow(_requests(spark, sf), "user_id", "to_state", [F.col("ts"), F.col("event_id")], STATES, br.ALERT_MOVES)
    return done.select("event_id", "user_id", "to_state", "from_state", "state", "legal")


@query(
    _FOLLOWED
    + """, legal AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY place) AS until FROM (
  SELECT user_id, 0 AS place, min(ts) AS ts, 'open' AS state FROM f GROUP BY 1 UNION ALL SELECT user_id, place, ts, state FROM f WHERE from_state <> state))
SELECT user_id, state, count(*) AS entered, round(sum(epoch_us(coalesce(until, TIMESTAMP '2024-03-01')) - epoch_us(ts)) / 1000000.0, 3) AS seconds, bool_or(until IS NULL) AS is_current FROM legal GROUP BY 1, 2"""
)
def alert_state_times(spark, sf):
    done = follow(_requests(spark, sf), "user_id", "to_state", [F.col("ts"), F.col("event_id")], STATES, br.ALERT_MOVES)
    return state_times(done, "user_id", "ts", "2024-03-01", STATES).withColumn("seconds", F.round("seconds", 3))


@query(
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS place, count(*) OVER () AS n, (SELECT count(*) FROM customer) * 5 - (SELECT count(*) FROM supplier) AS room FROM orders)
SELECT o_orderkey, place <= room AS accepted, least(n, room)::BIGINT AS n_accepted, greatest(n - room, 0)::BIGINT AS n_rejected FROM r"""
)
def capacity_limit(spark, sf):
    """Orders that fit into a store with room for five a customer, newest first, and those refused, with both counts."""
    stored, most = table(spark, sf, "supplier").count(), 5 * table(spark, sf, "customer").count()
    done = capacity_brake(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), stored, most, F.col("o_orderdate").desc(), F.col("o_orderkey").asc())
    both = done.accepted.withColumn("accepted", F.lit(True)).unionByName(done.rejected.withColumn("accepted", F.lit(False)))
    return both.select("o_orderkey", "accepted", F.lit(done.n_accepted).cast("bigint").alias("n_accepted"), F.lit(done.n_rejected).cast("bigint").alias("n_rejected"))


# ---------------------------------------------------------------- crawls
_BUDGET = 60


def _trade_graph(spark, sf):
    """Suppliers link to their parts, parts to the orders that hold them, orders to the suppliers of their lines: nodes grow with the tables."""
    l = table(spark, sf, "lineitem")
    s, p, o = F.concat(F.lit("s"), "l_suppkey"), F.concat(F.lit("p"), "l_partkey"), F.concat(F.lit("o"), "l_orderkey")
    out = l.select(s.alias("src"), p.alias("dst")).unionByName(l.select(p.alias("src"), o.alias("dst"))).unionByName(l.select(o.alias("src"), s.alias("dst")))
    return out.withColumn("src_host", F.lit("site")).withColumn("dst_host", F.lit("site"))


def _level(n: int) -> str:
    seen = " UNION ALL ".join(f"SELECT seed, url FROM l{i}" for i in range(n))
    return f"""l{n} AS (SELECT seed, url, {n} AS depth FROM (SELECT seed, url, row_number() OVER (PARTITION BY seed ORDER BY url) AS rn, (SELECT count(*) FROM ({seen}) u WHERE u.seed = c.seed) AS used
  FROM (SELECT DISTINCT f.seed, e.dst AS url FROM l{n - 1} f JOIN e ON e.src = f.url WHERE (f.seed, e.dst) NOT IN (SELECT (seed, url) FROM ({seen}))) c) WHERE rn + used <= {_BUDGET})"""


@query(
    f"""WITH e AS (SELECT DISTINCT src, dst FROM (SELECT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM lineitem UNION ALL SELECT 'p' || l_partkey, 'o' || l_orderkey FROM lineitem
  UNION ALL SELECT 'o' || l_orderkey, 's' || l_suppkey FROM lineitem)), l0 AS (SELECT DISTINCT 's' || s_suppkey AS seed, 's' || s_suppkey AS url, 0 AS depth FROM supplier),
{_level(1)}, {_level(2)}, {_level(3)}
SELECT seed, url, depth::BIGINT AS depth FROM (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3)"""
)
def budget_reach(spark, sf):
    """Pages within three steps of each supplier under a budget of pages a seed."""
    seeds = table(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("seed"))
    return discovery.reach(seeds, _trade_graph(spark, sf), 3, max_pages=_BUDGET)


# ---------------------------------------------------------------- cards
NAV = cards.Site(
    "nav", "li", "", {"vehicle": r"<a[^>]*>([^<]+)</a>", "model_year": r"[^0-9](20[0-9][0-9])[^0-9]", "category": r"href=\"/([a-z]+)", "plate": r"href=\"/([A-Z][a-z]+)", "lot_url": r"href=\"([^\"]+)\""}, ("vehicle",)
)


@query(
    """WITH c AS (SELECT url, generate_subscripts(l, 1) - 1 AS position, unnest(l) AS card FROM (SELECT url, regexp_extract_all(html, '(?is)<li(?:\\s[^>]*)?>.*?</li>') AS l FROM pages WHERE len(regexp_extract_all(html, '(?is)<li(?:\\s[^>]*)?>.*?</li>')) > 0)),
f AS (SELECT url, position, trim(regexp_extract(card, '<a[^>]*>([^<]+)</a>', 1)) AS vehicle, regexp_extract(card, '[^0-9](20[0-9][0-9])[^0-9]', 1) AS y, regexp_extract(card, 'href="/([a-z]+)', 1) AS category,
  regexp_extract(card, 'href="/([A-Z][a-z]+)', 1) AS plate, regexp_extract(card, 'href="([^"]+)"', 1) AS lot_url FROM c)
SELECT url, position::BIGINT AS position, vehicle, nullif(y, '') AS model_year, nullif(category, '') AS category, nullif(plate, '') AS plate, nullif(lot_url, '') AS lot_url FROM f WHERE vehicle <> ''"""
)
def page_cards(spark, sf):
    """Items of the pages' menus as cards; most lack one field or another."""
    return cards.read_cards(table(spark, sf, "pages"), NAV).select("url", "position", "vehicle", "model_year", "category", "plate", "lot_url")


@query(
    """WITH c AS (SELECT url, generate_subscripts(l, 1) AS lot, unnest(l) AS card FROM (SELECT url, regexp_extract_all(html, '(?is)<li(?:\\s[^>]*)?>.*?</li>') AS l FROM pages WHERE len(regexp_extract_all(html, '(?is)<li(?:\\s[^>]*)?>.*?</li>')) > 0))
SELECT url, lot::BIGINT AS lot, substr(md5('nav|' || url || '|' || (lot - 1)), 1, 16) AS vehicle_id, replace(upper(trim(regexp_extract(card, '<a[^>]*>([^<]+)</a>', 1))), 'ẞ', 'SS') AS vehicle, 0::DOUBLE AS price,
  nullif(regexp_extract(card, 'href="/([A-Z][a-z]+)', 1), '') AS plate FROM c WHERE trim(regexp_extract(card, '<a[^>]*>([^<]+)</a>', 1)) <> ''"""
)
def listing_cards(spark, sf):
    return cards.listing_cards(table(spark, sf, "pages"), NAV).select("url", "lot", "vehicle_id", "vehicle", "price", "plate")


@query(
    """WITH p AS (SELECT url, regexp_extract_all(html, 'href="(/[^"]*)"', 1) AS h, regexp_extract_all(html, '<p><b>([A-Za-z]+)', 1) AS b FROM pages)
SELECT url, i::BIGINT AS position, h[i] AS link, b[i] AS word FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM p)"""
)
def zipped_lists(spark, sf):
    """Match lists of a page side by side; the shorter one gives NULL."""
    lists = {"link": F.regexp_extract_all("html", F.lit(r'href="(/[^"]*)"'), 1), "word": F.regexp_extract_all("html", F.lit(r"<p><b>([A-Za-z]+)"), 1)}
    return zip_lists(table(spark, sf, "pages"), lists, ["url"], ["link"])


# ---------------------------------------------------------------- audits
_AUDITS = """log AS (SELECT user_id AS notice_id, event_id % 3 + 1 AS attempt, CASE event_type WHEN 'view' THEN 'lease' ELSE 'outcome' END AS kind, event_id, ts,
  CASE event_type WHEN 'click' THEN 'found' WHEN 'purchase' THEN 'no_link' WHEN 'error' THEN 'error' WHEN 'view' THEN NULL ELSE 'skipped' END AS result FROM events WHERE event_id % 97 < 3),
each AS (SELECT notice_id, attempt, max(CASE WHEN kind = 'lease' THEN ts + INTERVAL 30 MINUTE END) AS until, arg_min(result, (ts, event_id)) FILTER (kind = 'outcome') AS own FROM log GROUP BY 1, 2),
judged AS (SELECT notice_id, attempt, coalesce(own, CASE WHEN until <= TIMESTAMP '2024-01-20' THEN 'error' END) AS result FROM each),
state AS (SELECT notice_id, count(*) AS attempts, count(*) FILTER (result = 'error') AS errors, arg_max(coalesce(result, 'running'), attempt) AS result FROM judged GROUP BY 1)"""


def _audit_log(spark, sf):
    """A log out of events: views are leases, all else outcomes."""
    e = table(spark, sf, "events").where("event_id % 97 < 3")
    kind = F.when(F.col("event_type") == "view", "lease").otherwise("outcome")
    names = {"click": "found", "purchase": "no_link", "error": "error"}
    result = F.when(kind == "outcome", F.coalesce(_named(names, "event_type"), F.lit("skipped")))
    return e.select(
        F.col("user_id").alias("notice_id"), (F.col("event_id") % 3 + 1).cast("int").alias("attempt"), kind.alias("kind"), F.lpad(F.col("event_id").cast("string"), 20, "0").alias("run_id"),
        F.col("ts").alias("at"), F.when(kind == "lease", F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("until"), result.alias("result"),
    )


@query(f"WITH {_AUDITS} SELECT notice_id, attempts, errors, nullif(result, 'running') AS result, result = 'error' AND attempts < 2 AS is_open FROM state")
def audit_states(spark, sf):
    return audits.audit_state(_audit_log(spark, sf), "2024-01-20").select("notice_id", "attempts", "errors", "result", "is_open")


@query(
    f"""WITH {_AUDITS} SELECT c_custkey AS notice_id, coalesce(attempts, 0) + 1 AS attempt FROM customer LEFT JOIN state ON notice_id = c_custkey
WHERE notice_id IS NULL OR (result = 'error' AND attempts < 2)"""
)
def audits_due(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("notice_id"))
    return audits.due(c, _audit_log(spark, sf), "2024-01-20").select("notice_id", "attempt")


# ---------------------------------------------------------------- payloads and files
def _payloads(spark, sf):
    """Events as payloads: known fields, some of other types, fields that only some have, and text that is no JSON."""
    e = table(spark, sf, "events")
    extra = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(', "zone": {"name": "'), "event_type", F.lit('", "codes": [1, 2]}'))).when(F.col("event_id") % 3 == 1, F.lit(', "zone": "none"')).otherwise(F.lit(""))
    k = F.when(F.col("event_id") % 5 == 0, F.lit('"x"')).otherwise(F.col("event_id").cast("string"))
    text = F.concat(F.lit('{"k": '), k, F.lit(', "user": '), F.col("user_id").cast("string"), extra, F.lit("}"))
    return e.select("event_id", F.when(F.col("event_id") % 11 == 0, F.lit("{broken")).otherwise(text).alias("raw"))


_PAYLOADS = """p AS (SELECT event_id, event_id % 11 <> 0 AS ok, event_id % 5 <> 0 AS number, event_id % 3 AS form, user_id, event_type FROM events)"""


@query(
    f"""WITH {_PAYLOADS} SELECT event_id, ok, CASE WHEN ok AND number THEN event_id END AS k, CASE WHEN ok THEN user_id END AS user_id, CASE WHEN ok AND form = 0 THEN event_type END AS zone_name,
  CASE WHEN ok THEN '{{"k":' || CASE WHEN number THEN event_id::VARCHAR ELSE '"x"' END || ',"user":' || user_id || CASE form WHEN 0 THEN ',"zone":{{"codes":[1,2],"name":"' || event_type || '"}}' WHEN 1 THEN ',"zone":"none"' ELSE '' END || '}}' END AS whole FROM p"""
)
def staged_payloads(spark, sf):
    s = payloads.typed(payloads.stage_payloads(_payloads(spark, sf), "raw"), {"k": ("$.k", "bigint"), "user_id": ("$.user", "bigint"), "zone_name": ("$.zone.name", "string")})
    return s.select("event_id", F.col("payload_ok").alias("ok"), "k", "user_id", "zone_name", payloads.as_text().alias("whole"))


@query(
    f"""WITH {_PAYLOADS} SELECT 'zone' AS field, CASE form WHEN 0 THEN 'OBJECT<codes: ARRAY<BIGINT>, name: STRING>' ELSE 'STRING' END AS kind, count(*) AS payloads FROM p WHERE ok AND form < 2 GROUP BY 2"""
)
def foreign_fields(spark, sf):
    return payloads.foreign_fields(payloads.stage_payloads(_payloads(spark, sf), "raw"), ["k", "user"])


@query(
    """SELECT c_custkey, c_name || CASE WHEN c_custkey % 2 = 0 THEN ' São' ELSE '' END AS name, 'f' || c_nationkey || ':row=' || (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) + 1) || ':col=name' AS ref FROM customer"""
)
def numbered_cells(spark, sf):
    """Customers written as one sheet a nation and read back with the line that each stands in, whatever the size of the splits."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.concat("c_name", F.when(F.col("c_custkey") % 2 == 0, " São").otherwise("")).alias("name"), "c_nationkey", "c_custkey")
    folder = _folder(spark, "sheets")
    c.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("key", "name", "c_nationkey").write.partitionBy("c_nationkey").csv(folder, header=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_csv_any_encoding(spark, f"{folder}/*/*.csv", "key string, name string")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    sheet = F.concat(F.lit("f"), F.regexp_extract("file", r"c_nationkey=(\d+)", 1))
    return rows.select(F.col("key").cast("bigint").alias("c_custkey"), "name", F.concat(sheet, F.lit(":row="), F.col("line_no") + 1, F.lit(":col=name")).alias("ref"))
