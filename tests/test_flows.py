"""Crawl budgets, states out of logs, cards, audits and payloads, against plain walks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from noticelake.operators import ranks
from noticelake.operators.reach import bounded_reach
from noticelake.operators.transitions import follow, state_times
from noticelake.plans import audits, cards, payloads
from noticelake.presets import br_notices as br
from noticelake.sources.keyed_table import KeyedTable
from noticelake.sources.snapshots import Snapshots


# ---------------------------------------------------------------- crawls
def walk(seeds, edges, depth, budget):
    out = {}
    for seed in seeds:
        seen, level = {seed: 0}, [seed]
        for d in range(1, depth + 1):
            level = sorted({t for s, t in edges if s in level and t != s} - set(seen))[: budget - len(seen)]
            seen |= dict.fromkeys(level, d)
        out |= {(seed, u): d for u, d in seen.items()}
    return out


@pytest.mark.parametrize("hub", [2, 10_000])
@pytest.mark.parametrize("budget", [1, 4, 9, 300])
def test_budget_walk(spark, budget, hub):
    rng = random.Random(budget)
    pages = [f"p{i:02d}" for i in range(40)]
    edges = {(rng.choice(pages), rng.choice(pages)) for _ in range(90)} | {(p, "p00") for p in pages} | {("p00", p) for p in pages}
    e = spark.createDataFrame([(s, t, "h", "h") for s, t in edges], "src string, dst string, src_host string, dst_host string")
    seeds = ["p03", "p17", "p00", "none"]
    got = bounded_reach(spark.createDataFrame([(s,) for s in seeds], "seed string"), e, 3, max_pages=budget, hub=hub)
    rows = [(r.seed, r.url) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert {(r.seed, r.url): r.depth for r in got.collect()} == walk(seeds, edges, 3, budget)


# ---------------------------------------------------------------- ranks
def test_ranks_over_ranges(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("v"), "id").withColumn("_rows", F.lit(1))
    got = ranks.with_rank(df, F.col("v").desc(), F.col("id").asc())
    assert got.columns == ["v", "id", "_rows", "rank"]
    assert [r.rank for r in got.orderBy(F.col("v").desc(), "id").collect()] == list(range(1, 5001))
    assert ranks.with_rank(df.limit(0), F.col("v")).count() == 0


# ---------------------------------------------------------------- states
STATES = ("open", "acknowledged", "resolved", "discarded")


def test_states_follow_the_log_however_it_is_cut(spark):
    rng = random.Random(1)
    t0 = dt.datetime(2026, 1, 1)
    log = [(i, "hot" if i % 3 else rng.choice(["a", "b", None]), rng.choice([*STATES, "unheard_of", None]), t0 + dt.timedelta(seconds=rng.randrange(500))) for i in range(600)]
    want, now = {}, {}
    for i, k, to, at in sorted(log, key=lambda r: (r[3], r[0])):
        a = now.get(k, "open")
        now[k] = to if (a, to) in br.ALERT_MOVES else a
        want[i] = (a, now[k], (a, to) in br.ALERT_MOVES)
    df = spark.createDataFrame(log, "i long, k string, to string, at timestamp").repartition(5)
    for stretch in (3, 50, 2048):
        done = follow(df, "k", "to", [F.col("at"), F.col("i")], STATES, br.ALERT_MOVES, stretch)
        assert {r.i: (r.from_state, r.state, r.legal) for r in done.collect()} == want
    times = {(r.k, r.state): r for r in state_times(done, "k", "at", t0 + dt.timedelta(seconds=1000), STATES).collect()}
    for k in ("hot", "a", "b", None):
        mine = [r for (x, _), r in times.items() if x == k]
        begin = min(r[3] for r in log if r[1] == k)
        assert sum(r.seconds for r in mine) == pytest.approx((t0 + dt.timedelta(seconds=1000) - begin).total_seconds())
        assert [r.state for r in mine if r.is_current] == [now[k]] and all(r.seconds >= 0 for r in mine)


# ---------------------------------------------------------------- cards
PAGE = """<div class="top"><div class="lote" id=1><div>FIAT/PALIO FIRE <div>2008</div></div><span>Lote 7</span> Sucata R$ 1.500,00 ABC-1D23</div>
<DIV class='lote x'><b>GM/CORSA SUPER</b><div class="lote">inner 2011</div></DIV>
<div class="other">HONDA/CG R$ 9,00</div></div></div>
<div class="lote"/><div class="lote">VW/GOL R$ 300,00 <divider>1999"""


def test_cards_keep_their_own_fields(spark):
    site = cards.Site("detran_mg", "div", r"(?i)class=[\"'](?:[^\"']*\s)?lote\b", br.CARD_FIELDS["detran_mg"], ("vehicle",))
    pages = spark.createDataFrame([("u", PAGE), ("v", None), ("w", ""), ("x", "<p>no card</p>")], "url string, html string")
    cut = cards.cut_cards(pages, "div", site.opens).collect()
    assert [c.position for c in cut] == [0, 1, 2] and cut[1].card.count("lote") == 2 and "HONDA" not in "".join(c.card for c in cut)
    got = [(r.lot, r.vehicle, float(r.price), r.model_year, r.category, r.plate) for r in cards.listing_cards(pages, site).orderBy("lot").collect()]
    assert got == [
        (2, "GM/CORSA SUPER", 0.0, 2011, None, None),
        (3, "VW/GOL R", 300.0, 1999, None, None),
        (7, "FIAT/PALIO FIRE", 1500.0, 2008, "Sucata", "ABC-1D23"),
    ]


def test_short_years_and_yards(spark):
    site = cards.Site("sodre_santoro", "article", "", br.CARD_FIELDS["sodre_santoro"], ("vehicle",), {"category": "sucata"})
    html = '<article><a href="/x/lote/55"><img src="i.jpg"></a>FIAT UNO 97/98 R$ 5.000 Pátio: Guarulhos</article><article>TOYOTA COROLLA 14/15 </article>'
    r = cards.listing_cards(spark.createDataFrame([("u", html)], "url string, html string"), site).orderBy("lot").collect()
    assert [(x.lot, x.vehicle, x.model_year, x.category, x.yard, x.lot_url, x.image) for x in r] == [
        (2, "TOYOTA COROLLA", 2015, "Sucata", None, None, None), (55, "FIAT UNO", 1998, "Sucata", "Guarulhos", "/x/lote/55", "i.jpg"),
    ]


# ---------------------------------------------------------------- audits
def test_an_error_is_retried_once_and_a_found_row_never(spark):
    log = audits.AuditLog(KeyedTable(Snapshots(spark, tmp_path(spark)), ["notice_id", "attempt", "kind"], buckets=2))
    notices = spark.createDataFrame([(i,) for i in range(5)], "notice_id long")
    at = lambda h, m=0: dt.datetime(2026, 1, 1, h, m)
    leased = lambda run, when: sorted((r.notice_id, r.attempt) for r in log.lease(notices, run, when).collect())
    done = lambda run, when, *rows: log.finish(spark.createDataFrame(rows, "notice_id long, attempt int, result string"), run, when)
    assert leased("one", at(8)) == [(i, 1) for i in range(5)]
    assert leased("two", at(8, 10)) == []  # all are being read
    done("one", at(8, 20), (0, 1, "found"), (1, 1, "no_link"), (2, 1, "error"), (3, 1, "skipped"))
    done("one", at(8, 21), (0, 1, "error"))  # a second outcome of the same attempt is not heard
    assert leased("two", at(8, 25)) == [(2, 2)]
    assert leased("three", at(8, 45)) == [(4, 2)]  # its lease ran out
    done("two", at(8, 50), (2, 2, "error"))
    assert leased("four", at(12)) == []
    state = {r.notice_id: (r.result, r.attempts, r.errors) for r in audits.audit_state(log.table.rows(), at(12)).collect()}
    assert state == {0: ("found", 1, 0), 1: ("no_link", 1, 0), 2: ("error", 2, 2), 3: ("skipped", 1, 0), 4: ("error", 2, 2)}


def tmp_path(spark):
    import tempfile

    return tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/t"


# ---------------------------------------------------------------- payloads
def test_payloads_are_kept_whole(spark):
    raw = spark.createDataFrame([(1, '{"id": 5, "new": {"a": [1, null]}}'), (2, "[1,"), (3, None), (4, '{"id": "five"}'), (5, "7")], "n int, raw string")
    s = payloads.stage_payloads(raw, "raw")
    got = payloads.typed(s, {"id": ("$.id", "bigint"), "a": ("$.new.a[0]", "int")}).withColumn("whole", payloads.as_text())
    assert [(r.payload_ok, r.id, r.a, r.whole) for r in got.orderBy("n").collect()] == [
        (True, 5, 1, '{"id":5,"new":{"a":[1,null]}}'), (False, None, None, None), (True, None, None, None), (True, None, None, '{"id":"five"}'), (True, None, None, "7"),
    ]
    assert [tuple(r) for r in payloads.foreign_fields(s, ["id"]).collect()] == [("new", "OBJECT<a: ARRAY<BIGINT>>", 1)]
