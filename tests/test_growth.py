"""Plans and answers that only go wrong on larger tables: broadcasts by the size of a file, repeated reads, ties."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from noticelake.functions import extract
from noticelake.operators import shares
from noticelake.operators.joins import tag_by_terms
from noticelake.operators.paging import natural_number
from noticelake.operators.transitions import follow, state_times
from noticelake.plans import contract, lots, match
from noticelake.queries import pages, quality, serving
from noticelake.streaming import notify


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().sparkPlan().toString()


def on_disk(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_tagging_broadcasts_no_side_that_grows_with_the_rows(spark, tmp_path):
    rows = on_disk(spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, "red bolt").otherwise("blue ring").alias("text")), tmp_path / "rows")
    terms = spark.createDataFrame([("bolt", "METAL"), ("ring", "RING"), ("blue", "COLOUR")], "term string, tag string")
    tagged = tag_by_terms(rows, terms, "text", "id")
    _, plan = plan_of(tagged)
    joins = [line for line in plan.splitlines() if "HashJoin" in line]
    assert all("LeftSemi" in j for j in joins)  # the terms' fragments
    assert {(tuple(r["tags"]), r["n"]) for r in tagged.groupBy("tags").agg(F.count("*").alias("n")).collect()} == {(("METAL",), 1000), (("COLOUR", "RING"), 1000)}


def test_states_follow_a_log_without_a_join_by_row_and_read_it_once(spark, tmp_path):
    log = spark.range(3000).select(F.col("id").alias("e"), (F.col("id") % 3).alias("_key"), F.timestamp_seconds("id").alias("at"), F.when(F.col("id") % 2 == 0, "b").otherwise("a").alias("to"))
    log = on_disk(log, tmp_path / "log")
    done = follow(log, "_key", "to", [F.col("e")], ("a", "b"), {("a", "b"), ("b", "a")}, stretch=100)
    assert done.columns == [*log.columns, "from_state", "state", "legal"]
    assert "BroadcastHashJoin" not in plan_of(done)[1]
    assert done.count() == 3000 and done.where("state = to").count() == 3000 and done.where("from_state <> state").count() == done.where("legal").count()
    times = state_times(done, "_key", "at", "1970-01-01 01:00:00", ("a", "b"))
    assert plan_of(times)[0].count("Relation") == plan_of(done)[0].count("Relation")
    assert {(r["_key"], r["seconds"]) for r in times.groupBy("_key").agg(F.sum("seconds").alias("seconds")).collect()} == {(k, 3600.0 - k) for k in range(3)}


def test_a_grade_is_reached_by_counts_and_not_by_a_rounded_share(spark):
    rows = spark.range(100_000).select(F.when(F.col("id") == 7, "x").otherwise("/1234").alias("l"))
    assert tuple(shares.compliance(rows, "l", r"/\d{3,}$").first()) == (100_000, 99_999, 100, "warning")
    assert shares.compliance(rows.where("id <> 7"), "l", r"/\d{3,}$").first()["grade"] == "ok"
    assert shares.compliance(rows.where("id < 0"), "l", r"/\d{3,}$").first()["grade"] == "failed"


def test_a_page_address_held_by_several_pages_counts_each_page_once(spark, tmp_path):
    page = "<title>cheap {}</title>"
    rows = [(1, "http://a", page.format(1)), (2, "http://a", page.format(2)), (3, "http://a", page.format(3)), (4, "http://pills", None)]
    on_disk(spark.createDataFrame(rows, "page_id long, url string, html string"), tmp_path / "pages.parquet")
    found = pages.QUERIES["keyword_hits"](spark, str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [("cheap", 3)]


def test_lots_of_one_number_stand_in_the_order_of_their_table(spark, tmp_path):
    n = 400
    part = spark.createDataFrame([(i, f"Brand#{(i * 37) % n}", "red bolt", 5) for i in range(n)], "p_partkey long, p_brand string, p_name string, p_size int")
    lines = spark.createDataFrame([(i % 100, 1, (i * 7) % n, 0.05, 1.0) for i in range(n)], "l_orderkey long, l_linenumber int, l_partkey long, l_discount double, l_extendedprice double")
    on_disk(part, tmp_path / "part.parquet")
    on_disk(lines.coalesce(1), tmp_path / "lineitem.parquet")
    found = {r["notice_key"]: r["preview"] for r in serving.QUERIES["lot_preview"](spark, str(tmp_path)).collect()}
    want = {k: " | ".join(f"1: Brand#{((i * 7) % n * 37) % n} red bolt 5" for i in range(k, n, 100)) for k in range(100)}
    assert found == {k: v if len(v) <= 100 else v[:97] + "..." for k, v in want.items()}


def test_texts_that_are_no_numbers_are_not_cast(spark):
    rows = spark.createDataFrame([(x,) for x in ("7", " 12 ", "+3", "-4", "A3", "1e3", "", "99999999999", None)], "t string")
    assert [r[0] for r in rows.select(natural_number(F.col("t"))).collect()] == [7, 12, 3, -4, None, None, None, None, None]


def test_filters_that_ask_for_the_same_meet_a_notice_once(spark):
    schema = "filter_id long, user_id long, label string, is_active boolean, f_region string, f_city string, f_tags array<string>, f_min decimal(18,2), f_max decimal(18,2)"
    rows = [(u * 2 + i, u, "x", True, "N" if i else None, None, None if i else ["A"], None, None) for u in range(50) for i in range(2)]
    filters = spark.createDataFrame(rows, schema)
    notices = spark.createDataFrame([(1, "N", "x", ["A"], 5.0), (2, "N", "x", ["B"], None), (3, "S", "x", ["A"], 5.0), (4, "S", "x", [], 5.0)], "notice_id long, region string, city string, tags array<string>, value double")
    every = match.members(filters)
    assert match.condition_matches(notices, every).count() == 4  # two conditions, two notices each
    assert match.matches(notices, filters).count() == 200
    told = {tuple(r) for r in match.notifications(notices, filters).collect()}
    assert told == {(u, n, u * 2 + (n == 2)) for u in range(50) for n in (1, 2, 3)}


def test_a_pattern_of_a_lot_is_looked_for_once(spark):
    pages_ = spark.createDataFrame(
        [("a", 1, "LOTE 1\nVEICULO BLUE WIDGET ANO 1993\nAVALIAÇÃO: 10,00"), ("b", 1, "LOTE 2 - MOTO MERCEDES-BENZ ACTROS PLACA ABC 1234 CHASSI 9BWZZZ37ZVT004251"), ("c", 1, None)],
        "doc_id string, page_no int, text string",
    )
    blocks = lots.lots_from_text(lots.join_pages(pages_))
    assert plan_of(blocks)[0].count(extract.LOT_HEAD) == 2  # number and body
    parsed = lots.parse_lots(blocks)
    got = {r.doc_id: (r.lot_no, r.brand, r.model, r.plate, r.chassis, r.model_year) for r in parsed.collect()}
    assert got == {"a": ("01", "BLUE", "WIDGET", None, None, 1993), "b": ("2", "MERCEDES-BENZ", "ACTROS", "ABC1234", "9BWZZZ37ZVT004251", None)}
    given = spark.createDataFrame([("a", 1, "1", "VEICULO BLUE WIDGET", None, "x", None)], "doc_id string, line_no int, lot_no_raw string, description_raw string, value_raw string, source_text string, given map<string,string>")
    assert plan_of(lots.parse_lots(given.repartition(2)))[0].count(extract.VEHICLE_THEN_NAME) == 2  # brand and model


def relations(df, column):
    return sum("Relation" in line and column in line for line in plan_of(df)[0].splitlines())


def test_the_report_of_a_feed_reads_its_items_once(spark):
    assert relations(pages.QUERIES["feed_report"](spark, "/root/testdata/sf0.001"), "l_orderkey") == 1


def test_keys_of_both_tables_are_counted_in_one_pass(spark):
    assert relations(quality.QUERIES["quarantine_overlap"](spark, "/root/testdata/sf0.001"), "o_orderkey") == 1
    rows = spark.createDataFrame([("a", "valid"), ("a", "draft"), ("b", "valid"), ("b", "valid"), ("c", "draft"), (None, "valid"), (None, "draft")], "k string, status string")
    assert contract.keys_routed_to_both(rows, "k").first()[0] == 1


FILTERS = "filter_id long, user_id long, label string, is_active boolean, f_region string, f_city string, f_tags array<string>, f_min decimal(18,2), f_max decimal(18,2)"


def test_a_narrow_range_is_looked_up_before_a_region(spark):
    """Filters of one region and narrow ranges: a notice meets those whose range it lies in, and not all of the region."""
    rows = [(i, i, "x", True, "N", None, None, Decimal(i * 10), Decimal(i * 10 + 5)) for i in range(400)]
    every = match.members(spark.createDataFrame(rows, FILTERS)).select("condition", *match.CONDITION)
    notices = spark.range(4000).select(F.col("id").alias("notice_id"), F.lit("N").alias("region"), F.lit("x").alias("city"), F.lit(None).cast("array<string>").alias("tags"), F.col("id").cast("double").alias("value"))
    hits = match.condition_matches(notices, every)
    assert hits.count() == 400 * 6
    plan = hits._jdf.queryExecution().analyzed()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    assert spark.sparkContext._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan).count() < 400 * 40


@pytest.mark.parametrize("kind", ["double", "decimal(15,2)"])
def test_ranges_of_all_shapes_find_what_a_nested_loop_finds(spark, kind):
    rng = random.Random(5)
    values = [None, -5.0, 0.0, 0.5, 1.0, 7.0, 7.0, 7.0, 999999.99] + [round(rng.choice([10, 1000, 1e6]) * rng.random(), 2) for _ in range(120)]
    notices = [(i, rng.choice(["N", "S", None]), rng.choice(["Alto", "BALTO", None]), rng.choice([None, [], ["A"], ["B", "A"], ["A", "A"]]), v) for i, v in enumerate(values)]
    ends = [None, Decimal("-9"), Decimal("0"), Decimal("7"), Decimal("7.01")] + [Decimal(str(v)) for v in rng.sample(values[3:], 40)]
    filters = [
        (i, i // 4, "x", rng.random() < 0.9, rng.choice(["N", "S", None, None]), rng.choice(["alt", "BA", None, None]), rng.choice([["A"], ["A", "B"], None, None]), rng.choice(ends), rng.choice(ends))
        for i in range(200)
    ]
    n = spark.createDataFrame(notices, "notice_id long, region string, city string, tags array<string>, value double").withColumn("value", F.col("value").cast(kind))

    def ok(f, m):
        v = None if m[4] is None else Decimal(str(m[4]))
        inside = v is None or ((f[7] is None or v >= f[7]) and (f[8] is None or v <= f[8]))
        return f[3] and f[4] in (None, m[1]) and (f[5] is None or f[5].upper() in (m[2] or "").upper()) and (f[6] is None or bool(set(f[6]) & set(m[3] or []))) and inside

    want = {(f[0], f[1], m[0]) for f in filters for m in notices if ok(f, m)}
    f = spark.createDataFrame(filters, FILTERS)
    got = [tuple(r) for r in match.matches(n, f).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    least = {}
    for f_id, user, m_id in want:
        least[user, m_id] = min(f_id, least.get((user, m_id), f_id))
    assert sorted(tuple(r) for r in match.notifications(n, f).collect()) == sorted((*k, v) for k, v in least.items())


def test_hits_are_grouped_by_notice_where_they_are_found(spark):
    """What users are told is folded in the task that has found it: hits are not shuffled."""
    rows = [(u * 2 + i, u, "x", True, "N" if i else None, None, None if i else ["A"], None, None) for u in range(50) for i in range(2)]
    notices = spark.range(50_000).select(F.col("id").alias("notice_id"), F.lit("N").alias("region"), F.md5(F.hex("id")).alias("city"), F.array(F.lit("A")).alias("tags"), F.rand(1).alias("value"))
    plan = match.notifications(notices, spark.createDataFrame(rows, FILTERS))._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 1 and "notice_id" in moved[0] and "profile" not in moved[0]


def test_users_of_one_wish_share_what_is_stored_about_a_notice(spark, tmp_path):
    """Hits are kept by what filters ask for; users are put to them when they are read."""
    state = notify.Matches(spark, str(tmp_path / "s"), buckets=1)
    f = spark.createDataFrame([(u, u, "x", True, "N", None, None, None, None) for u in range(300)], FILTERS)
    n = spark.range(100).select(F.col("id").alias("notice_id"), F.lit("N").alias("region"), F.lit("x").alias("city"), F.lit(None).cast("array<string>").alias("tags"), F.lit(None).cast("decimal(15,2)").alias("value"))
    assert state.change(n, f).count() == 30_000 and state.known().count() == 30_000
    stored = sum(spark.read.parquet(f"{state.shots.path}/{folder}").count() for folder in set(state.shots.newest().parts.values()))
    assert stored <= 2 * (300 + 100) + 100  # filters, notices and their keys, and one hit a notice


def test_matches_of_changes_in_any_order_are_those_of_a_plain_walk(spark, tmp_path):
    rng = random.Random(3)
    state = notify.Matches(spark, str(tmp_path / "s"), buckets=1)
    notice = "notice_id long, region string, city string, tags array<string>, value double"
    every_notice = [(i, rng.choice("NS"), rng.choice(["Alto", "Bom"]), rng.choice([None, ["A"], ["A", "B"]]), rng.choice([None, 1.0, 5.0, 9.0])) for i in range(30)]

    def wish(i):
        low = rng.choice([None, 4])
        return (i, i // 3, "x", rng.random() < 0.7, rng.choice(["N", "S", None]), rng.choice(["om", None, None]), rng.choice([["B"], None, None]), low and Decimal(low), None)

    def meets(f, m):
        return f[3] and f[4] in (None, m[1]) and (f[5] or "").upper() in m[2].upper() and (f[6] is None or bool(set(f[6]) & set(m[3] or []))) and (f[7] is None or m[4] is None or m[4] >= f[7])

    seen, states, newest, known, sent = {}, set(), {}, {}, {}
    steps = [(None, [wish(i) for i in range(9)]), (every_notice[:12], None), (every_notice[6:20], [wish(i) for i in range(6, 14)]), (None, [wish(i) for i in range(3, 12)]), (every_notice[15:], None)]
    versions = [0]
    for notices, filters in steps:
        fresh = [m for m in notices or [] if m[0] not in seen]
        changed = {f[0]: f for f in filters or [] if str(f) not in states}
        states |= {str(f) for f in filters or []}
        newest |= changed
        found = {(f[1], m[0], f[0]) for m in fresh for f in newest.values() if meets(f, m)} | {(f[1], m[0], f[0]) for m in seen.values() for f in changed.values() if meets(f, m)}
        seen |= {m[0]: m for m in fresh}
        told = {}
        for user, m, f in sorted(found):
            known[user, m] = min(f, known.get((user, m), f))
            told.setdefault((user, m), f)
        now = {k: f for k, f in told.items() if k not in sent}
        sent |= now
        got = state.change(spark.createDataFrame(notices, notice) if notices else None, spark.createDataFrame(filters, FILTERS).drop("label") if filters else None)
        assert sorted(tuple(r) for r in got.select("user_id", "notice_id", "filter_id").collect()) == sorted((*k, f) for k, f in now.items())
        versions.append(state.shots.newest().number)
    assert sorted(tuple(r) for r in state.known().collect()) == sorted((*k, f) for k, f in known.items())
    assert sorted(tuple(r) for r in state.outbox().select("user_id", "notice_id", "filter_id").collect()) == sorted((*k, f) for k, f in sent.items())
    assert versions == list(range(6)) and len(known) > len(now) > 0
