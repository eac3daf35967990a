"""Jobs on small fixtures, with brute-force answers and invariants."""

import datetime as dt
import json
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from noticelake.functions import extract, ids
from noticelake.operators import keyed, predicates, ranks
from noticelake.operators.joins import allowed_hosts, match_terms, tag_by_terms
from noticelake.plans import contract, discovery, feed, geo, health, links, lots, match, quality, stats, sync, tagging, unify
from noticelake.presets import br_notices as br
from noticelake.sources import readers, sinks
from noticelake.sources.keyed_table import KeyedTable
from noticelake.sources.snapshots import Conflict, Snapshots
from noticelake.streaming import ingest, notify

FULL = dict(
    id_interno="1", municipio="Santos", uf="SP", data_leilao="15-02-2026", pncp_url="https://pncp.gov.br/x", data_atualizacao="01-01-2026", titulo="t", descricao="d",
    orgao="o", objeto_resumido="r", tags="VEICULO, SUCATA", valor_estimado="10", leiloeiro_url="https://a.com.br", data_publicacao="01-01-2026",
)


def tmp() -> str:
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def _status(spark, **changes):
    rec = {**FULL, **changes}
    df = spark.createDataFrame([tuple(rec.values())], ", ".join(f"{k} string" for k in rec))
    return contract.validate(df).first()


def test_contract_cases(spark):
    assert _status(spark).status == "valid"
    r = _status(spark, data_leilao=None)
    assert r.status == "not_sellable" and [(e.code, e.field) for e in r.errors] == [("missing_required_field", "data_leilao")]
    r = _status(spark, data_leilao="15/02/2026")
    assert r.status == "rejected" and r.errors[0].code == "invalid_date_format"
    r = _status(spark, pncp_url="www.comprasbr.com.br")
    assert r.status == "valid" and r.normalized.pncp_url == "https://www.comprasbr.com.br" and r.errors[0].code == "url_normalized"
    assert _status(spark, pncp_url="COMEMORA").status == "rejected"
    assert _status(spark, leiloeiro_url="COMEMORA").status == "valid"
    r = _status(spark, tags="A, SEM CLASSIFICAÇÃO, B")
    assert r.status == "valid" and r.normalized.tags == "A, B"
    r = _status(spark, tags="SEM CLASSIFICAÇÃO")
    assert r.status == "not_sellable" and [e.code for e in r.errors] == ["tags_normalized", "tags_empty_after_normalization", "missing_required_field"]
    assert _status(spark, objeto_resumido=" ").status == "draft"
    only = contract.validate(spark.createDataFrame([("7",)], "id_interno string")).first()
    assert only.status == "not_sellable"


def test_route_partitions_input(spark):
    rows = [{**FULL, "id_interno": str(i), "data_leilao": d} for i, d in enumerate(["15-02-2026", None, "x", "1/1/2026"])]
    v = contract.validate(spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} string" for k in FULL)).withColumn("run_id", F.lit("r")))
    main, q = contract.route(v, "id_interno", "run_id", ["id_interno"])
    assert main.count() == 1 and q.count() == 3
    assert contract.keys_in_both(main, q, "id_interno").first()[0] == 0
    again = contract.merge_quarantine(q, q)
    assert again.count() == q.count()
    assert {r.reason_code for r in q.collect()} == {"missing_required_field", "invalid_date_format"}
    rep = quality.report(v).first()
    assert (rep.total, rep.valid_count, rep.valid_percent) == (4, 1, Decimal("25.00"))


def test_upserts(spark):
    cur = spark.createDataFrame([(1, "a", 1.0, "t0"), (2, "b", 2.0, "t0")], "k int, s string, v double, created_at string")
    new = spark.createDataFrame([(2, None, 9.0, "t1"), (3, "c", None, "t1")], "k int, s string, v double, created_at string")
    a = {r.k: tuple(r)[1:] for r in keyed.upsert_non_null(cur, new, ["k"], keep=["created_at"]).collect()}
    assert a == {1: ("a", 1.0, "t0"), 2: ("b", 9.0, "t0"), 3: ("c", None, "t1")}
    b = {r.k: tuple(r)[1:] for r in keyed.upsert_replace(cur, new, ["k"], keep=["created_at"]).collect()}
    assert b == {1: ("a", 1.0, "t0"), 2: (None, 9.0, "t0"), 3: ("c", None, "t1")}
    assert keyed.insert_if_absent(cur, new.unionByName(new), ["k"], [F.col("k")]).count() == 1
    done = ranks.capacity_brake(new, 9, 10, F.col("k"))
    assert (done.n_accepted, done.n_rejected) == (1, 1) and done.accepted.count() == 1 and done.rejected.first().k == 3
    full = ranks.capacity_brake(new, 11, 10, F.col("k"))
    assert (full.n_accepted, full.n_rejected) == (0, 2)
    with_null = spark.createDataFrame([(1,), (None,)], "x int")
    assert keyed.not_in(cur, "k", with_null, "x").count() == 0
    assert [r.k for r in keyed.not_in(cur, "k", with_null.where("x is not null"), "x").collect()] == [2]


def test_table_upsert_touches_only_its_partitions(spark):
    path = tmp() + "/t"
    sch = "k int, day string, v int, created_at string"
    sinks.upsert(spark, path, spark.createDataFrame([(1, "d1", 1, "a"), (2, "d2", 2, "a"), (5, None, 7, "a")], sch), ["k", "day"], "day")
    table = Snapshots(spark, path)
    first = table.newest()
    for _ in range(2):
        sinks.upsert(spark, path, spark.createDataFrame([(2, "d2", 5, "b"), (3, "d2", 3, "b")], sch), ["k", "day"], "day")
    now = table.newest()
    rows = sorted((r.k, r.day, r.v, r.created_at) for r in table.read().collect())
    assert rows == [(1, "d1", 1, "a"), (2, "d2", 5, "a"), (3, "d2", 3, "b"), (5, None, 7, "a")]
    assert now.number == 3 and now.parts["d1"] == first.parts["d1"] and now.parts[""] == first.parts[""] and now.parts["d2"] != first.parts["d2"]
    assert sorted(r.v for r in table.read(first).collect()) == [1, 2, 7]  # earlier versions stay as they were
    table.vacuum(keep=1)
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, 1), (2, 5), (3, 3), (5, 7)] and table.numbers() == [3]
    assert not os.path.exists(f"{path}/{first.parts['d2']}") and os.path.exists(f"{path}/{first.parts['d1']}")


def test_a_merge_that_dies_leaves_the_table_and_two_writers_cannot_both_commit(spark, monkeypatch):
    path, sch = tmp() + "/t", "k int, day string, v int, created_at string"
    sinks.upsert(spark, path, spark.createDataFrame([(1, "d1", 1, "a")], sch), ["k", "day"], "day")
    table = Snapshots(spark, path)
    base = table.newest()

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Snapshots, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            sinks.upsert(spark, path, spark.createDataFrame([(1, "d1", 9, "b")], sch), ["k", "day"], "day")
    assert table.newest() == base and table.read().first().v == 1
    table.commit(base, base.parts, {**base.facts, "by": "one"})
    with pytest.raises(Conflict):
        table.commit(base, base.parts, {**base.facts, "by": "two"})
    assert table.newest().facts["by"] == "one"


def test_known_keys_are_read_by_bucket(spark):
    shots = Snapshots(spark, tmp() + "/t")
    known = KeyedTable(shots, ["k"], buckets=16)
    batch = lambda *ks: spark.createDataFrame([(k, f"v{k}") for k in ks], "k long, v string")
    assert known.append_new(batch(*range(100), 5, 6), [F.col("v")]).count() == 100
    version = shots.newest()
    assert known.append_new(batch(*range(100)), [F.col("v")]).count() == 0 and shots.newest() == version
    for i in range(100, 112):
        assert known.append_new(batch(i, 3), [F.col("v")]).count() == 1
    assert sorted(r.k for r in known.rows().collect()) == list(range(112))
    few = batch(7)
    touched = known.touched(few)
    files = known.known(shots.newest(), touched, few).inputFiles()
    assert len(touched) == 1 and files and all(f"_part={touched[0]}/" in f for f in files)
    assert max(len(known._folders(shots.newest(), f"keys/{b}/")) for b in range(16)) <= 9
    nulls = spark.createDataFrame([(None, "a")], "k long, v string")
    assert known.append_new(nulls, [F.col("v")]).count() == 1 and known.rows(since=shots.newest().number - 1).first().v == "a"


def test_database_batches_are_loaded_once(spark):
    url, props = "jdbc:derby:memory:notices;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    sch = "k int, v string"
    load = lambda rows, batch: sinks.write_jdbc(spark.createDataFrame(rows, sch), url, "notices", ["k"], batch, props)
    stored = lambda: sorted(map(tuple, spark.read.jdbc(url, "notices", properties=props).collect()))
    assert load([(1, "a"), (2, "b")], "one") and load([(2, "c"), (3, None)], "two")
    assert stored() == [(1, "a"), (2, "c"), (3, None)]
    assert not load([(1, "z")], "one") and stored() == [(1, "a"), (2, "c"), (3, None)]
    with pytest.raises(Exception):
        sinks.write_jdbc(spark.createDataFrame([(1, "q"), (1, "r")], sch).withColumn("none", F.lit(1)), url, "notices", ["k"], "three", props)
    assert stored() == [(1, "a"), (2, "c"), (3, None)]
    assert load([(1, "y")], "three") and stored()[0] == (1, "y")


def _filter_rows(spark):
    p = [
        ("f1", "u1", "a", {"uf": "SP"}, True), ("f2", "u1", "b", {"cidade": "anto", "valor_max": "100"}, True), ("f3", "u2", "c", {"tags": ["MOTO", "SUCATA"]}, True),
        ("f4", "u3", "d", {"valor_min": "50", "valor_max": "70"}, True), ("f5", "u4", "e", {"uf": "", "cidade": "", "tags": []}, True), ("f6", "u5", "x", {"uf": "SP"}, False),
        ("f7", "u6", "g", {"cidade": "s"}, True), ("f8", "u7", "h", {"valor_min": "0.5"}, True), ("f9", "u8", "i", {"uf": "RJ", "tags": ["MOTO"], "valor_min": "1000"}, True),
    ]
    return spark.createDataFrame([(a, b, c, json.dumps(d), e) for a, b, c, d, e in p], "filter_id string, user_id string, label string, filter_params string, is_active boolean")


_NOTICES = [
    (1, "SP", "Santos", ["MOTO", "SUCATA"], 60.0), (2, "SP", "São Paulo", None, None), (3, "RJ", "Niterói", ["MOTO"], 2000.0), (4, "MG", "santo antônio", ["CARRO"], 100.0),
    (5, None, None, [], 0.25), (6, "RJ", "Rio", ["SUCATA", "MOTO"], 999.0),
]


def _brute_matches(filters):
    out = set()
    for f in filters:
        p = json.loads(f.filter_params)
        for nid, uf, city, tags, v in _NOTICES:
            lo, hi = p.get("valor_min"), p.get("valor_max")
            ok = f.is_active and (not p.get("uf") or p["uf"] == uf) and (not p.get("cidade") or p["cidade"].upper() in (city or "").upper())
            ok = ok and (not p.get("tags") or bool(set(tags or []) & set(p["tags"])))
            ok = ok and (not hi or v is None or v <= float(hi)) and (not lo or v is None or v >= float(lo))
            if ok:
                out.add((f.filter_id, nid))
    return out


def test_match_equals_nested_loop(spark):
    fr = _filter_rows(spark)
    n = spark.createDataFrame(_NOTICES, "notice_id long, region string, city string, tags array<string>, value double")
    got = [(r.filter_id, r.notice_id) for r in match.matches(n, match.read_filters(fr)).collect()]
    assert len(got) == len(set(got)) and set(got) == _brute_matches(fr.collect())
    notes = match.notifications(n, match.read_filters(fr))
    least = {}
    for f_id, n_id in _brute_matches(fr.collect()):
        user = next(f.user_id for f in fr.collect() if f.filter_id == f_id)
        least[user, n_id] = min(f_id, least.get((user, n_id), f_id))
    assert {(r.user_id, r.notice_id): r.filter_id for r in notes.collect()} == least
    assert notes.count() == notes.select("user_id", "notice_id").distinct().count()
    assert match.new_notifications(notes, notes).count() == 0


def test_terms_are_found_as_by_looking_at_all(spark):
    """The join finds what a literal table inside the scan finds, with signs and blanks in terms and texts."""
    terms = [("moto", "MOTO"), ("sucata leve", "SUCATA"), ("x", "X"), ("r-440", "CAMINHAO"), ("r 44", "R"), ("-", "SIGN"), ("ab", "AB"), ("a.b c", "ABC")]
    texts = [(1, "uma moto e sucata leve"), (2, "nada"), (3, "x motos"), (4, "lote r 440 azul"), (5, "lote r-440 azul"), (6, "a b-c ab"), (7, ""), (8, None), (9, "sucata, leve")]
    df, t = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame(terms, "term string, tag string")
    rules = {}
    for term, tag in terms:
        rules.setdefault(tag, []).append(term)
    for whole in (False, True):
        use = {g: [w for w in ws if not whole or any(c.isalnum() for c in w)] for g, ws in rules.items()}
        want = df.select("id", match_terms(F.coalesce("t", F.lit("")), use, whole).alias("tags")).collect()
        assert sorted(tag_by_terms(df, t, "t", "id", whole).select("id", "tags").collect()) == sorted(want)


def test_lots_of_odd_cells(spark):
    head = ["Lote", "Descrição", "Marca", "Modelo", "Marca"]
    rows = [head, ["1", "veiculo gm (chev onix 1.0, preto", "", "", "GM (CHEV"], ["2", "Fiat Uno Mille Ano 2010", "Fiat", "", ""], ["3", "FIAT UNO ANO 2010 PLACA ABC1234", "Other", "", "Last"], ["4", "moto CG 160, azul", "", "", ""], ["5", "abcde", "", "X-1", ""]]
    cells = spark.createDataFrame([("d", 1, 1, i, r) for i, r in enumerate(rows, 1)], "doc_id string, page_no int, table_no int, row_no int, cells array<string>")
    got = {r.lot_no: (r.brand, r.model) for r in lots.parse_lots(lots.lots_from_tables(cells)).collect()}
    assert got["1"][0] == "GM (CHEV"
    assert got["2"] == ("Fiat", "UNO MILLE") and got["3"][0] == "Last" and got["3"][1] == "UNO" and got["5"][1] == "X-1"
    assert got["4"] == ("CG", "160")


def test_extraction_is_linear(spark):
    """100 kB of the words that a rule waits for takes less than a second a row."""
    import time

    bad = ["leilão dia " * 9000, "dia leilão hasta " * 6000, "LOTE 1\n" * 14000, "realizará será realizado " * 4000, "01/02/2026 " * 9000, "hora h as " * 10000]
    df = spark.createDataFrame([(b,) for b in bad], "t string").coalesce(1)
    extraction_of = df.select(extract.auction_date(F.col("t"), F.col("t")).alias("d"), F.size(extract.lot_blocks(F.col("t"))).alias("n"))
    extraction_of.limit(1).collect()
    start = time.time()
    extraction_of.collect()
    assert time.time() - start < len(bad)


def test_dates_and_blocks_follow_their_rules(one):
    c = F.col("s")
    date = lambda t: one(extract.auction_date(F.lit(""), c), s=t)
    assert date("em 01/01/2026 o leilão, no dia marcado, 02/02/2026") == "02/02/2026"
    assert date("dia certo do leilão: 03.03.2026 e 04/04/2026") == "03/03/2026"
    assert date("05/05/2026 ocorrerá em 06/06/2026") == "06/06/2026"
    assert date("07-07-2026, às 10") == "07/07/2026" and date("07/07/2026 cedo") is None
    doc = lambda t: one(extract.auction_date(c, F.lit("")), s=t)
    assert doc("leilão dia 01/01/2019, dia 02/02/2026; hasta data: 03/03/2026") == "03/03/2026"
    assert doc("será realizado em 04/04/2019 será realizado em 05/05/2026") == "05/05/2026"
    blocks = one(extract.lot_blocks(c), s="LOTE 1\nCARRO\nLOTE 2\nMOTO\nAVALIAÇÃO: 10,00\nx AVALIAÇÃO 3\nLOTE 3\nVAN\nAVALIACAO 20,00")
    assert [(b.lot_no, b.value) for b in blocks] == [("1", "10,00"), ("3", "20,00")] and blocks[0].body.strip() == "CARRO\nLOTE 2\nMOTO"


def test_ids_need_a_lot(one):
    c = F.col("s")
    assert one(ids.listing_id("src", c, F.lit(None)), s="a") is None and one(ids.listing_id("src", c, F.lit(" ")), s="a") is None
    assert one(ids.listing_id("src", F.lit(None), c), s="7") == one(ids.listing_id("src", F.lit(""), c), s="7")
    assert one(ids.listing_id("src", F.lit("1"), c), s="7") != one(ids.listing_id("src", F.lit("1"), c, lot_first=True), s="7")
    long = "x" * 100
    assert one(ids.lot_id(F.lit("n"), F.lit("1"), c), s=long + "a") != one(ids.lot_id(F.lit("n"), F.lit("1"), c), s=long + "b")
    assert one(ids.lot_id(F.lit("n"), F.lit("1"), c, leading=100), s=long + "a") == one(ids.lot_id(F.lit("n"), F.lit("1"), c, leading=100), s=long + "b")


def test_whole_words(one):
    rules = {"GATO": ["cat"], "CASA": ["semi-reboque"]}
    assert one(match_terms(F.col("s"), rules), s="catalogo") == ["GATO"]
    assert one(match_terms(F.col("s"), rules, whole_words=True), s="catalogo") == []
    assert one(match_terms(F.col("s"), rules, whole_words=True), s="um cat, semi-reboque.") == ["CASA", "GATO"]


def test_tagging(spark):
    tax = spark.createDataFrame([("c", "Veículo", ["carro"], "VEICULO", True), ("c", "oculto", None, "X", False)], "category string, term string, synonyms array<string>, tag string, active boolean")
    df = spark.createDataFrame([(1, "VEICULO usado"), (2, "um CARRO oculto"), (3, None)], "id int, t string")
    got = {r.id: r.tags for r in tagging.tag_by_taxonomy(df, tax, ["t"], "id").collect()}
    assert got == {1: ["VEICULO"], 2: ["VEICULO"], 3: []}
    fallback = {r.id: r.tags for r in tagging.tag_by_taxonomy(df, None, ["t"], "id").collect()}
    assert "VEICULO" in fallback[1]


def test_hosts(spark):
    h = spark.createDataFrame([("a.lopes.com.br",), ("lopes.com.br",), ("xlopes.com.br",), (None,)], "host string")
    allow = spark.createDataFrame([("LOPES.com.br",)], "domain string")
    assert sorted(r.host for r in allowed_hosts(h, allow).collect()) == ["a.lopes.com.br", "lopes.com.br"]


def test_resolve_links(spark):
    t = [
        (1, "pdf_anexo", "a.pdf", 2, "visite https://www.outroleilao.com.br/x."), (1, "pdf_anexo", "a.pdf", 3, "site lopes.com.br aqui"),
        (2, "titulo_descricao", "d", 0, "www.leiloesx.com.br"), (2, "pdf_anexo", "b.pdf", 1, "contato joao@gmail.com ou www.gov.br"),
        (3, "pdf_anexo", "c.pdf", 1, "no ED.COMEMORA de hoje"), (4, "pdf_anexo", "d.pdf", 1, "nada aqui"),
    ]
    texts = spark.createDataFrame(t, "notice_id long, source string, ref string, page_no int, text string")
    allow = spark.createDataFrame([("lopes.com.br",)], "domain string")
    got = {r.notice_id: r for r in links.resolve_links(texts, allow).collect()}
    assert got[1].link == "https://www.lopes.com.br" and got[1].link_confidence == 100 and got[1].link_origin_ref == "ref:a.pdf:page=3"
    assert got[2].link == "https://www.leiloesx.com.br" and got[2].link_origin == "titulo_descricao"
    assert got[3].link is None and got[3].link_reject_reason == "tld_colado_em_palavra"
    assert 4 not in got
    marks = {r.notice_id: r.audit_result for r in links.audit_marks(spark.range(1, 5).withColumnRenamed("id", "notice_id"), links.resolve_links(texts, allow), "r", "2026-01-01").collect()}
    assert marks == {1: "found", 2: "found", 3: "no_link", 4: "no_link"}


def test_lots(spark):
    block = "LOTE 01\nFIAT UNO MILLE ANO 2010\nPLACA: ABC-1234\nCHECK LIST ok\nAVALIAÇÃO: 2.500,00\nLOTE 2\nRENAVAM\nHONDA CG 125 ANO 2012\nAVALIACAO 900,00"
    docs = spark.createDataFrame([("d1", block), ("d2", "LOTE 7 - Sucata de motor GM\nLOTE 8 - Peças diversas usadas"), ("d3", "texto")], "doc_id string, text string")
    parsed = lots.parse_lots(lots.lots_from_text(docs))
    rows = {(r.doc_id, r.lot_no): r for r in parsed.collect()}
    assert set(rows) == {("d1", "01"), ("d1", "02"), ("d2", "7"), ("d2", "8")}
    a = rows[("d1", "01")]
    assert (a.value, a.plate, a.brand, a.model, a.model_year) == (Decimal("2500.00"), "ABC1234", "FIAT", "UNO MILLE", 2010)
    assert rows[("d1", "02")].description == "HONDA CG 125 ANO 2012"
    good, bad = lots.split_lots(parsed)
    assert good.count() + bad.count() == parsed.count()
    table = [("d", 1, 1, 1, ["Lote", "Descrição do lote", "Valor"]), ("d", 1, 1, 2, ["1", "VW GOL ANO 2001", "R$ 1.000,00"]), ("d", 1, 1, 3, ["2", "", "x"])]
    t = spark.createDataFrame(table, "doc_id string, page_no int, table_no int, row_no int, cells array<string>")
    r = lots.parse_lots(lots.lots_from_tables(t)).collect()
    assert [(x.lot_no, x.brand, x.value) for x in r] == [("1", "VW", Decimal("1000.00"))]
    fam = lots.document_family(spark.createDataFrame([("d", 1, "x" * 200), ("e", 1, "x")], "doc_id string, page_no int, text string"), t)
    assert {x.doc_id: x.family for x in fam.collect()} == {"d": "PDF_TABELA_INICIO", "e": "PDF_ESCANEADO"}


def test_feed(spark):
    def item(i, **kw):
        return {"lote_id": str(i), "leilao_id": "9", "nm_titulo_lote": "Carro", "nm_cidade": "SANTOS", "nm_estado": "sp", "dt_fechamento": "2026-02-10T14:00:00Z", "vl_lanceminimo": "R$ 1.000,00", "nm_url_leiloeiro": "www.a.com.br", **kw}

    pages = [
        {"items": [item(1, anexos=[{"nm": "EDITAL", "nm_path_completo": "http://e/1"}, {"nm": "EDITAL RETIFICADO", "nm_path_completo": "http://e/2"}]), item(2, dt_fechamento=None)], "currentPage": 1},
        {"lotes": [item(3)], "page": 2}, {"data": [item(3)], "page": 3}, {"items": [item(4)], "page": 4}, {"items": [item(5), item(6, nm_titulo_lote="sucata de moto")], "currentPage": 1, "_tipo_busca": 2},
    ]
    raw = spark.createDataFrame([(json.dumps(p),) for p in pages], "value string")
    items = readers.feed_pages(raw)
    assert items.count() == 7
    out = feed.run(items, "src", "r1", "2026-01-01")
    valid = {r.lot_id: r for r in out["valid"].collect()}
    assert set(valid) == {"1", "3", "6"}
    assert valid["1"].notice_link == "http://e/2" and valid["1"].city == "Santos" and valid["1"].confidence == 90
    assert valid["1"].auctioneer_link == "https://www.a.com.br/leilao/index/leilao_id/9/lote/1"
    q = {(r.stage, r.rejection_code) for r in out["quarantine"].collect()}
    assert q == {("validation", "MISSING_DATA_LEILAO"), ("pre_filter", "CATEGORY_EXCLUDED")}
    assert len({r.listing_id for r in out["valid"].collect()}) == 3


def test_unify_rules(spark):
    n = spark.createDataFrame(
        [(1, "published", None, "p", "", "2026-05-01", " santos ", "SP"), (2, "published", "auctioneer", None, None, "2026-05-01", "X", "SP"), (3, "draft", None, "p", None, "2026-05-01", "X", "SP"), (4, "published", None, "p", "s/4", "2020-05-01", "Santos", "SP")],
        "id long, publication_status string, source_type string, portal_link string, storage_path string, d string, city string, region string",
    ).withColumn("event_at", F.to_timestamp("d")).withColumn("auctioneer_link", F.when(F.col("id") == 2, F.lit("l")))
    l = spark.createDataFrame([(9, "published", "2026-05-01", "auctioneer")], "id long, publication_status string, d string, source_type string").withColumn("event_at", F.to_timestamp("d"))
    dim = spark.createDataFrame([(1, "SANTOS", "SP", 1.0, 2.0)], "place_code int, place_name string, place_region string, latitude double, longitude double")
    u = {r.id: r for r in unify.unify(n, l, dim, "2026-01-01").collect()}
    assert set(u) == {1, 2, 4, 9}
    assert u[1].place_code == 1 and u[1].notice_link == "p" and u[1].temporal_status == "future" and u[1].source_type == "portal"
    assert u[4].notice_link == "s/4" and u[4].temporal_status == "past" and u[9].items == 1 and u[9].place_code is None


def test_search_pages_cover_everything(spark):
    from noticelake.operators.paging import listing_order, page

    df = spark.range(45).selectExpr("id", "cast(id % 3 as double) value")
    seen = [r.id for p in (1, 2, 3) for r in page(df, listing_order("value_desc"), p, 20).collect()]
    assert sorted(seen) == list(range(45)) and len(seen) == 45
    assert predicates.clamp_limit(500) == 100 and predicates.clamp_limit(None) == 50
    city = spark.createDataFrame([("a%b",), ("axb",)], "city string")
    assert city.where(predicates.contains_ci(F.col("city"), "A%")).count() == 1


def test_health_limits(spark):
    rows = [("a", "SUCCESS", 10, 8, 15.0, 1800, 0, 0), ("b", "SUCCESS", 10, 8, 15.01, 1801, 0, 0), ("c", "FAILED", 10, 0, 30.0, 1, 1, 2), ("d", "SUCCESS", 10, 5, 30.01, 1, 0, 0), ("e", "SUCCESS", 0, 0, 99.0, 1, 0, 0)]
    r = spark.createDataFrame(rows, "run_id string, status string, processed int, valid int, quarantine_percent double, duration_s int, downloads_ok int, downloads_failed int")
    got = sorted((x.run_id, x.kind, x.severity) for x in health.pipeline_alerts(r).collect())
    assert got == [
        ("b", "high_quarantine_rate", "warning"), ("b", "long_duration", "warning"), ("c", "download_failures", "warning"), ("c", "execution_failed", "critical"),
        ("c", "high_quarantine_rate", "warning"), ("c", "no_valid_records", "warning"), ("d", "high_quarantine_rate", "critical"),
    ]


def test_idle_runs_across_days(spark):
    import random

    rnd = random.Random(3)
    rows = [(f"r{i:03d}", rnd.choice(["p", "q"]), dt.datetime(2026, 1, 1) + dt.timedelta(hours=7 * i), rnd.choice([0, 0, 0, 1])) for i in range(120)]
    df = spark.createDataFrame(rows, "run_id string, pipeline string, started_at timestamp, new_rows int")
    want = set()
    for p in "pq":
        mine = [r for r in rows if r[1] == p]
        want |= {mine[i][0] for i in range(2, len(mine)) if not any(r[3] for r in mine[i - 2 : i + 1])}
    assert {r.run_id for r in health.idle_runs(df, "pipeline").collect()} == want and want


def test_geo_and_sync(spark):
    dim = spark.createDataFrame([(1, "São Paulo", "SP"), (2, "Bom Jesus", "PI"), (3, "Bom Jesus", "RN")], "place_code int, place_name string, place_region string")
    n = spark.createDataFrame([("Sao Paulo", "SP"), ("sao paulo", "XX"), ("Bom Jesus", "XX")], "city string, region string")
    c = geo.geocode_coverage(n, dim).first()
    assert (c.total, c.matched) == (3, 1)
    fixed = sorted(r.region for r in geo.region_from_dimension(n, dim, br.REGIONS).collect())
    assert fixed == ["SP", "SP", "XX"]
    raw = spark.createDataFrame([('{"id": 1, "nome": "A", "microrregiao": {"mesorregiao": {"UF": {"sigla": "sp"}}}}',), ('{"codigo_ibge": 2, "nome_municipio": "B", "uf": "RJ"}',), ('{"id": 3, "nome": "C", "regiao-imediata": {"regiao-intermediaria": {"UF": {"sigla": "MG"}}}}',)], "value string")
    assert sorted((r.place_code, r.place_region) for r in readers.municipalities(raw).collect()) == [(1, "SP"), (2, "RJ"), (3, "MG")]
    col = spark.createDataFrame([("p", "t", "d", "DETRAN-RJ", "XX", "Niterói", None, "5", "2026", "1" * 14, None, None, "1.234,56")], "portal_id string, title string, description string, agency string, region string, city string, notice_no string, seq string, year string, tax_id string, published_at timestamp, event_at timestamp, value string")
    r = sync.to_serving(col, "2026-01-01").first()
    assert (r.region, r.notice_no, r.value) == ("RJ", "5/2026", Decimal("1234.56"))


def test_reach_matches_walk(spark):
    edges = {("a", "b"), ("b", "c"), ("c", "d"), ("a", "c"), ("x", "a"), ("b", "a")}
    e = spark.createDataFrame([(s, t, "h", "h") for s, t in edges], "src string, dst string, src_host string, dst_host string")
    got = {(r.seed, r.url): r.depth for r in discovery.reach(spark.createDataFrame([("a",), ("x",)], "seed string"), e, 2).collect()}
    want = {}
    for seed in ("a", "x"):
        level = {seed}
        for depth in range(3):
            for u in level:
                want.setdefault((seed, u), depth)
            level = {t for s, t in edges if s in level}
    assert got == want
    few = discovery.reach(spark.createDataFrame([("a",)], "seed string"), e, 2, max_pages=2).collect()
    assert sorted(r.url for r in few) == ["a", "b"]


def test_readers(spark):
    d = tmp()
    with open(f"{d}/a.csv", "wb") as f:
        f.write("n,v\nSão,1\n".encode())
    with open(f"{d}/b.csv", "wb") as f:
        f.write("n,v\r\nAção,2\r\nruim\r\n".encode("latin-1") + b"\x93x\x94,3\n" + b"a,4\n" * 3000)
    numbered = []
    for size in ("64", "1000", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        numbered.append(sorted((r.n, r.v, r.line_no) for r in readers.read_csv_any_encoding(spark, f"{d}/*.csv", "n string, v int").collect()))
    assert numbered[0] == numbered[1] == numbered[2] and len(numbered[0]) == 3003
    assert {("Ação", 2, 1), ("São", 1, 1), ("“x”", 3, 3), ("a", 4, 3003)} <= set(numbered[0])
    sheet = readers.sheet_cells(spark, f"{d}/a.csv", ["n", "v"]).collect()
    assert [(c.cell, c.ref) for c in sheet] == [("São", "a.csv:row=2:col=n"), ("1", "a.csv:row=2:col=v")]
    with open(f"{d}/s.xml", "w") as f:
        f.write("<urlset><url><loc>http://a</loc><lastmod>2026-01-02</lastmod><priority>0.5</priority></url><url><loc>http://b</loc></url></urlset>")
    s = readers.read_sitemap(spark, f"{d}/s.xml")
    assert [r.loc for r in discovery.newest_first(s, 5).collect()] == ["http://a", "http://b"]
    with open(f"{d}/seeds.json", "w") as f:
        f.write(json.dumps({"categories": {"gov": {"seeds": [{"url": "http://a", "status": "confirmed"}, {"url": "b", "status": "open"}]}}}, indent=1))
    assert [tuple(r) for r in readers.read_seeds(spark, f"{d}/seeds.json").collect()] == [("gov", "http://a", "confirmed")]
    j = spark.createDataFrame([('{"numeroControlePNCP": "1", "titulo": "t", "title": ""}',), ('{"titulo": "sem id"}',)], "value string")
    n = readers.notices_from_json(j).collect()
    assert len(n) == 1 and n[0].title == "t" and n[0].city == "Diversos" and n[0].region == "BR"
    assert readers.list_files(spark, d).count() == 4
    cells = readers.cells(spark.createDataFrame([("www.a.com.br", None, 1)], "x string, y string, line_no int"), "plan").collect()
    assert [(c.cell, c.ref) for c in cells] == [("www.a.com.br", "plan:row=2:col=x")]


def test_unread(spark):
    t = lambda h: dt.datetime(2026, 1, 1, h)
    n = spark.createDataFrame([(1, "u", t(1)), (2, "u", t(2)), (3, "u", t(3)), (4, "v", t(1))], "notification_id long, user_id string, created_at timestamp")
    r = spark.createDataFrame([("u", 3, t(5)), ("u", None, t(1))], "user_id string, notification_id long, read_at timestamp")
    assert sorted(x.notification_id for x in match.unread(n, r).collect()) == [2, 4]
    assert {x.user_id: x.unread for x in match.unread_count(match.unread(n, r)).collect()} == {"u": 1, "v": 1}


def test_stream_ingest_is_idempotent(spark):
    src, cp = tmp(), tmp()
    out = KeyedTable(Snapshots(spark, tmp() + "/out"), ["k"])
    df = spark.createDataFrame([(i % 5, dt.datetime(2026, 1, 1)) for i in range(10)], "k int, at timestamp")
    df.coalesce(1).write.mode("append").parquet(src)

    def run(checkpoint):
        s = ingest.read_landing(spark, src, "k int, at timestamp")
        ingest.incremental_ingest(s, out, checkpoint, lambda: [F.col("at")]).awaitTermination(120)

    run(cp)
    assert out.rows().count() == 5
    run(tmp())  # a lost checkpoint replays everything
    assert out.rows().count() == 5
    spark.createDataFrame([(7, dt.datetime(2026, 1, 2))], "k int, at timestamp").write.mode("append").parquet(src)
    run(cp)
    assert sorted(r.k for r in out.rows().collect()) == [0, 1, 2, 3, 4, 7]


def test_stream_notifications_equal_batch(spark):
    """Notices and filters in any order; a lost checkpoint sends nothing again."""
    notices, filters = tmp(), tmp()
    sch = "notice_id long, region string, city string, tags array<string>, value double"
    f = match.read_filters(_filter_rows(spark)).select(*notify.FILTER)
    state = notify.Matches(spark, tmp() + "/s", buckets=2)

    def run(checkpoint):
        notify.notify_changes(ingest.read_landing(spark, notices, sch), ingest.read_landing(spark, filters, f.schema), state, checkpoint).awaitTermination(300)

    cp = tmp()
    for part, which in ((_NOTICES[:3], "filter_id < 'f5'"), (_NOTICES[3:], "filter_id >= 'f5'")):
        spark.createDataFrame(part, sch).coalesce(1).write.mode("append").parquet(notices)
        f.where(which).coalesce(1).write.mode("append").parquet(filters)
        run(cp)
    version = state.shots.newest()
    run(tmp())
    assert state.shots.newest() == version
    n = spark.createDataFrame(_NOTICES, sch)
    want = sorted((r.user_id, r.notice_id, r.filter_id) for r in match.notifications(n, match.read_filters(_filter_rows(spark))).collect())
    assert sorted((r.user_id, r.notice_id, r.filter_id) for r in state.known().collect()) == want
    assert sorted((r.user_id, r.notice_id) for r in state.outbox().collect()) == [w[:2] for w in want]
    # A changed filter meets the notices stored before; what was told is not told again.
    change = f.where("filter_id = 'f6'").withColumn("is_active", F.lit(True))
    assert sorted((r.user_id, r.notice_id) for r in state.change(None, change).collect()) == [("u5", 1), ("u5", 2)]
    assert state.change(None, change).count() == 0 and state.outbox(since=version.number).count() == 2


def test_stream_dedup(spark):
    src, cp, out = tmp(), tmp(), tmp() + "/o"
    spark.createDataFrame([(1, dt.datetime(2026, 1, 1)), (1, dt.datetime(2026, 1, 1)), (2, dt.datetime(2026, 1, 1))], "k int, at timestamp").write.mode("append").parquet(src)
    s = ingest.unique_in_session(ingest.read_landing(spark, src, "k int, at timestamp"), ["k"], "at")
    s.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.read.parquet(out).count() == 2


def test_alert_stream(spark):
    src, out = tmp(), KeyedTable(Snapshots(spark, tmp() + "/o"), ["run_id", "kind"], buckets=2)
    sch = "run_id string, status string, processed int, valid int, quarantine_percent double, duration_s int, downloads_ok int, downloads_failed int"
    spark.createDataFrame([("c", "FAILED", 10, 5, 1.0, 1, 0, 0)], sch).write.mode("append").parquet(src)
    for _ in range(2):
        notify.alert_on_runs(ingest.read_landing(spark, src, sch), out, tmp()).awaitTermination(120)
    assert [(r.run_id, r.kind) for r in out.rows().collect()] == [("c", "execution_failed")]


def test_idle_rule_in_the_stream(spark):
    """Runs without new rows in a row are told by the stream, with the earlier runs out of the history."""
    src, past, out = tmp(), Snapshots(spark, tmp() + "/h"), KeyedTable(Snapshots(spark, tmp() + "/o"), ["run_id", "kind"], buckets=2)
    sch = (
        "run_id string, pipeline string, started_at timestamp, new_rows long, status string, processed int, valid int, quarantine_percent double, duration_s int, downloads_ok int, downloads_failed int"
    )
    n = br.IDLE_RUNS

    def rows(first, last):
        return [(f"r{i:02d}", "p", dt.datetime(2026, 1, 1, i), 0, "SUCCESS", 10, 10, 0.0, 1, 1, 0) for i in range(first, last)]

    cp = tmp()
    for first, last in ((0, n + 3), (n + 3, n + 4)):
        spark.createDataFrame(rows(first, last), sch).coalesce(1).write.mode("append").parquet(src)
        notify.alert_on_runs(ingest.read_landing(spark, src, sch), out, cp, group="pipeline", history=past).awaitTermination(120)
    told = sorted(r.run_id for r in out.rows().where("kind = 'no_new_rows'").collect())
    assert told == [f"r{i:02d}" for i in range(n - 1, n + 4)]
    assert past.read().count() == n - 1  # nothing older is kept or read


def test_long_record_ids_stay_apart(spark):
    long = "k" * 300
    recs = [dict(FULL, id_interno=long + end, titulo="") for end in "ab"]
    rows = spark.createDataFrame([tuple(r.values()) for r in recs], ", ".join(f"{k} string" for k in recs[0]))
    bad = contract.route(contract.validate(rows), "id_interno", "run", ["id_interno"])[1]
    assert bad.select("record_id").distinct().count() == bad.count()


def test_daily_summary_counts_add_up(spark):
    df = spark.createDataFrame([("d1", "SP", "A", 1.0), ("d1", "RJ", None, 2.0), ("d2", "SP", "A", 3.0)], "day string, region string, modality string, value double")
    s = {r.day: r for r in stats.daily_summary(df, F.col("day"), "region", "modality", "value", {"v": F.col("value") > 1}).collect()}
    assert s["d1"].by_region == {"RJ": 1, "SP": 1} and s["d1"].by_modality == {"A": 1, "NULL": 1} and s["d2"].total == 1
