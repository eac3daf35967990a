"""Column functions on literal input."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from noticelake.functions import arrays, classify, dates, extract, ids, money, regions, scores, text, urls
from noticelake.presets import br_notices as br

C = F.col("s")


@pytest.mark.parametrize("raw,want", [("R$ 22.500,00", "22500.00"), ("R$ 15.000", "15000.00"), ("5000,00", "5000.00"), ("$22,500.00", "22500.00"), ("A DEFINIR", None), ("", None), (None, None), ("1234.5", "1234.50")])
def test_parse_money(one, raw, want):
    assert one(money.parse_money(C), s=raw) == (Decimal(want) if want else None)


@pytest.mark.parametrize("raw,want", [("R$ 1.234,56", "1234.56"), ("1.000.000,00", "1000000.00"), ("99,99", "99.99"), ("1234.56", "123456.00"), ("N/D", None)])
def test_parse_br_money(one, raw, want):
    assert one(money.parse_br_money(C), s=raw) == (Decimal(want) if want else None)


@pytest.mark.parametrize("v,want", [(1000.0, "R$ 1.000,00"), (1234.56, "R$ 1.234,56"), (1000000.0, "R$ 1.000.000,00"), (0.0, "N/D"), (float("nan"), "N/D")])
def test_format_money(one, v, want):
    assert one(money.format_br_money(C), s=v) == want


@pytest.mark.parametrize("raw,want", [("2026-01-15", "15/01/2026"), ("2026-01-15T10:30:00", "15/01/2026"), ("15-01-2026", "15/01/2026"), ("15.01.2026", "15/01/2026"), ("", "N/D"), (None, "N/D")])
def test_to_br(one, raw, want):
    assert one(dates.to_br_text(C), s=raw) == want


@pytest.mark.parametrize("raw,want", [("15/01/2026", "2026-01-15"), ("5/1/2026", "2026-01-05"), ("15/01/2026 14:30", "2026-01-15T14:30:00"), ("N/D", None), ("15-01-2026", "2026-01-15")])
def test_to_iso(one, raw, want):
    assert one(dates.to_iso_text(C), s=raw) == want


@pytest.mark.parametrize("raw,want", [("1-2-2026", "01-02-2026"), ("31-02-2026", None), ("15/02/2026", None), ("2026-02-15", None)])
def test_contract_date(one, raw, want):
    assert one(dates.contract_date(C), s=raw) == want


def test_closing_time_ignores_written_zone(one):
    shown = F.date_format(dates.local_closing_time(C), "yyyy-MM-dd HH:mm")
    assert one(shown, s="2026-02-10T14:00:00Z") == "2026-02-10 17:00"
    assert one(shown, s="2026-02-10T14:00:00-03:00") == "2026-02-10 17:00"
    assert one(shown, s="bad") is None


def test_text(one):
    assert one(text.collapse_space(C), s=" a  b \n c ") == "a b c"
    assert one(text.fold_accents(C), s="LEILÃO Ônibus ção") == "leilao onibus cao"
    assert one(text.repair_mojibake(C), s="SÃ£o Paulo") == "São Paulo"
    assert one(text.repair_mojibake(C), s="São Paulo €") == "São Paulo €"
    assert one(text.title_case(C), s="SANTA-CRUZ d'oeste") == "Santa-Cruz D'Oeste"
    assert one(text.place_title_case(C), s="SÃO JOÃO DA BOA VISTA") == "São João da Boa Vista"
    assert one(text.strip_html(C), s="<p>Bem&nbsp;<b>um</b></p><script>x</script>") == "Bem um"
    assert one(text.safe_name(C), s="Edital nº 1/2026 - Ônibus") == "Edital_n_12026_Onibus"
    assert one(text.contains_any(F.lower(C), ("moto", "carro")), s="Um CARRO") is True
    assert one(text.contains_any(C, ("moto",)), s=None) is False
    assert one(text.matching_words(C, ("b", "z", "a")), s="abc") == ["b", "a"]
    assert one(text.context_snippet(C, F.lit("x.com")), s="antes\ndo x.com depois") == "antes do x.com depois"
    assert one(text.head_tail(C, 6, 2, 2, "..."), s="abcdefgh") == "ab...gh"


@pytest.mark.parametrize("raw,want", [("  LOTE 01  ", "01"), ("Item 45", "45"), ("N. 67", "67"), ("Nº 89", "89")])
def test_lot_number(one, raw, want):
    assert one(text.lot_number(C), s=raw) == want


def test_urls(one):
    n = urls.normalize(C, br.KNOWN_TLDS)
    assert one(n, s="www.exemplo.com.") == "https://www.exemplo.com"
    assert one(n, s="http://exemplo.com") == "http://exemplo.com"
    assert one(n, s="https://www.eckert.com.br)") == "https://www.eckert.com.br"
    assert one(n, s="exemplo.com.br") == "https://exemplo.com.br"
    assert one(n, s="texto") is None
    assert one(urls.is_contract_url(C), s="https://lopes.net.br/x") is True
    assert one(urls.is_contract_url(C), s="https://10.0.0.1/x") is False
    assert one(urls.host_suffixes(C), s="a.b.c") == ["a.b.c", "b.c", "c"]
    a = urls.absolute(F.lit("https://e.com/dir/page"), C)
    assert [one(a, s=x) for x in ("/lote/1", "f.html", "//c.com/x", "https://d.com", "#top", "mailto:x@y")] == [
        "https://e.com/lote/1", "https://e.com/dir/f.html", "https://c.com/x", "https://d.com", None, None]
    assert one(urls.link_from_notice_id(C, br.NOTICE_LINK_BASE), s="18188243000160-1-000161/2025").endswith("/18188243000160/2025/161")
    assert one(urls.correct_host(C, br.HOST_CORRECTIONS), s="https://lanceleiloes.com/a") == "https://www.lanceleiloes.com.br/a"
    assert one(urls.region_of_host(C, br.REGIONS), s="www.detran.sp.gov.br") == "SP"
    assert one(urls.name_from_host(C), s="lopesleiloes.net.br") == "Lopes"
    assert one(urls.agency_url(C, br.AGENCY_URLS), s="Receita Federal do Brasil") == br.AGENCY_URLS[0][1]


@pytest.mark.parametrize("raw,allowed,want", [("https://a.com", "y", (True, 100, None)), ("http://x.com", None, (True, 80, None)), ("www.x.com", None, (True, 60, None)), ("ED.COMEMORA", None, (False, 0, "tld_colado_em_palavra")), ("texto", None, (False, 0, "sem_prefixo_ou_whitelist")), ("", None, (False, 0, "candidato_vazio"))])
def test_link_gate(one, raw, allowed, want):
    assert tuple(one(urls.link_gate(C, F.col("a").isNotNull(), br.GLUED_TLD), s=raw, a=allowed)) == want


def test_pick_lot_url(one):
    pick = urls.pick_lot_url([("api", C), ("base", F.lit("https://e.com"))], F.col("f"), F.lit("missing"))
    assert one(pick, s="https://e.com/l/1", f=None)["method"] == "api"
    assert tuple(one(pick, s=None, f="https://e.com/leilao/1")) == ("https://e.com/leilao/1", True, "constructed_validated", None)
    assert one(pick, s="https://e.com/", f=None)["error"] == "missing"


def test_regions(one):
    r = regions.repair_region(C, F.col("c"), F.col("a"), br.REGIONS, br.REGION_NAMES, br.FEDERAL_WORDS, "DF")
    assert one(r, s="sp", c="", a="") == "SP"
    assert one(r, s="XX", c="Santos/SP", a="") == "SP"
    assert one(r, s="XX", c="Campinas", a="DETRAN MG sede") == "MG"
    assert one(r, s="XX", c="Interior", a="Governo da Paraíba") == "PB"
    assert one(r, s="XX", c="Interior", a="Mato Grosso do Sul") == "MS"
    assert one(r, s=None, c=None, a="Ministério X") == "DF"


def test_arrays(one):
    assert one(arrays.tags_from_text(C), s=" A, ,B ,") == ["A", "B"]
    assert one(arrays.without_tags(C, br.FORBIDDEN_TAGS), s=["SYNC", "carro", "Leilão"]) == ["carro"]
    assert one(arrays.tags_by_words(C, {"B": ["x"], "A": ["y", "z"]}, "N"), s="xz") == ["A", "B"]
    assert one(arrays.tags_by_words(C, {"B": ["x"]}, "N"), s="q") == ["N"]
    assert one(arrays.overlap(C, F.col("t")), s=["a", None], t=["a"]) is True
    assert one(arrays.overlap(C, F.col("t")), s=[None], t=["a"]) is False
    assert one(arrays.tag_class(C), s=["sucata leve"]) == "sucata"


def test_scores(one):
    s = scores.weighted_terms(F.lower(C), br.RELEVANCE_WEIGHTS, 50)
    assert one(s, s="") == 50
    assert one(s, s="SUCATA") == one(s, s="sucata") == 70
    assert one(s, s="credenciamento imóvel terreno") == 0
    assert one(s, s="sucata inservível veículo leilão detran alienação") == 100


def test_vehicle_fields(one):
    t = "FIAT/UNO MILLE ANO 2010/2011 PLACA ABC1D23 CHASSI 9BD15822786123456 RENAVAM 123456789"
    assert one(extract.plate(C, br.NOT_A_PLATE), s=t) == "ABC1D23"
    assert one(extract.plate(C, br.NOT_A_PLATE), s="PLACA: ABC-1234") == "ABC1234"
    assert one(extract.plate(C, br.NOT_A_PLATE), s="ANO 2010 COR 1234") is None
    assert one(extract.chassis(C), s=t) == "9BD15822786123456"
    assert one(extract.renavam(C), s=t) == "00123456789"
    assert one(extract.model_year(C), s=t) == 2010
    assert one(extract.brand(C, br.BRANDS), s=t) == "FIAT"
    assert one(extract.brand(C, br.BRANDS), s="VW GOL MERCEDES-BENZ") == "MERCEDES-BENZ"
    assert one(extract.model(C, extract.brand(C, br.BRANDS)), s=t) == "UNO MILLE"
    assert one(extract.short_model_year(C), s="13/14") == 2014


@pytest.mark.parametrize("t,want", [("LOTE 1 x LOTE 2 y LOTE 3", 3), ("LOTE 1 LOTE 2 item 9", 2), ("Total de 15 lotes", 15), ("nada", None)])
def test_item_count(one, t, want):
    assert one(extract.item_count(C), s=t) == want


def test_notice_fields(one):
    assert one(extract.notice_number(C), s="EDITAL Nº 12/2026 do órgão") == "12/2026"
    assert one(extract.auction_date(F.lit(""), C), s="O leilão será no dia 15/02/2026 às 10h") == "15/02/2026"
    assert one(extract.auction_date(C, F.lit("")), s="Data do leilão: 03/03/2026") == "03/03/2026"
    assert one(extract.auctioneer_name(C), s="Leiloeiro Oficial: João da Silva - Matrícula 1") in ("João da Silva", "João da Silva Matrícula")
    assert one(extract.estimated_value(C), s="Valor: R$ 1.500,00") == Decimal("1500.00")
    found = one(extract.urls(C), s="veja www.a.com.br, http://b.net.br/x e www.a.com.br. c.leilao.br")
    assert found == ["https://www.a.com.br", "http://b.net.br/x", "https://c.leilao.br"]


def test_ids(one):
    i = ids.lot_id(F.col("n"), F.col("l"), C)
    a = one(i, n=1, l="01", s="FIAT UNO")
    assert len(a) == 64 and a == one(i, n=1, l="01", s="FIAT UNO")
    assert len({a, one(i, n=2, l="01", s="FIAT UNO"), one(i, n=1, l="02", s="FIAT UNO")}) == 3
    assert one(ids.listing_id("src", F.lit(None), C), s="7") == one(ids.listing_id("src", F.lit(None), C), s="7")


def test_classes(one):
    lab = ("H", "E", "P")
    assert one(classify.modality(C, br.ONLINE_WORDS, br.ONSITE_WORDS, lab), s="leilão online na sede") == "H"
    assert one(classify.reconcile_modality(C, F.col("t"), lab), s="Presencial", t="leilão online") == "E"
    assert one(classify.reconcile_modality(C, F.col("t"), lab), s="Leilão - Eletrônico", t="presencial") == "H"
    assert one(classify.feed_prefilter(F.lit(2), C, "sucata", br.FEED_VEHICLE_WORDS), s="sucata de moto") is None
    assert one(classify.feed_prefilter(F.lit(2), C, "sucata", br.FEED_VEHICLE_WORDS), s="sucata de ferro") == "CATEGORY_EXCLUDED"
    assert one(classify.feed_prefilter(F.lit(3), C, "sucata", br.FEED_VEHICLE_WORDS), s="x") == "TIPO_3"
    assert one(classify.file_type(C, F.col("b")), s=None, b=b"%PDF-1.4") == ".pdf"
    assert one(classify.file_type(C, F.col("b")), s=None, b=b"PK\x03\x04....xl/work") == ".xlsx"
    assert one(classify.file_type(C, F.col("b")), s="text/csv; charset=x", b=b"") == ".csv"
    assert one(classify.column_role(C, br.COLUMN_ROLES), s="Descrição do lote") == "descricao"
    assert one(classify.column_role(C, br.COLUMN_ROLES), s="Lote") == "numero"
    assert one(classify.is_vehicle_category(F.lit(None).cast("int"), F.lit(""), F.lower(C), br.FEED_CATEGORY_INCLUDE, br.FEED_CATEGORY_EXCLUDE), s="Carro na fazenda") is False
