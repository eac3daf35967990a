"""Fields read out of text: cascades of patterns, first hit wins.

The patterns are fixed values. All of them run over the whole text; ``window``
limits a function to a leading part where a caller wants that behaviour.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.dates import to_br_text
from noticelake.functions.money import parse_money
from noticelake.functions.text import collapse_space, contains_any, first_match, let

# ---------------------------------------------------------------- fixed patterns
NOTICE_NUMBER = (
    r"(?i)edital\s*[nº°.]+\s*([0-9]+(?:/[0-9]+)?(?:/[0-9]{4})?)",
    r"(?iu)edital\s+de\s+leil[ãa]o\s*[nº°.]*\s*([0-9]+(?:/[0-9]+)?(?:/[0-9]{4})?)",
    r"(?i)processo\s*[nº°.]+\s*([0-9]+(?:/[0-9]+)?(?:/[0-9]{4})?)",
)
DATE = r"(\d{1,2}[/.-]\d{1,2}[/.-]20\d{2})"
AUCTION_WORD, DAY_WORD = r"(?iu)leil[ãa]o", r"(?iu)dia"
HELD_WORD = r"(?iu)realizar[aá]|ocorrer[aá]"
HOUR_AFTER = r"(?iu)(?:às|as|hora|h)\s*\d{1,2}"
DATE_NEXT_TO_WORDS = (
    r"(?iu)data\s*(?:do|de)\s*leil[ãa]o[:\s]*(\d{1,2}[/.-]\d{1,2}[/.-]20\d{2})",
    r"(?iu)(\d{1,2}[/.-]\d{1,2}[/.-]20\d{2})[,\s]*(?:às|as|[àa]s|hora)[:\s]*\d{1,2}",
    r"(?iu)dia\s*(\d{1,2}[/.-]\d{1,2}[/.-]20\d{2})\s*[àa]s?\s*\d{1,2}",
)
#: An announcing word or a date that may follow it; the dates are taken that come after such a word.
DATE_AFTER_EVENT = r"(?iu)leil[ãa]o|hasta|pregão|(?:dia|data)[:\s]*\d{1,2}[/.-]\d{1,2}[/.-]20\d{2}"
DATE_AFTER_HELD = r"(?iu)ser[aá]\s*realizado|\d{1,2}[/.-]\d{1,2}[/.-]20\d{2}"
VALUE = r"(?iu)(?:valor|lance|mínimo|avaliação|avaliacao|estimado)[:\s]*R?\$?\s*([\d.,]+)"
ITEM_COUNT = (
    r"(?iu)total\s+de\s+(\d+)\s+(?:lotes?|itens?|veículos?|bens?)",
    r"(?iu)(\d+)\s*\([a-záéíóúâêîôû\s]+\)\s+(?:lotes?|itens?|veículos?)",
    r"(?iu)composto\s+por\s+(\d+)\s+(?:lotes?|itens?|veículos?)",
    r"(?iu)contendo\s+(\d+)\s+(?:lotes?|itens?|veículos?)",
    r"(?iu)(\d+)\s+(?:lotes?|itens?)\s+disponíveis",
    r"(?iu)dividido\s+em\s+(\d+)\s+(?:lotes?|itens?)",
    r"(?iu)lote\s+\d+\s+(?:ao?|até)\s+(?:lote\s+)?(\d+)",
    r"(?iu)lotes?\s+\d+\s+a\s+(\d+)",
    r"(?iu)são\s+(\d+)\s+(?:lotes?|itens?|veículos?)",
    r"(?iu)quantidade[:\s]+(\d+)\s*(?:lotes?|itens?|veículos?)?",
)
LOT_NUMBER = r"(?i)\blote\s*(?:n[ºo°]?\s*)?(\d+)"
ITEM_NUMBER = r"(?i)\bitem\s*(?:n[ºo°]?\s*)?(\d+)"
_NAME = r"([A-ZÀ-Ú][a-zà-ú]+(?:\s+[A-ZÀ-Ú][a-zà-ú]+){1,5})"
_ROLE = r"[Ll]eiloeiro(?:a)?(?:\s+[Oo]ficial|\s+[Pp]úblico)?[:\s]+"
AUCTIONEER = (
    rf"{_ROLE}{_NAME}\s*[-–]\s*[Mm]atrícula",
    rf"{_ROLE}{_NAME}\s*,?\s*(?:inscrit[oa]|CPF|matrícula)",
    rf"(?:conduzido|realizado|presidido)\s+(?:pelo|pela)\s+(?:leiloeiro|leiloeira)(?:\s+oficial)?\s+{_NAME}",
    rf"[Ll]eiloeiro(?:a)?\s+designad[oa][:\s]+{_NAME}",
    rf"{_ROLE}([A-ZÀ-Ú][a-zà-ú]+(?:\s+(?:de\s+|da\s+|do\s+|dos\s+|das\s+)?[A-ZÀ-Ú][a-zà-ú]+){{1,5}})",
    r"[Ll]eiloeiro(?:a)?[:\s]*([A-ZÀ-Ú][a-zà-ú]+(?:\s+[A-ZÀ-Ú][a-zà-ú]+){1,4})",
)
OBJECT = (
    r"(?isu)(?:do\s+)?objeto\s*(?:da\s+licita[çc][ãa]o)?[:\s]*(.{10,500}?)(?:\n\n|\d+\.\s|$)",
    r"(?isu)objeto[:\s]+(.{10,500}?)(?:\n\n|\d+\.\s|$)",
)
DESCRIPTION = (
    r"(?isu)(?:descri[çc][ãa]o|da\s+licita[çc][ãa]o|do\s+edital)[:\s]*(.{50,500}?)(?:\n\n|\d+\.\s|$)",
    r"(?isu)(?:torna\s+p[úu]blico|comunica)[:\s]*(.{50,500}?)(?:\n\n|\d+\.\s|$)",
)
URL_ANY = (
    r"(?iu)((?:https?://)?(?:www\.)?[\w\-.]+(?:\.leilao\.br|\.com\.br|\.com|\.org\.br|\.gov\.br|\.net\.br|\.net|\.leil[aã]o)"
    r"(?:/[\w\-./?%&=~#]*)?)"
)
URL_HTTP = r"(?i)(https?://[^\s<>\"{}|\\^`\[\]]+)"
URL_WWW = r"(?i)((?<![a-zA-Z0-9])www\.[a-zA-Z0-9][^\s<>\"{}|\\^`\[\]]*)"


def _window(c: Column, window: int | None) -> Column:
    return F.substring(c, 1, window) if window else c


def notice_number(c: Column) -> Column:
    return F.regexp_replace(first_match(c, NOTICE_NUMBER), r"\s+", "")


def _after(c: Column, at: Column, length: Column | int) -> Column:
    return F.substring(c, at + length, F.length(c))


def _described_date(c: Column) -> list[Column]:
    """Dates of a description by three rules. Each looks for words and dates on their own, so the work is
    in proportion to the text: a rule's first word leaves the most text behind it, later ones can't find more."""
    auction, day = F.regexp_instr(c, F.lit(AUCTION_WORD)), F.regexp_instr(c, F.lit(DAY_WORD))
    both = F.when((auction > 0) & (day > 0), _after(c, F.greatest(auction + 6, day + 3), 0))
    held = F.regexp_instr(c, F.lit(HELD_WORD))
    later = F.when(held > 0, _after(c, held, F.length(F.regexp_extract(c, HELD_WORD, 0))))
    at = F.regexp_instr(c, F.lit(DATE))
    shown = F.regexp_extract(c, DATE, 1)
    timed = F.when((at > 0) & _after(c, at, F.length(shown)).rlike(HOUR_AFTER), shown)
    return [F.regexp_extract(both, DATE, 1), F.regexp_extract(later, DATE, 1), timed]


def _dates_after(c: Column, words_and_dates: str) -> Column:
    """Dates that follow an announcing word, each word giving one date at most; one pass over the text."""
    zero = F.struct(F.lit(False).alias("armed"), F.array().cast("array<string>").alias("dates"))

    def step(acc: Column, token: Column) -> Column:
        date = F.regexp_extract(token, DATE, 1)
        is_date = F.length(date) > 0
        dates = F.when(is_date & acc["armed"], F.concat(acc["dates"], F.array(date))).otherwise(acc["dates"])
        return F.struct((~is_date).alias("armed"), dates.alias("dates"))

    return F.aggregate(F.regexp_extract_all(c, F.lit(words_and_dates), F.lit(0)), zero, step, lambda acc: acc["dates"])


def auction_date(document: Column, description: Column, first_year: int = 2020, window: int | None = None) -> Column:
    """``dd/MM/yyyy`` from the description, else from the document with a year from ``first_year`` on."""
    def usable(date: Column) -> Column:
        return let(to_br_text(date), lambda shown: F.when(shown != "N/D", shown))

    def from_document(dates: Column) -> Column:
        shown = F.transform(dates, lambda d: to_br_text(d))
        return F.get(F.filter(shown, lambda d: (d != "N/D") & (F.substring(d, 7, 4) >= str(first_year))), F.lit(0))

    text = _window(document, window)
    near = [F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in DATE_NEXT_TO_WORDS]
    in_order = [near[0], _dates_after(text, DATE_AFTER_EVENT), _dates_after(text, DATE_AFTER_HELD), near[1], near[2]]
    return F.coalesce(*[usable(d) for d in _described_date(_window(description, window))], *[from_document(d) for d in in_order])


def estimated_value(c: Column, window: int | None = None) -> Column:
    digits = F.nullif(F.regexp_extract(_window(c, window), VALUE, 1), F.lit(""))
    return F.translate(F.replace(digits, F.lit("."), F.lit("")), ",", ".").try_cast("decimal(18,2)")


def item_count(c: Column, window: int | None = None) -> Column:
    """Stated count in 1..9999, else highest lot number, else highest item number, else mentions of lots."""
    t = _window(c, window)

    def stated(p: str) -> Column:
        n = F.nullif(F.regexp_extract(t, p, 1), F.lit("")).try_cast("int")
        return let(n, lambda v: F.when(v.between(1, 9999), v))

    def highest(p: str) -> Column:
        n = F.array_max(F.transform(F.regexp_extract_all(t, F.lit(p), 1), lambda s: s.try_cast("int")))
        return let(n, lambda v: F.when(v >= 1, v))

    mentions = F.regexp_count(t, F.lit(r"\b[Ll]ote\b"))
    return F.coalesce(*[stated(p) for p in ITEM_COUNT], highest(LOT_NUMBER), highest(ITEM_NUMBER), F.when(mentions >= 2, mentions))


def auctioneer_name(c: Column, window: int | None = None) -> Column:
    t = _window(c, window)

    def usable(p: str) -> Column:
        def judged(name: Column) -> Column:
            cut = F.trim(F.regexp_replace(name, r"\s*[-–,].*$", ""))
            ok = (F.size(F.split(name, r"\s+")) >= 2) & (F.length(name) < 80) & (F.length(cut) >= 5)
            return F.when(ok, cut)

        return let(F.nullif(F.trim(F.regexp_extract(t, p, 1)), F.lit("")), judged)

    return F.coalesce(*[usable(p) for p in AUCTIONEER])


def object_summary(c: Column, max_len: int = 500) -> Column:
    found = first_match(F.trim(c), OBJECT)
    from noticelake.functions.text import first_sentence

    return F.coalesce(F.substring(collapse_space(found), 1, max_len), first_sentence(c, 20, max_len))


def long_description(c: Column, max_len: int = 500) -> Column:
    from noticelake.functions.text import first_long_lines

    found = F.substring(collapse_space(first_match(c, DESCRIPTION)), 1, max_len)
    return F.when(F.length(c) >= 50, F.coalesce(found, first_long_lines(c)))


def urls(c: Column, pattern: str = URL_ANY) -> Column:
    """Distinct URLs of a text in order of appearance, with a scheme and without trailing punctuation."""
    def tidy(u: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(u, r"\s+", ""), r"[.,;:)>\"']+$", "")
        return F.when(bare.rlike(r"(?i)^https?://"), bare).otherwise(F.concat(F.lit("https://"), bare))

    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(c, F.lit(pattern), 1), tidy), lambda u: F.length(u) > 10))


# ---------------------------------------------------------------- vehicle fields
def _some(found: Column) -> Column:
    """``found``, NULL when empty. In a branch of a condition ``nullif`` would look for it twice."""
    return let(found, lambda x: F.when(x != "", x))


def _told(t: Column, word: str, pattern: str) -> Column:
    """What a pattern finds that asks for ``word``: texts without the word are not put to it."""
    return F.when(F.contains(t, F.lit(word)), _some(F.regexp_extract(t, pattern, 1)))


def plate(c: Column, not_plates: Sequence[str]) -> Column:
    """After the word PLACA (old, then new form), else a guarded stand-alone plate."""
    t = F.upper(c)

    guard = "|".join(not_plates)
    found = F.coalesce(
        _told(t, "PLACA", r"PLACA[:\s]+([A-Z]{3}\s*-?\s*\d{4})\b"),
        _told(t, "PLACA", r"PLACA[:\s]+([A-Z]{3}\d[A-Z]\d{2})\b"),
        # The shape is looked at before the words that are no plates.
        _some(F.regexp_extract(t, rf"(?=[A-Z]{{3}}\s*-?\s*\d{{4}})\b(?!{guard})([A-Z]{{3}}\s*-?\s*\d{{4}})\b", 1)),
    )
    return F.regexp_replace(found, r"[\s-]", "")


def chassis(c: Column) -> Column:
    """17 characters without I, O, Q; without the keyword letters and digits must be mixed."""
    t = F.upper(c)
    loose = let(F.regexp_extract(t, r"\b([A-HJ-NPR-Z0-9]{17})\b", 1), lambda x: F.when(x.rlike("[A-Z]") & x.rlike("[0-9]"), x))
    return F.coalesce(_told(t, "CHASSI", r"CHASSI[:\s]+([A-HJ-NPR-Z0-9]{17})\b"), loose)


def renavam(c: Column) -> Column:
    return F.lpad(_told(F.upper(c), "RENAVA", r"RENAVA[MN][:\s]+(\d{9,11})\b"), 11, "0")


def model_year(c: Column) -> Column:
    """First year after ANO within 1900..2100."""
    y = _told(F.upper(c), "ANO", r"ANO[:\s]+(\d{4})(?:\s*/\s*(\d{4}))?").try_cast("int")
    return let(y, lambda v: F.when(v.between(1900, 2100), v))


def short_model_year(c: Column, pivot: int = 50) -> Column:
    """Second of two two-digit years; up to the pivot they belong to this century."""
    y = F.regexp_extract(c, r"\b\d{2}/(\d{2})\b", 1).try_cast("int")
    return F.when(y <= pivot, y + 2000).otherwise(y + 1900)


def latest_year(c: Column) -> Column:
    years = F.regexp_extract_all(c, F.lit(r"\b(19[89]\d|20[0-2]\d)\b"), 1)
    return F.array_max(F.transform(years, lambda y: y.try_cast("int")))


def brand(c: Column, brands: Sequence[str]) -> Column:
    """First listed brand found as a whole word; one pattern finds all of them in one pass, and tries them only where a brand's first letters stand."""
    heads = "".join(f"[{''.join(sorted({re.escape(b[i]) for b in brands}))}]" for i in range(min(2, *map(len, brands))))
    hits = F.regexp_extract_all(F.upper(c), F.lit(rf"\b(?={heads})(" + "|".join(brands) + r")\b"), 1)
    return F.get(F.array_intersect(F.array(*[F.lit(b) for b in brands]), hits), F.lit(0))


MODEL_AFTER_MARK = r"(?<![\p{L}\p{N}_])\x01\s*[/\s]\s*([A-Z0-9\x01][A-Z0-9\x01\s\-.]+?)(?:,|\s+ANO|\s+PLACA|\s+COR|\s+CHASSI|\s+COMB|$)"
VEHICLE_THEN_NAME = (
    r"(?:VEICULO|AUTOMOVEL|CARRO|CAMINH[AÃ]O|MOTO|ONIBUS|VAN|FURG[AÃ]O|PICKUP|UTILITARIO)[:\s]+([A-Z]+)\s*[/\s]\s*"
    r"([A-Z0-9][A-Z0-9\s\-.]+?)(?:,|\s+ANO|\s+PLACA|$)"
)


def _model_name(found: Column) -> Column:
    """A found model of 2 to 50 characters, without trailing signs."""
    return let(F.trim(found), lambda t: F.when(F.length(t).between(2, 50), F.regexp_replace(t, r"[ ,.\-]+$", "")))


def model(c: Column, brand_name: Column) -> Column:
    """Words after the brand up to a comma or a stop word.

    The brand is put in as a mark, not as a pattern: it may hold any characters, and one pattern serves all rows.
    """
    b = F.upper(brand_name)
    found = F.regexp_extract(F.replace(F.upper(c), b, F.lit("\x01")), MODEL_AFTER_MARK, 1)
    return _model_name(F.replace(found, F.lit("\x01"), b))


def named_brand(c: Column) -> Column:
    """First word after a kind of vehicle, for texts without a listed brand."""
    return _some(F.regexp_extract(F.upper(c), VEHICLE_THEN_NAME, 1))


def named_model(c: Column) -> Column:
    return _model_name(F.regexp_extract(F.upper(c), VEHICLE_THEN_NAME, 2))


# ---------------------------------------------------------------- lot blocks
APPRAISED = r"(?i)AVALIA[CÇ][AÃ]O[:\s]*([0-9.,]+)"
LOT_HEAD = r"(?i)LOTE\s*(\d+)\s*\n([\s\S]*)"
LOT_LINE = r"(?is)((?:LOTE|ITEM)\s*[N°º.]?\s*\d+\s*[-:]\s*.+?)(?=(?:LOTE|ITEM)\s*[N°º.]?\s*\d+|\z)"
LOT_LINE_PARTS = r"(?is)(?:LOTE|ITEM)\s*[N°º.]?\s*(\d+)\s*[-:]\s*(.+)"
NUMBERED_LINE = r"(?ism)(^\d+\s*[-–]\s*.+?)(?=^\d+\s*[-–]|\z)"
NUMBERED_LINE_PARTS = r"(?is)(\d+)\s*[-–]\s*(.+)"


def lot_blocks(c: Column) -> Column:
    """Array of struct(lot_no, body, value) of a document; three block shapes, the first that hits wins."""
    def parsed(block_pattern: str, parts: str) -> Column:
        return F.transform(
            F.regexp_extract_all(c, F.lit(block_pattern), F.lit(1)),
            lambda b: F.struct(
                F.regexp_extract(b, parts, 1).alias("lot_no"), F.trim(F.regexp_extract(b, parts, 2)).alias("body"), F.lit(None).cast("string").alias("value")
            ),
        )

    # Between two appraisals stands one block at most, from its first head on: no head looks through the whole text.
    pieces = F.arrays_zip(F.split(c, APPRAISED, -1).alias("before"), F.regexp_extract_all(c, F.lit(APPRAISED), F.lit(1)).alias("value"))
    heads = F.transform(
        F.filter(pieces, lambda x: x["value"].isNotNull()),
        lambda x: F.struct(
            F.regexp_extract(x["before"], LOT_HEAD, 1).alias("lot_no"), F.trim(F.regexp_extract(x["before"], LOT_HEAD, 2)).alias("body"), F.nullif(x["value"], F.lit("")).alias("value")
        ),
    )
    first = F.filter(heads, lambda b: F.length(b["lot_no"]) > 0)
    second = F.filter(parsed(LOT_LINE, LOT_LINE_PARTS), lambda b: F.length(b["body"]) >= 10)
    third = F.filter(parsed(NUMBERED_LINE, NUMBERED_LINE_PARTS), lambda b: F.length(b["body"]) >= 10)
    rest = let(second, lambda b: F.when(F.size(b) > 0, b))
    return F.coalesce(let(first, lambda b: F.when(F.size(b) > 0, b)), rest, third)


# ---------------------------------------------------------------- HTML
H2_TITLE = r"(?is)<h2[^>]*class=[\"']?titulo-lote[\"']?[^>]*>([^<]+)</h2>"
TITLE_TAG = r"(?is)<title[^>]*>([^<]+)</title>"
META_DESCRIPTION = r"(?is)<meta[^>]*name=[\"']description[\"'][^>]*content=[\"']([^\"']+)[\"']"
OG_TAG = r"(?is)<meta[^>]+property=[\"']og:%s[\"'][^>]+content=[\"']([^\"']+)[\"']"
JSON_LD = r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
IMAGE_TAG = r"(?is)<img[^>]*src=[\"']([^\"']+)[\"']"
LINK_TAG = r"(?is)<a\s[^>]*href=[\"']([^\"']+)[\"']"
PLACE_IN_TITLE = r"(?iu)-\s*([A-Za-zÀ-ÿ\s]+)/([A-Z]{2})\s*(?:-\s*Leil|$)"
HTML_VALUES = {
    "valor_avaliacao": r"(?i)[\"']?(?:valor_?)?avaliacao[\"']?\s*[\":]\s*([0-9.,]+)",
    "valor_lance_minimo": r"(?i)[\"']?lance_?minimo[\"']?\s*[\":]\s*([0-9.,]+)",
    "valor_lance_atual": r"(?i)[\"']?lance_?atual[\"']?\s*[\":]\s*([0-9.,]+)",
}
FIRST_AMOUNT = r"R\$\s*([\d.,]+)"
PAGE_NUMBER = r"page=(\d+)"


def html_title(html: Column, generated: Column, site_suffix: str = r"\s*-\s*Leil[õo]es Judiciais\s*") -> Column:
    """Struct(title, source, quality): heading, title tag, meta description, generated text."""
    def usable(c: Column) -> Column:
        t = F.trim(c)
        return F.when((F.length(t) > 0) & (F.lower(t) != "undefined"), t)

    h2 = usable(F.regexp_extract(html, H2_TITLE, 1))
    title = usable(F.regexp_replace(F.trim(F.regexp_extract(html, TITLE_TAG, 1)), f"(?iu){site_suffix}$", ""))
    meta_text = usable(F.regexp_extract(html, META_DESCRIPTION, 1))
    meta = F.when(
        ~F.contains(F.substring(F.lower(meta_text), 1, 20), F.lit("undefined")),
        F.substring(F.trim(F.element_at(F.split(meta_text, " - "), 1)), 1, 200),
    )
    return F.struct(
        F.coalesce(h2, title, meta, generated).alias("title"),
        F.when(h2.isNotNull(), F.lit("h2")).when(title.isNotNull(), F.lit("title")).when(meta.isNotNull(), F.lit("meta")).otherwise(F.lit("generated")).alias("source"),
        F.when(F.coalesce(h2, title, meta).isNotNull(), F.lit("real")).otherwise(F.lit("generated")).alias("quality"),
    )


def html_amount(html: Column, pattern: str) -> Column:
    raw = F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))
    v = F.translate(F.replace(raw, F.lit("."), F.lit("")), ",", ".").try_cast("decimal(18,2)")
    return F.when(v > 0, v)


def html_images(html: Column, skip: Sequence[str], limit: int | None = None) -> Column:
    from noticelake.functions.urls import absolute_image

    srcs = F.regexp_extract_all(html, F.lit(IMAGE_TAG), 1)
    kept = F.filter(srcs, lambda s: ~contains_any(F.lower(s), skip))
    out = F.array_distinct(F.array_compact(F.transform(kept, absolute_image)))
    return F.slice(out, 1, limit) if limit else out


def og(html: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(html, OG_TAG % name, 1), F.lit(""))


def json_ld(html: Column, key: str) -> Column:
    return F.get_json_object(F.nullif(F.regexp_extract(html, JSON_LD, 1), F.lit("")), f"$.{key}")


def max_page(html: Column) -> Column:
    pages = F.transform(F.regexp_extract_all(html, F.lit(PAGE_NUMBER), 1), lambda p: p.try_cast("int"))
    return F.coalesce(F.array_max(pages), F.lit(1))


def first_amount(text: Column) -> Column:
    return parse_money(F.nullif(F.regexp_extract(text, FIRST_AMOUNT, 1), F.lit("")))
