"""Rule-based class columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.text import contains_any, fold_accents, let


def first_class(text: Column, classes: Sequence[tuple[str, Sequence[str]]], other: str | None) -> Column:
    """First class with a word contained in the text; classes are tried in order."""
    table = F.array(
        *[F.struct(F.lit(n).alias("name"), F.array(*[F.lit(w) for w in ws]).alias("words")) for n, ws in classes]
    )
    hits = let(text, lambda t: F.filter(table, lambda r: F.exists(r["words"], lambda w: F.coalesce(F.contains(t, w), F.lit(False)))))
    return F.coalesce(F.get(hits, F.lit(0))["name"], F.lit(other))


def is_vehicle_category(category_id: Column, category: Column, title: Column, include: Iterable[str], exclude: Iterable[str]) -> Column:
    """Numeric category decides when present, else exclusion words, else inclusion words."""
    text = F.lower(F.concat_ws(" ", category, title))
    return (
        F.when(category_id.isNotNull(), category_id == 1)
        .when(contains_any(text, exclude), F.lit(False))
        .otherwise(contains_any(text, include))
    )


def feed_prefilter(kind: Column, text: Column, scrap_word: str, vehicle_words: Iterable[str]) -> Column:
    """Rejection code of a feed row, NULL when accepted."""
    low = F.lower(text)
    vehicle_scrap = F.coalesce(F.contains(low, F.lit(scrap_word)), F.lit(False)) & contains_any(low, vehicle_words)
    k = F.coalesce(kind, F.lit(1))
    return (
        F.when(k == 1, F.lit(None).cast("string"))
        .when((k == 2) & vehicle_scrap, F.lit(None).cast("string"))
        .when(k == 3, F.lit("TIPO_3"))
        .otherwise(F.lit("CATEGORY_EXCLUDED"))
    )


def modality(text: Column, online: Iterable[str], onsite: Iterable[str], labels: tuple[str, str, str], missing: str | None = None) -> Column:
    """Both, online or on-site, from two word sets."""
    low = F.lower(text)
    a, b = contains_any(low, online), contains_any(low, onsite)
    both, net, site = labels
    return F.when(a & b, F.lit(both)).when(a, F.lit(net)).when(b, F.lit(site)).otherwise(F.lit(missing).cast("string"))


def reconcile_modality(value: Column, text: Column, labels: tuple[str, str, str]) -> Column:
    """Modality name folded to three values and repaired where the text contradicts it."""
    both, net, site = labels
    v = fold_accents(value)
    name = (
        F.when(F.contains(v, F.lit("eletron")), F.lit(net))
        .when(F.contains(v, F.lit("presenc")), F.lit(site))
        .when(F.contains(v, F.lit("hibrid")), F.lit(both))
        .otherwise(value)
    )
    low = F.lower(F.coalesce(text, F.lit("")))
    says_net = contains_any(low, ("online", "eletrônico", "eletronico", "eletrônica"))
    says_net_strict = contains_any(low, ("online", "eletrônico"))
    says_site = F.contains(low, F.lit("presencial"))
    return (
        F.when((name == site) & says_net & says_site, F.lit(both))
        .when((name == site) & says_net, F.lit(net))
        .when((name == net) & says_site & ~says_net_strict, F.lit(both))
        .otherwise(name)
    )


def modality_from_code(code: Column, names: Mapping[int, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[code.cast("int")]


def vehicle_icon(text: Column) -> Column:
    low = fold_accents(text)
    return (
        F.when(low.rlike("moto|ciclo|scooter"), F.lit("moto"))
        .when(low.rlike("caminhao|truck|carreta"), F.lit("truck"))
        .when(low.rlike("carro|automovel|veiculo"), F.lit("car"))
        .otherwise(F.lit("other"))
    )


def is_blocked(text: Column, blocked_words: Iterable[str], content_words: Iterable[str] = ()) -> Column:
    """Page that shows a barrier; a page that also shows content is not blocked."""
    low = F.lower(text)
    hit = contains_any(low, blocked_words)
    return hit & ~contains_any(low, content_words) if content_words else hit


# Content type to extension, and leading bytes (hex) to extension.
CONTENT_TYPES = {
    "application/pdf": ".pdf",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx",
    "application/vnd.ms-excel": ".xls",
    "text/csv": ".csv",
    "application/zip": ".zip",
    "application/x-zip-compressed": ".zip",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "application/msword": ".doc",
}


def file_type(content_type: Column, data: Column) -> Column:
    """Extension from the content type, else from the leading bytes."""
    table = F.create_map(*[F.lit(x) for kv in CONTENT_TYPES.items() for x in kv])
    declared = table[F.trim(F.element_at(F.split(F.lower(content_type), ";"), 1))]
    magic = F.hex(F.substring(data, 1, 4))
    sniffed = (
        F.when(magic == "25504446", F.lit(".pdf"))
        .when((magic == "504B0304") & F.contains(data, F.encode(F.lit("xl/"), "UTF-8")), F.lit(".xlsx"))
        .when((magic == "504B0304") & F.contains(data, F.encode(F.lit("word/"), "UTF-8")), F.lit(".docx"))
        .when(magic == "504B0304", F.lit(".zip"))
        .when(magic == "D0CF11E0", F.lit(".xls"))
    )
    return F.coalesce(declared, sniffed)


def table_is_relevant(header: Column, words: Iterable[str], skip: Iterable[str]) -> Column:
    """Header row (array of cells) that belongs to a table of lots."""
    text = fold_accents(F.array_join(header, " ", ""))
    return ~contains_any(text, skip) & contains_any(text, words)


def column_role(cell: Column, roles: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Role of a header cell; roles are tried in order, NULL when none fits."""
    return first_class(fold_accents(cell), roles, None)
