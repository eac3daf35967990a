"""URL columns. No function raises on bad input."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.text import contains_any, let

_HTTP = r"(?i)^https?://"


def has_scheme(c: Column) -> Column:
    return c.rlike(_HTTP)


def starts_www(c: Column) -> Column:
    return c.rlike(r"(?i)^www\.")


def host(c: Column) -> Column:
    """Lower-case host of a URL with or without scheme; port and user part are dropped."""
    bare = F.regexp_replace(F.trim(c), _HTTP, "")
    authority = F.regexp_extract(bare, r"^([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d+$", ""))


def bare_host(c: Column) -> Column:
    """Host without a leading ``www.``; NULL when there is none."""
    return F.nullif(F.regexp_replace(host(c), r"^www\.", ""), F.lit(""))


def path(c: Column) -> Column:
    return F.regexp_extract(F.trim(c), r"(?i)^(?:https?://)?[^/?#]*([^?#]*)", 1)


def has_path(c: Column) -> Column:
    return F.length(F.regexp_replace(path(c), r"^/+|/+$", "")) > 0


def normalize(c: Column, tlds: Iterable[str]) -> Column:
    """Trimmed of stray punctuation, with a scheme; NULL for text that is no URL."""
    t = F.regexp_replace(F.trim(c), r"[)\]},;:\s]+$", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\.$", ""), r"^[<>\"'(\[\s]+", "")
    low = F.lower(t)
    # The part before the known ending must have a dot or be one plain label.
    endings = F.array(*[F.lit(x) for x in tlds])
    domain_like = let(
        low,
        lambda v: F.exists(
            endings, lambda x: F.contains(v, x) & F.substring(v, F.lit(1), F.position(x, v) - F.lit(1)).rlike(r"\.|^[a-z0-9-]+$")
        ),
    )
    return (
        F.when(has_scheme(t), t)
        .when(starts_www(t) | domain_like, F.concat(F.lit("https://"), t))
    )


def add_scheme(c: Column) -> Column:
    """``https://`` in front of ``www.`` text; everything else unchanged."""
    t = F.trim(c)
    return F.when(starts_www(t), F.concat(F.lit("https://"), t)).otherwise(t)


def base_url(c: Column) -> Column:
    """URL with scheme and without trailing slash; NULL when blank."""
    t = F.regexp_replace(F.trim(c), r"/+$", "")
    return F.when(F.length(t) == 0, F.lit(None)).when(has_scheme(t), t).otherwise(F.concat(F.lit("https://"), t))


def is_contract_url(c: Column) -> Column:
    """http(s) URL whose host is made of letters, digits and hyphens with a textual last label."""
    h = F.trim(F.regexp_extract(c, r"(?i)^https?://([^/]*)", 1))
    return F.coalesce(has_scheme(c) & h.rlike(r"(?i)^([a-z0-9-]+\.)+[a-z]{2,}$"), F.lit(False))


def absolute(base: Column, href: Column) -> Column:
    """``href`` resolved against the page it stands on."""
    h = F.trim(href)
    origin = F.regexp_extract(base, r"(?i)^(https?://[^/?#]+)", 1)
    scheme = F.regexp_extract(base, r"(?i)^(https?:)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"[?#].*$", ""), r"(?i)^(https?://[^/]+(?:/.*/|/)?)", 1)
    folder = F.when(folder.rlike(r"/$") & ~folder.rlike(r"(?i)^https?://$"), folder).otherwise(F.concat(origin, F.lit("/")))
    folder = F.when(folder.rlike(r"(?i)^https?://[^/]+/"), folder).otherwise(F.concat(origin, F.lit("/")))
    return (
        F.when(has_scheme(h), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("/"), F.concat(origin, h))
        .when((F.length(h) == 0) | h.startswith("#") | h.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(folder, h))
    )


def host_suffixes(h: Column) -> Column:
    """All dot-suffixes of a host, itself first: ``a.b.c`` gives ``[a.b.c, b.c, c]``."""
    return let(
        F.split(h, r"\."),
        lambda labels: F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )


def link_gate(c: Column, allowed: Column, glued_pattern: str) -> Column:
    """Struct(valid, confidence, reason) of a link candidate; ``allowed`` tells allow-listed hosts."""
    t = F.trim(c)
    ok = F.coalesce(allowed, F.lit(False))

    def verdict(valid: bool, confidence: int, reason: str | None) -> Column:
        return F.struct(
            F.lit(valid).alias("valid"),
            F.lit(confidence).alias("confidence"),
            F.lit(reason).cast("string").alias("reason"),
        )

    return (
        F.when(t.isNull() | (F.length(t) == 0), verdict(False, 0, "candidato_vazio"))
        .when(ok, verdict(True, 100, None))
        .when(has_scheme(t), verdict(True, 80, None))
        .when(starts_www(t), verdict(True, 60, None))
        .when(t.rlike(glued_pattern), verdict(False, 0, "tld_colado_em_palavra"))
        .otherwise(verdict(False, 0, "sem_prefixo_ou_whitelist"))
    )


def correct_host(c: Column, corrections: Mapping[str, str]) -> Column:
    """Known wrong hosts replaced, the rest of the URL kept."""
    table = F.create_map(*[F.lit(x) for kv in corrections.items() for x in kv])
    right = table[bare_host(c)]
    return F.when(
        has_scheme(c) & right.isNotNull(),
        F.concat(F.regexp_extract(c, r"(?i)^(https?://)", 1), right, F.regexp_extract(c, r"(?i)^https?://[^/?#]*(.*)$", 1)),
    ).otherwise(c)


def is_relevant(c: Column, ignored: Iterable[str], mail: Iterable[str], words: Iterable[str], suffixes: Iterable[str]) -> Column:
    low = F.lower(c)
    return ~contains_any(low, [*ignored, *mail]) & contains_any(low, [*words, *suffixes])


def pick_lot_url(candidates: Sequence[tuple[str, Column]], fallback: Column, missing_reason: Column) -> Column:
    """First candidate that has a path, else the constructed fallback, else failed with a cause."""
    tried = F.array(*[F.struct(c.alias("url"), F.lit(label).alias("method")) for label, c in candidates])
    good = F.get(F.filter(tried, lambda x: F.coalesce(has_path(x["url"]), F.lit(False))), F.lit(0))
    fb = F.when(F.coalesce(has_path(fallback), F.lit(False)), fallback)
    return F.struct(
        F.coalesce(good["url"], fb).alias("final_url"),
        (good["url"].isNull() & fb.isNotNull()).alias("constructed"),
        F.coalesce(
            good["method"], F.when(fb.isNotNull(), F.lit("constructed_validated")), F.lit("failed")
        ).alias("method"),
        F.when(good["url"].isNull() & fb.isNull(), missing_reason).alias("error"),
    )


def notice_link(tax_id: Column, year: Column, seq: Column, base: str) -> Column:
    """Portal link from id parts; NULL when a part has the wrong shape."""
    t = F.regexp_replace(tax_id, r"\D", "")
    y, s = F.trim(year), F.regexp_replace(F.trim(seq), r"^0+", "")
    return F.when((F.length(t) == 14) & y.rlike(r"^\d{4}$"), F.concat(F.lit(base), t, F.lit("/"), y, F.lit("/"), F.when(s == "", F.lit("0")).otherwise(s)))


def notice_id_parts(c: Column) -> Column:
    """Struct(tax_id, code, seq, year) of ``TAXID-code-sequence-year`` (last separator may be a slash)."""
    p = r"(\d{14})\D+(\d+)\D+(\d+)\D+(\d{4})"
    seq = F.regexp_replace(F.regexp_extract(c, p, 3), r"^0+(?=\d)", "")
    return F.when(
        c.rlike(p),
        F.struct(
            F.regexp_extract(c, p, 1).alias("tax_id"),
            F.regexp_extract(c, p, 2).alias("code"),
            seq.alias("seq"),
            F.regexp_extract(c, p, 4).alias("year"),
        ),
    )


def link_from_notice_id(c: Column, base: str) -> Column:
    parts = notice_id_parts(c)
    return notice_link(parts["tax_id"], parts["year"], parts["seq"], base)


def best_attachment(c: Column, name: str = "nm", url: str = "nm_path_completo") -> Column:
    """Last corrected notice among attachments, else last plain notice."""
    def named(pattern: str) -> Column:
        hits = F.filter(c, lambda a: a[url].isNotNull() & F.upper(a[name]).rlike(pattern))
        return F.try_element_at(hits, F.lit(-1))[url]

    return F.coalesce(named("RETIFICADO|RETIFICACAO|RETIFICAÇÃO"), named("EDITAL"))


def agency_url(text: Column, rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    out = F.lit(None).cast("string")
    for words, url in reversed(rules):
        out = F.when(contains_any(F.lower(text), words), F.lit(url)).otherwise(out)
    return out


def host_class(h: Column, classes: Sequence[tuple[str, Sequence[str]]], other: str) -> Column:
    """First class with a part contained in the host."""
    table = F.array(
        *[F.struct(F.lit(n).alias("name"), F.array(*[F.lit(p) for p in parts]).alias("parts")) for n, parts in classes]
    )
    hits = let(F.lower(h), lambda v: F.filter(table, lambda r: F.exists(r["parts"], lambda p: F.contains(v, p))))
    return F.coalesce(F.get(hits, F.lit(0))["name"], F.lit(other))


def region_of_host(h: Column, regions: Iterable[str]) -> Column:
    low = F.lower(h)
    agency = F.upper(F.regexp_extract(low, r"detran\.([a-z]{2})\.gov\.br", 1))
    plain = F.upper(F.regexp_extract(low, r"\.([a-z]{2})\.gov\.br", 1))
    return F.coalesce(F.nullif(agency, F.lit("")), F.when(plain.isin(list(regions)), plain), F.lit(""))


def name_from_host(h: Column) -> Column:
    """Auctioneer name guessed from common host shapes; NULL when none fits."""
    low = F.lower(h)

    def part(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(low, pattern, 1), F.lit(""))

    return F.coalesce(
        F.initcap(part(r"^([a-z]+)leiloeir[oa]\.")),
        F.initcap(part(r"^([a-z]+)leiloes\.")),
        F.initcap(part(r"^leiloes([a-z]+)\.")),
        F.initcap(part(r"^([a-z]+)lances\.")),
        F.when(F.contains(low, F.lit("gestao")), F.lit("Gestão de Leilões")),
        F.upper(part(r"^([a-z]+?)(?:leiloes|leiloeiro|lances)")),
    )


def absolute_image(c: Column) -> Column:
    return F.when(c.rlike(_HTTP), c).when(c.startswith("//"), F.concat(F.lit("https:"), c))
