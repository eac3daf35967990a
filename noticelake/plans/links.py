"""Auctioneer links with provenance: candidates from page text, sheets and descriptions, gated and ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.extract import URL_HTTP, URL_WWW
from noticelake.functions.text import context_snippet
from noticelake.functions.urls import add_scheme, bare_host, correct_host, host_suffixes, is_relevant, link_gate
from noticelake.operators.keyed import keep_first
from noticelake.operators.once import compute_once
from noticelake.operators.shares import counted, distribution
from noticelake.presets import br_notices as br
from noticelake.sources.snapshots import staged

# Order in which sources are believed.
SOURCES = ("pdf_anexo", "xlsx_anexo", "csv_anexo", "titulo_descricao")

# Bare hosts in text, and the family of auction hosts.
HOST_IN_TEXT = r"(?i)((?:https?://)?(?:[a-z0-9-]+\.)+[a-z]{2,}(?:/[^\s<>\"]*)?)"
AUCTION_HOST = r"(?iu)((?:https?://|www\.)?[a-z]+leil[oõ]es\.com\.br(?:/[^\s<>\"]*)?)"

STRATEGIES = ((1, HOST_IN_TEXT), (2, AUCTION_HOST), (3, URL_HTTP), (4, URL_WWW))


#: What a word has to hold for any of the strategies to find something in it.
LINK_WORD = r"(?i)[a-z0-9-]\.[a-z]|https?://|www\.[a-z0-9]"
#: Last labels of allowed hosts up to which they go with the scan.
ENDINGS = 1000


def host_endings(allow: DataFrame) -> list[str] | None:
    """Last labels of the allowed domains, a short list whatever their number; None if it is not, and then nothing is left out by it."""
    rows = allow.select(F.lower(F.substring_index("domain", ".", -1)).alias("e")).where(F.length("e") > 0).distinct().take(ENDINGS + 1)
    return sorted(r["e"] for r in rows) if len(rows) <= ENDINGS else None


def text_candidates(texts: DataFrame, endings: list[str] | None = None) -> DataFrame:
    """Link candidates of every text with their place of origin.

    ``texts``: notice_id, source, ref, page_no, text. A text is cut at white space once, which no link holds, and only words that could be
    one are looked at by the strategies. With ``endings`` bare hosts whose last label no allowed host has end here, but for those
    that are told as a word with a glued ending. A position counts words, and finds within a word.
    """

    def found(word: Column) -> Column:
        def of(strategy: int, pattern: str) -> Column:
            def candidate(m: Column, i: Column) -> Column:
                raw = F.regexp_replace(m, r"[.,;:)>\"']+$", "")
                return F.struct(F.lit(strategy).alias("strategy"), (word["at"].cast("bigint") * (1 << 20) + i).alias("position"), raw.alias("raw"))

            return F.transform(F.regexp_extract_all(word["w"], F.lit(pattern), 1), candidate)

        return F.concat(*[of(s, p) for s, p in STRATEGIES])

    words = F.transform(F.split("text", r"\s+"), lambda w, i: F.struct(i.alias("at"), w.alias("w")))
    words = F.filter(words, lambda x: x["w"].rlike(LINK_WORD))
    rows = texts.select("notice_id", "source", "ref", "page_no", "text", F.explode(F.flatten(F.transform(words, found))).alias("c"))
    rows = rows.select("*", bare_host(F.col("c.raw")).alias("host"))
    if endings is not None:
        last = F.lower(F.substring_index("host", ".", -1))
        rows = rows.where((F.col("c.strategy") != 1) | last.isin(*endings) | F.col("c.raw").rlike(br.GLUED_TLD))
    return rows.select(
        "notice_id", "source", "ref", "page_no", "c.strategy", "c.position", "c.raw", context_snippet(F.col("text"), F.col("c.raw")).alias("evidence"), "host"
    )


def matched_domains(hosts: DataFrame, allow: DataFrame) -> DataFrame:
    """(host, domain): the longest allowed domain each distinct host equals or belongs to."""
    distinct = hosts.select("host").where(F.col("host").isNotNull()).distinct()
    suffixes = distinct.select("host", F.explode(host_suffixes(F.col("host"))).alias("domain"))
    hits = suffixes.join(allow.select(F.lower("domain").alias("domain")).distinct(), "domain")
    return hits.groupBy("host").agg(F.max_by("domain", F.length("domain")).alias("domain"))


def gated_candidates(candidates: DataFrame, allow: DataFrame) -> DataFrame:
    """Candidates with (valid, confidence, reason) and the normalized URL, one row per URL and page.

    Bare host names count only when allow-listed; other strategies need a relevant host.
    """
    c = candidates.join(matched_domains(candidates, allow), ["host"], "left")
    site = F.concat(F.lit("https://www."), F.coalesce("domain", "host"))
    # A bare host is looked up by its domain; it keeps its own text when it is not on the list.
    url = F.when(F.col("strategy") == 1, F.when(F.col("domain").isNotNull(), site).otherwise(F.col("raw"))).when(F.col("strategy") == 2, site).otherwise(F.col("raw"))
    c = c.withColumn("url", url)
    relevant = is_relevant(F.col("raw"), br.IGNORED_HOST_PARTS, br.MAIL_HOSTS, br.RELEVANT_LINK_WORDS, br.RELEVANT_LINK_SUFFIXES)
    glued = F.col("raw").rlike(br.GLUED_TLD) & ~F.col("raw").rlike(r"(?i)^(https?://|www\.)")
    c = c.where(((F.col("strategy") == 1) & (F.col("domain").isNotNull() | glued)) | (F.col("strategy") == 2) | relevant)
    gate = link_gate(F.col("url"), F.col("domain").isNotNull(), br.GLUED_TLD)
    c = compute_once(c, {"g": gate})
    final = F.regexp_replace(correct_host(add_scheme(F.col("url")), br.HOST_CORRECTIONS), r"/+$", "")
    c = c.select(
        "notice_id", "source", "ref", "page_no", "strategy", "position", "raw", "evidence",
        F.when(F.col("g.valid"), final).alias("url"),
        F.col("g.valid").alias("valid"), F.col("g.confidence").alias("confidence"), F.col("g.reason").alias("reason"),
    )
    return keep_first(
        c.withColumn("_key", F.coalesce("url", "raw")), ["notice_id", "source", "ref", "page_no", "_key"], [F.col("strategy"), F.col("position")]
    ).drop("_key")


def best_link(gated: DataFrame) -> DataFrame:
    """One link per notice: first source with a valid link, there the most confident and earliest one;
    without any valid link the earliest rejected candidate, kept for the record.

    ``max_by`` folds candidates inside every task before the shuffle.
    """
    source_rank = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.col("source")), F.lit(99))
    order = F.struct(
        F.col("valid").cast("int").alias("a"),
        (-source_rank).alias("b"),
        F.col("confidence").alias("c"),
        (-F.coalesce("page_no", F.lit(0))).alias("d"),
        (-F.col("strategy")).alias("e"),
        (-F.col("position")).alias("f"),
    )
    row = F.struct("url", "raw", "valid", "source", "ref", "page_no", "evidence", "confidence", "reason")
    best = gated.groupBy("notice_id").agg(F.max_by(row, order).alias("b"))
    return best.select(
        "notice_id",
        F.col("b.url").alias("link"),
        F.col("b.raw").alias("link_raw"),
        F.col("b.valid").alias("link_valid"),
        F.col("b.source").alias("link_origin"),
        F.concat_ws(":", F.lit("ref"), "b.ref", F.when(F.col("b.page_no") > 0, F.concat(F.lit("page="), "b.page_no"))).alias("link_origin_ref"),
        F.substring("b.evidence", 1, 200).alias("link_evidence"),
        F.col("b.confidence").alias("link_confidence"),
        F.col("b.reason").alias("link_reject_reason"),
    )


def stored_candidates(texts: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """Candidates written to the shared folder: the texts are read once, and the host lookup and
    the ranking work on the few short rows found in them."""
    return staged(text_candidates(texts, host_endings(allow) if allow is not None else None), "candidates")


def resolve_links(texts: DataFrame, allow: DataFrame) -> DataFrame:
    return best_link(gated_candidates(stored_candidates(texts, allow), allow))


def audit_marks(notices: DataFrame, resolved: DataFrame, run_id: str, as_of) -> DataFrame:
    """Processed time, run and result (found, no_link, error, skipped) for every notice.

    ``resolved`` may have an ``error``, the text of what went wrong while a notice was read.
    """
    wrong = F.col("error").isNotNull() if "error" in resolved.columns else F.lit(False)
    j = notices.join(resolved.select("notice_id", "link_valid", wrong.alias("_wrong")), "notice_id", "left")
    result = F.when(F.col("_wrong"), F.lit("error")).when(F.col("link_valid"), F.lit("found")).otherwise(F.lit("no_link"))
    if "skip" in notices.columns:
        result = F.when(F.col("skip"), F.lit("skipped")).otherwise(result)
    return j.withColumn("audited_at", F.lit(as_of).cast("timestamp")).withColumn("audit_run_id", F.lit(run_id)).withColumn("audit_result", result).drop("link_valid", "_wrong")


def gate_metrics(gated: DataFrame) -> DataFrame:
    return counted(gated.withColumn("reason", F.coalesce("reason", F.lit("none"))), ["confidence", "reason"])


def api_link(system_link: Column, notice_link: Column) -> Column:
    """Struct(candidate, ref): the system link, else the notice link; portal links are no auctioneer links."""
    first = F.coalesce(F.nullif(system_link, F.lit("")), F.nullif(notice_link, F.lit("")))
    used = F.when(F.length(system_link) > 0, F.lit("linkSistema")).otherwise(F.lit("linkEdital"))
    portal = F.contains(F.lower(first), F.lit("pncp.gov"))
    return F.when(first.isNotNull() & ~portal, F.struct(first.alias("candidate"), F.concat(F.lit("pncp_api:"), used).alias("ref")))


def link_quality(df: DataFrame, link: str = "link", valid: str = "link_valid", origin: str = "link_origin") -> DataFrame:
    """One pass: rows, with and without link, validity true/false/null, rows per known origin."""
    has = F.coalesce(F.col(link).isNotNull() & (F.col(link) != "N/D"), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(has).alias("with_link"),
        F.count_if(~has).alias("without_link"),
        F.count_if(has & F.col(valid)).alias("valid_true"),
        F.count_if(has & ~F.col(valid)).alias("valid_false"),
        F.count_if(has & F.col(valid).isNull()).alias("valid_null"),
        F.count_if(F.col(origin) == "pncp_api").alias("origin_api"),
        F.count_if(F.col(origin) == "pdf_anexo").alias("origin_document"),
    )


def invalid_links(df: DataFrame, key: str = "id", link: str = "link", valid: str = "link_valid", origin: str = "link_origin") -> DataFrame:
    """(key, link, origin, problem) of every notice whose link is there and marked invalid, or was never judged."""
    has = F.coalesce(F.col(link).isNotNull() & (F.col(link) != "N/D") & (F.col(link) != ""), F.lit(False))
    problem = F.when(F.col(valid).isNull(), F.lit("not_judged")).when(~F.col(link).rlike(r"(?i)^(https?://|www\.)"), F.lit("no_address")).otherwise(F.lit("rejected"))
    return df.where(has & ~F.coalesce(F.col(valid), F.lit(False))).select(key, link, F.coalesce(origin, F.lit("unknown")).alias("origin"), problem.alias("problem"))


def backfill_counts(before: DataFrame, after: DataFrame, origin: str = "link_origin", valid: str = "link_valid") -> DataFrame:
    """(origin, valid, rows_before, rows_after): what a backfill changed."""
    def side(df: DataFrame, b: int) -> DataFrame:
        names = [F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(n) for c, n in ((origin, "origin"), (valid, "valid"))]
        one = F.lit(1).cast("bigint")
        return df.select(*names).groupBy("origin", "valid").agg(F.sum(one * (1 - b)).alias("rows_before"), F.sum(one * b).alias("rows_after"))

    return side(before, 0).unionByName(side(after, 1)).groupBy("origin", "valid").agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"))


def origins(df: DataFrame, origin: str = "link_origin") -> DataFrame:
    return distribution(df, origin)


def no_link_cause(link: Column, valid: Column, local_file: Column, storage_path: Column) -> Column:
    """Probable cause class of a missing or bad link."""
    has = F.coalesce(link.isNotNull() & (link != "N/D") & (link != ""), F.lit(False))
    no_file = F.coalesce(F.length(local_file), F.lit(0)) == 0
    no_storage = F.coalesce(F.length(storage_path), F.lit(0)) == 0
    return (
        F.when(has & F.coalesce(valid, F.lit(False)), F.lit("TEM_LINK_VALIDO"))
        .when(has, F.lit("LINK_INVALIDO"))
        .when(no_file & no_storage, F.lit("SEM_PDF"))
        .when(~no_storage, F.lit("PDF_SEM_LINK"))
        .otherwise(F.lit("APENAS_LOCAL"))
    )


def backfill_provenance(df: DataFrame) -> DataFrame:
    """Origin and validity filled where earlier runs left them open; rules are tried in order."""
    has = F.coalesce(F.col("link").isNotNull() & (F.col("link") != "N/D"), F.lit(False))
    o, audit = F.col("link_origin"), F.col("audit_result")
    unknown = F.coalesce(o == "unknown", F.lit(False))
    found = F.coalesce(audit == "found_link", F.lit(False))
    no_link = F.coalesce(audit == "no_link", F.lit(False))
    r1 = has & o.isNull()
    r2 = has & unknown & found
    r3 = has & unknown & ~found & ~no_link
    r4 = ~has & unknown
    origin = F.when(r1 | r3, F.lit("pncp_api")).when(r2, F.lit("pdf_anexo")).when(r4, F.lit(None)).otherwise(o)
    ref = (
        F.when(r1, F.lit("backfill:api"))
        .when(r2, F.lit("backfill:document"))
        .when(r3, F.lit("backfill:presumed_api"))
        .otherwise(F.col("link_origin_ref"))
    )
    shaped = F.col("link").rlike(r"(?i)^(https?://|www\.)")
    open_ = has & F.col("link_valid").isNull()
    note = F.when(open_ & shaped, F.lit(" [backfill:valid]")).when(open_, F.lit(" [backfill:review]"))
    return (
        df.withColumn("link_origin_ref", F.when(note.isNotNull(), F.concat(F.coalesce(ref, F.lit("")), note)).otherwise(ref))
        .withColumn("link_valid", F.when(open_, shaped).otherwise(F.col("link_valid")))
        .withColumn("link_origin", origin)
    )


def domain_registry(links: DataFrame, stored: DataFrame | None = None, url: str = "url", seen_at: str = "seen_at") -> DataFrame:
    """Occurrences, first and last sight and a sample URL per host, merged into stored counts."""
    batch = (
        links.select(bare_host(F.col(url)).alias("domain"), F.col(url).alias("u"), F.col(seen_at).alias("t"))
        .where(F.col("domain").isNotNull())
        .groupBy("domain")
        .agg(F.count(F.lit(1)).alias("occurrences"), F.min("t").alias("first_seen"), F.max("t").alias("last_seen"), F.min("u").alias("sample_url"))
    )
    if stored is None:
        return batch
    return (
        stored.select(*batch.columns)
        .withColumn("_old", F.lit(0))
        .unionByName(batch.withColumn("_old", F.lit(1)))
        .groupBy("domain")
        .agg(F.sum("occurrences").alias("occurrences"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
             F.min_by("sample_url", "_old").alias("sample_url"))
    )


def sheet_urls(cells: DataFrame, notice_id: str, source: str = "csv_anexo") -> DataFrame:
    """Cells as texts for ``resolve_links``; the reference keeps row and column."""
    return cells.select(F.lit(notice_id).alias("notice_id"), F.lit(source).alias("source"), "ref", F.lit(0).alias("page_no"), F.col("cell").alias("text"))


__all__ = [
    "api_link", "audit_marks", "backfill_provenance", "best_link", "domain_registry", "gate_metrics",
    "gated_candidates", "link_quality", "matched_domains", "no_link_cause", "origins", "resolve_links", "sheet_urls", "stored_candidates", "text_candidates",
]
