"""Listing feed end to end: page guard, pre-filter, normalize, validate, split, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import urls as U
from noticelake.functions.arrays import tags_by_words
from noticelake.functions.classify import feed_prefilter
from noticelake.functions.dates import local_closing_time
from noticelake.functions.ids import listing_id, payload_hash
from noticelake.functions.money import parse_money, positive_or_null
from noticelake.functions.regions import valid_region
from noticelake.functions.scores import feed_confidence
from noticelake.functions.text import blank_to_null, collapse_space, strip_html, title_case
from noticelake.operators.once import compute_once
from noticelake.operators.paging import top_k
from noticelake.operators.shares import counted
from noticelake.presets import br_notices as br
from noticelake.sources.readers import before_first_repeat


def prefilter(items: DataFrame) -> DataFrame:
    """Adds ``reject_code``, NULL for accepted rows."""
    text = F.concat_ws(" ", "nm_titulo_lote", "nm_descricao")
    return compute_once(items, {"reject_code": feed_prefilter(F.col("kind"), text, br.FEED_SCRAP_WORD, br.FEED_VEHICLE_WORDS)})


def _summary(title: Column, description: Column) -> Column:
    head = F.trim(F.element_at(F.split(description, r"\."), 1))
    use = (F.length(description) > F.length(title)) & (F.length(head) > 20)
    return F.substring(F.when(use, head).otherwise(title), 1, 200)


def _title() -> Column:
    return F.coalesce(blank_to_null(collapse_space(F.col("nm_titulo_lote"))), F.concat(F.lit("Lote "), F.col("lote_id")))


def _required(source: str) -> dict[str, Column]:
    """Id, place and time, without which a row is rejected."""
    auction = F.nullif(F.col("leilao_id"), F.lit(""))
    return {
        "listing_id": listing_id(source, auction, F.col("lote_id")), "region": valid_region(F.col("nm_estado"), br.REGIONS),
        "event_at": local_closing_time(F.col("dt_fechamento")),
    }


def judged_columns(items: DataFrame, source: str) -> DataFrame:
    """Adds what validation looks at: id, title, place, time, value, notice link and tags, each cleaned. Nothing is invented."""
    texts = compute_once(items, {"title": _title(), "description": blank_to_null(strip_html(F.col("nm_descricao")))})
    words = F.lower(F.concat_ws(" ", "title", "description", "nm_categoria"))
    return compute_once(
        texts,
        {
            **_required(source), "city": blank_to_null(title_case(collapse_space(F.col("nm_cidade")))),
            "value": positive_or_null(parse_money(F.coalesce(blank_to_null(F.col("vl_lanceminimo")), F.col("vl_venda")))),
            "notice_link": U.best_attachment(F.col("anexos")), "tags": tags_by_words(words, br.FEED_TAG_WORDS, br.FEED_DEFAULT_TAG),
        },
    )


def presented(judged: DataFrame, source: str, as_of, max_images: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Listing rows out of ``judged_columns``: links, amounts, images, summary and confidence are made for the rows that are shown only."""
    lot, auction = F.col("lote_id"), F.nullif(F.col("leilao_id"), F.lit(""))
    base = U.base_url(F.col("nm_url_leiloeiro"))
    own = F.coalesce(blank_to_null(F.col("url_lote")), blank_to_null(F.col("nm_url_lote")), blank_to_null(F.col("link")))
    rows = compute_once(judged, {"_base": base, "_own": own})
    base, own, title, description = (F.col(c) for c in ("_base", "_own", "title", "description"))
    built = F.when(
        base.isNotNull() & auction.isNotNull() & lot.isNotNull(), F.concat(base, F.lit("/leilao/index/leilao_id/"), auction, F.lit("/lote/"), lot)
    )
    cause = F.when(own.isNull(), F.lit("missing_canonical")).otherwise(F.lit("no_path"))
    photos = F.array_compact(F.transform("fotos", lambda p: p["nm_path_completo"]))
    photos = F.slice(photos, 1, max_images) if max_images else photos
    rows = compute_once(rows, {"link_choice": U.pick_lot_url([("api_canonical", own), ("api_canonical", base)], built, cause)})
    n = rows.select(
        "listing_id", lot.alias("lot_id"), auction.alias("auction_id"), "title", "description", _summary(title, description).alias("summary"), "city", "region", "event_at",
        F.lit(as_of).cast("timestamp").alias("published_at"), "value", positive_or_null(parse_money(F.col("vl_lanceinicial"))).alias("opening_bid"),
        positive_or_null(parse_money(F.col("vl_incremento"))).alias("bid_step"), "link_choice", "notice_link", "tags", F.coalesce(photos, F.array().cast("array<string>")).alias("images"),
        F.coalesce("nm_leiloeiro", F.lit(source)).alias("auctioneer"), F.lit("online").alias("modality"),
        F.to_json(F.struct("id_categoria", "nm_categoria", "nm_subcategoria", "statuslote_id", "nm_statuslote", "nu_visitas")).alias("metadata"),
        payload_hash(lot, auction, F.col("nm_titulo_lote")).alias("payload_hash"), "kind", F.col("link_choice.final_url").alias("auctioneer_link"), *keep,
    )
    has_tag = F.array_contains("tags", "VEICULO") | F.array_contains("tags", "SUCATA")
    return n.withColumn(
        "confidence",
        feed_confidence(
            F.col("event_at").isNotNull(), F.col("city").isNotNull() & F.col("region").isNotNull(), F.col("value").isNotNull(), has_tag,
            F.size("images") > 0, F.col("notice_link").isNotNull(), F.col("city").isNull(), F.col("region").isNull(), F.col("notice_link").isNull(),
        ),
    )


def normalize(items: DataFrame, source: str, as_of, max_images: int | None = None) -> DataFrame:
    """Feed items to listing rows. Amounts, places, links and times are cleaned; nothing is invented."""
    return presented(judged_columns(items, source), source, as_of, max_images)


def _code(cond: Column, name: str) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(name))


def _errors(as_of=None) -> Column:
    code = _code
    title = F.lower(F.trim(F.col("title")))
    errors = [
        code(F.col("event_at").isNull(), "MISSING_DATA_LEILAO"),
        code(F.coalesce(F.size("tags"), F.lit(0)) <= 0, "MISSING_TAGS"),
        code(F.col("listing_id").isNull(), "MISSING_ID_INTERNO"),
        code(title.isNull() | title.isin(*br.EMPTY_TITLES), "INVALID_TITULO"),
        code(F.col("region").isNotNull() & ~F.col("region").isin(*br.REGIONS), "INVALID_UF"),
    ]
    if as_of is not None:
        errors.append(code(F.to_date("event_at") < F.lit(as_of).cast("date"), "EXPIRED_AUCTION"))
    return F.array_compact(F.array(*errors))


def validate(listings: DataFrame, as_of=None) -> DataFrame:
    """Adds ``errors`` and ``warnings`` code arrays; ``as_of`` switches the expiry rule on."""
    warnings = [
        _code(F.col("city").isNull(), "MISSING_CIDADE"),
        _code(F.col("notice_link").isNull(), "MISSING_LINK_EDITAL"),
        _code(F.col("value").isNull(), "MISSING_VALOR"),
    ]
    return listings.withColumn("errors", _errors(as_of)).withColumn("warnings", F.array_compact(F.array(*warnings)))


def rejections(checked: DataFrame, source: str) -> DataFrame:
    """(stage, errors) of the rows that either stage rejects, in one pass; only what the errors look at is made.

    Tags are never missing, for rows without any get the default one.
    """
    passed = F.col("reject_code").isNull()
    looked_at = {n: F.when(passed, c) for n, c in {"title": _title(), **_required(source)}.items()}
    rows = compute_once(checked, looked_at).withColumn("tags", F.array(F.lit(br.FEED_DEFAULT_TAG)))
    errors = F.when(passed, _errors()).otherwise(F.array("reject_code"))
    return rows.select(F.when(passed, "validation").otherwise("pre_filter").alias("stage"), errors.alias("errors")).where(F.size("errors") > 0)


def rejection_codes(spark) -> DataFrame:
    return spark.createDataFrame([(c, t, s) for c, (t, s) in br.REJECTION_TEXT.items()], "code string, description string, severity string")


def run(items: DataFrame, source: str, run_id: str, as_of, drop_repeated_pages: bool = True, filter_vehicles: bool = True) -> dict[str, DataFrame]:
    """``valid``, ``quarantine`` and ``report`` frames of a feed batch."""
    pages = before_first_repeat(items) if drop_repeated_pages else items
    checked = prefilter(pages) if filter_vehicles else pages.withColumn("reject_code", F.lit(None).cast("string"))
    accepted = checked.where(F.col("reject_code").isNull())
    judged = validate(judged_columns(accepted, source))
    notes = ("errors", "warnings")
    valid = presented(judged.where(F.size("errors") == 0), source, as_of, keep=notes)
    early = checked.where(F.col("reject_code").isNotNull())
    bad = judged.where(F.size("errors") > 0)
    quarantine = early.select(
        F.lit(run_id).alias("run_id"), listing_id(source, F.col("leilao_id"), F.col("lote_id")).alias("listing_id"),
        F.array("reject_code").alias("errors"), F.lit("pre_filter").alias("stage"), F.to_json(F.struct(*[c for c in items.columns])).alias("raw_record"),
    )
    late = presented(bad, source, as_of, keep=notes)
    quarantine = quarantine.unionByName(
        late.select(
            F.lit(run_id).alias("run_id"), "listing_id", "errors", F.lit("validation").alias("stage"), F.to_json(F.struct(*[c for c in late.columns if c not in notes])).alias("raw_record"),
        )
    ).withColumn("rejection_code", F.get("errors", F.lit(0)))
    # The report counts codes and needs no more than those.
    report = top_rejections(rejections(checked, source), rejection_codes(items.sparkSession))
    return {"valid": valid, "quarantine": quarantine, "report": report}


def top_rejections(quarantine: DataFrame, codes: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent codes of both stages in one list with their descriptions, largest first."""
    counts = counted(quarantine.select("stage", F.explode("errors").alias("code")), ["stage", "code"])
    order = [F.desc("total"), F.col("stage"), F.col("code")]
    return top_k(counts, order, k).join(F.broadcast(codes), "code", "left").orderBy(*order)  # codes: a row each of the fixed list
