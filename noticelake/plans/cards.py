"""Listing cards: a page is cut into its cards by the depth of tags, and fields are looked for inside one card.

A field that a card lacks is NULL there and moves no other card's fields.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.ids import vehicle_id
from noticelake.functions.money import parse_money
from noticelake.functions.text import collapse_space
from noticelake.operators.once import compute_once


@dataclass(frozen=True)
class Site:
    """How the cards of one site are told and read."""

    name: str
    #: Element that holds a card, and what the inside of its opening tag has to match.
    tag: str
    opens: str
    #: Pattern with one group for each field.
    fields: Mapping[str, str]
    #: Fields without which a card is none.
    required: Sequence[str] = ()
    #: Constant values of fields that the page doesn't state.
    constants: Mapping[str, str] = field(default_factory=dict)


def _pieces(html: Column, tag: str) -> Column:
    """The text cut before each opening and closing tag of one element: joined, the pieces are the text."""
    return F.split(html, rf"(?i)(?=</?{tag}(?![\w-]))", -1)


def _spans(pieces: Column, tag: str, opens: str) -> Column:
    """First piece of each card and the piece after its last. Cards inside cards belong to the outer one.

    A card ends with the closing tag that brings the depth back to where the card began, or with the page.
    """
    def mark(p: Column, i: Column) -> Column:
        head = F.regexp_extract(p, rf"(?is)^<{tag}(?![\w-])([^>]*)>", 1)
        opened = p.rlike(rf"(?is)^<{tag}(?![\w-])[^>]*>") & ~head.endswith("/")
        closed = p.rlike(rf"(?i)^</{tag}(?![\w-])")
        return F.struct(F.when(opened, 1).when(closed, -1).otherwise(0).alias("step"), (opened & head.rlike(opens)).alias("card"), i.alias("i"))

    kind = "struct<depth:int,base:int,start:int,out:array<struct<first:int,after:int>>>"
    zero = F.struct(F.lit(0).alias("depth"), F.lit(None).cast("int").alias("base"), F.lit(0).alias("start"), F.array().cast("array<struct<first:int,after:int>>").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        depth = F.greatest(acc["depth"] + m["step"], F.lit(0))
        begins = acc["base"].isNull() & m["card"]
        ends = acc["base"].isNotNull() & (m["step"] < 0) & (depth <= acc["base"])
        return F.struct(
            depth.alias("depth"),
            F.when(begins, acc["depth"]).when(~ends, acc["base"]).alias("base"),
            F.when(begins, m["i"]).otherwise(acc["start"]).alias("start"),
            F.when(ends, F.concat(acc["out"], F.array(F.struct(acc["start"].alias("first"), m["i"].alias("after"))))).otherwise(acc["out"]).alias("out"),
        ).cast(kind)

    def finish(acc: Column) -> Column:
        rest = F.array(F.struct(acc["start"].alias("first"), F.size(pieces).alias("after")))
        return F.when(acc["base"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], rest))

    return F.aggregate(F.transform(pieces, mark), zero.cast(kind), step, finish)


def cut_cards(pages: DataFrame, tag: str, opens: str = "", html: str = "html", keep: Sequence[str] = ("url",)) -> DataFrame:
    """(keep…, position, card): the cards of every page in order, from position 0. Pages without a text have none."""
    cut = compute_once(pages.where(F.col(html).isNotNull()).select(*keep, html), {"_pieces": _pieces(F.col(html), tag)})
    found = cut.select(*keep, "_pieces", F.posexplode(_spans(F.col("_pieces"), tag, opens)).alias("position", "_at"))
    text = F.array_join(F.slice("_pieces", F.col("_at.first") + 1, F.col("_at.after") - F.col("_at.first")), "")
    return found.select(*keep, "position", text.alias("card"))


def read_cards(pages: DataFrame, site: Site, keep: Sequence[str] = ("url",)) -> DataFrame:
    """(keep…, position, one column a field) of the cards that have all required fields."""
    cards = cut_cards(pages, site.tag, site.opens, keep=keep)
    fields = {n: F.nullif(F.trim(F.regexp_extract("card", p, 1)), F.lit("")) for n, p in site.fields.items()}
    fields |= {n: F.lit(v) for n, v in site.constants.items()}
    rows = compute_once(cards, fields).drop("card")
    for n in site.required:
        rows = rows.where(F.col(n).isNotNull())
    return rows


def listing_cards(pages: DataFrame, site: Site) -> DataFrame:
    """Vehicle cards with typed fields; a field that the site has no pattern for is NULL, a missing price 0."""
    rows = read_cards(pages, site)
    text = {n: F.col(n) if n in rows.columns else F.lit(None).cast("string") for n in ("vehicle", "price", "model_year", "category", "plate", "yard", "lot", "lot_url", "image")}
    lot = F.coalesce(text["lot"].try_cast("int"), F.col("position") + 1)
    year = text["model_year"]
    short = F.regexp_extract(year, r"^\d{2}/(\d{2})$", 1).try_cast("int")
    return rows.select(
        vehicle_id(F.lit(site.name), F.col("url"), F.col("position")).alias("vehicle_id"), F.lit(site.name).alias("source"), "url", lot.alias("lot"),
        collapse_space(F.upper(text["vehicle"])).alias("vehicle"), F.coalesce(parse_money(text["price"]), F.lit(0).cast("decimal(18,2)")).alias("price"),
        F.coalesce(year.try_cast("int"), F.when(short < 50, short + 2000).otherwise(short + 1900)).alias("model_year"),
        F.initcap(text["category"]).alias("category"), text["plate"].alias("plate"), text["yard"].alias("yard"), text["lot_url"].alias("lot_url"), text["image"].alias("image"),
    )
