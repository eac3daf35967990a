"""Stable keys. Nothing random, so a re-run gives the same ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def listing_id(source: Column | str, auction: Column, lot: Column, lot_first: bool = False) -> Column:
    """``source|`` + 12 upper-case hex digits of source, auction and lot (auction may be NULL or blank).

    NULL without a lot id: such a row has no key. ``lot_first`` is the key order of feeds that name the lot before the auction.
    """
    src = F.lit(source) if isinstance(source, str) else source
    own, group = (F.nullif(F.trim(c.cast("string")), F.lit("")) for c in (lot, auction))
    key = F.concat_ws("|", src, own, group) if lot_first else F.concat_ws("|", src, group, own)
    return F.when(own.isNotNull(), F.concat(src, F.lit("|"), F.upper(F.substring(F.md5(key), 1, 12))))


def vehicle_id(source: Column, notice: Column, lot: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("|", source, notice.cast("string"), lot.cast("string"))), 1, 16)


def lot_id(notice: Column, lot_no: Column, description: Column, leading: int | None = None) -> Column:
    """Digest of notice, lot number and the raw description.

    ``leading=100`` is the compatible form of stores whose ids were made from the first 100 characters.
    """
    text = F.substring(description, 1, leading) if leading else description
    return F.sha2(F.concat_ws("_", notice.cast("string"), lot_no, F.substring(F.sha2(text, 256), 1, 16)), 256)


def payload_hash(lot: Column, auction: Column, title: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (lot, auction, title)]
    return F.sha2(F.concat_ws("|", *parts), 256)


def text_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def notice_id(*natural_key: Column) -> Column:
    """Stable notice id from its natural key (municipality, process, date)."""
    folded = [F.coalesce(F.upper(F.trim(c.cast("string"))), F.lit("")) for c in natural_key]
    return F.concat(F.lit("ID_"), F.upper(F.substring(F.sha2(F.concat_ws("|", *folded), 256), 1, 12)))


def run_id(started: Column, seed: Column) -> Column:
    """``yyyyMMddTHHmmssZ_`` and 12 hex digits derived from ``seed``."""
    return F.concat(F.date_format(started, "yyyyMMdd'T'HHmmss'Z_'"), F.substring(F.sha2(seed, 256), 1, 12))
