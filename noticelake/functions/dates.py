"""Date columns. Reference times are parameters; nothing here reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.text import let


def contract_date(c: Column) -> Column:
    """``dd-MM-yyyy`` text re-formatted; NULL for slashes, other shapes and impossible days."""
    text = F.trim(c)
    return F.date_format(_strict_date(text, r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"), "dd-MM-yyyy")


def _strict_date(text: Column, shape: str, fmt: str) -> Column:
    return F.try_to_date(F.when(text.rlike(shape), text), fmt)


def _strict_ts(text: Column, shape: str, fmt: str) -> Column:
    return F.try_to_timestamp(F.when(text.rlike(shape), text), F.lit(fmt))


def parse_any_timestamp(c: Column) -> Column:
    """ISO, spaced ISO, plain date and Brazilian forms; a zone suffix is honoured; NULL otherwise."""
    t = F.trim(c)
    zoned = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"
    return F.coalesce(
        F.when(t.rlike(zoned), F.try_to_timestamp(t)),
        _strict_ts(t, r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
        _strict_ts(t, r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
        _strict_ts(t, r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "d/M/yyyy H:mm"),
        _strict_ts(t, r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "d/M/yyyy H:mm:ss"),
    )


def to_iso_text(c: Column) -> Column:
    """Brazilian date or date-time to ISO text, padded; ISO text is kept; placeholders give NULL."""
    t = F.trim(c)
    stamp = parse_any_timestamp(F.regexp_replace(t, r"^(\d{1,2})[-.](\d{1,2})[-.](\d{4})", "$1/$2/$3"))
    return F.when(t.rlike(r":"), F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(stamp, "yyyy-MM-dd")
    )


def to_br_text(c: Column, missing: str = "N/D") -> Column:
    """ISO or dashed/dotted day-first text to ``dd/MM/yyyy``."""
    t = F.trim(c)
    out = (
        F.when(t.rlike(r"^\d{2}/\d{2}/\d{4}$"), t)
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.regexp_replace(F.substring(t, 1, 10), r"^(\d{4})-(\d{2})-(\d{2})$", "$3/$2/$1"))
        .when(t.rlike(r"^\d{2}[-.]\d{2}[-.]\d{4}$"), F.translate(t, "-.", "//"))
    )
    return F.coalesce(out, F.lit(missing))


def local_closing_time(c: Column, zone: str = "America/Sao_Paulo") -> Column:
    """Closing time given in local clock; any zone written in the text is dropped."""
    bare = F.regexp_replace(F.trim(c), r"(Z|[+-]\d{2}:?\d{2})$", "")
    bare = let(bare, lambda b: F.when(b.rlike(r"^\d{4}-\d{2}-\d{2}"), b).otherwise(c))
    return F.to_utc_timestamp(let(bare, parse_any_timestamp), zone)


def temporal_status(c: Column, as_of, future: str = "future", past: str = "past") -> Column:
    """``future`` from ``as_of`` on; NULL dates count as past."""
    return F.when(c >= F.lit(as_of).cast("timestamp"), F.lit(future)).otherwise(F.lit(past))


def age_class(c: Column, as_of) -> Column:
    now = F.lit(as_of).cast("timestamp")
    return (
        F.when(c > now - F.expr("INTERVAL 1 HOUR"), F.lit("recent"))
        .when(c > now - F.expr("INTERVAL 24 HOURS"), F.lit("today"))
        .otherwise(F.lit("old"))
    )


def duration_seconds(start: Column, end: Column, as_of) -> Column:
    """Seconds from start to end, or to ``as_of`` while still running."""
    stop = F.coalesce(end, F.lit(as_of).cast("timestamp"))
    return F.unix_timestamp(stop) - F.unix_timestamp(start)
