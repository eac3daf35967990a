"""Text columns. Every function maps Column -> Column and stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and what they fold to, position by position.
ACCENTED = "áàãâäåéèêëíìîïóòõôöúùûüçñýÿ"
UNACCENTED = "aaaaaaeeeeiiiiooooouuuucnyy"


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` evaluated once per row.

    A column used inside the lambda of an array function is computed again for every element, so a
    text that is looked up in a word list is bound to a variable first.
    """
    return F.get(F.transform(F.array(c), lambda v: use(v)), F.lit(0))


def blank_to_null(c: Column) -> Column:
    """NULL for NULL, empty and whitespace-only text."""
    return F.when(F.length(F.trim(c)) > 0, c)


def sentinel_to_null(c: Column, sentinels: Iterable[str] = ("N/D",)) -> Column:
    """NULL for blanks and for the given placeholder texts."""
    return F.when((F.length(F.trim(c)) > 0) & ~F.trim(c).isin(list(sentinels)), c)


def is_missing(c: Column) -> Column:
    return c.isNull() | (F.length(F.trim(c.cast("string"))) == 0)


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\s ]+", " "))


def fold_accents(c: Column) -> Column:
    """Lower case without accents; other non-ASCII characters are dropped."""
    plain = F.regexp_replace(F.translate(F.lower(c), ACCENTED, UNACCENTED), r"[^\x00-\x7F]", "")
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(plain)


def contains_any(c: Column, words: Iterable[str]) -> Column:
    """True when ``c`` contains at least one of ``words`` (NULL text counts as no match)."""
    arr = F.array(*[F.lit(w) for w in words])
    return F.coalesce(let(c, lambda t: F.exists(arr, lambda w: F.contains(t, w))), F.lit(False))


def matching_words(c: Column, words: Iterable[str]) -> Column:
    """Those of ``words`` found in ``c``, in the order given."""
    arr = F.array(*[F.lit(w) for w in words])
    return let(c, lambda t: F.filter(arr, lambda w: F.coalesce(F.contains(t, w), F.lit(False))))


def repair_mojibake(c: Column) -> Column:
    """Undo UTF-8 text that was decoded as Latin-1; anything else is returned unchanged."""
    latin = c.rlike(r"^[\x00-\xFF]*$")
    fixed = F.try_validate_utf8(F.encode(F.when(latin, c), "ISO-8859-1"))
    return F.coalesce(fixed, c)


# HTML entities that are turned back into text.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def strip_html(c: Column, max_len: int | None = None) -> Column:
    """Text of an HTML fragment: tags become spaces, entities are decoded, space is collapsed."""
    out = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    for entity, plain in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(plain))
    out = collapse_space(out)
    return F.substring(out, 1, max_len) if max_len else out


def title_case(c: Column) -> Column:
    """Capital after every non-letter, so hyphens and apostrophes start a new word."""
    pieces = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(pieces, F.initcap), "")


# Words kept in lower case inside place names.
PARTICLES = ("da", "das", "de", "del", "do", "dos", "e")


def place_title_case(c: Column) -> Column:
    """Place-name case: particles stay lower except in first position, hyphen parts are capitalised."""
    words = F.split(collapse_space(F.lower(c)), " ")

    def cased(word: Column, i: Column) -> Column:
        parts = F.transform(F.split(word, "-"), lambda p: F.when(p.isin(*PARTICLES), p).otherwise(F.initcap(p)))
        return F.when((i > 0) & word.isin(*PARTICLES), word).otherwise(
            F.when(F.contains(word, F.lit("-")), F.array_join(parts, "-")).otherwise(F.initcap(word))
        )

    return F.array_join(F.transform(words, cased), " ")


def first_match(c: Column, patterns: Iterable[str], group: int = 1) -> Column:
    """First pattern that matches wins; NULL when none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, p, group), F.lit("")) for p in patterns])


def all_matches(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), group)


def first_sentence(c: Column, min_len: int = 20, max_len: int = 500) -> Column:
    """Whole text when short, else its first sentence when that is long enough, else empty."""
    text = F.trim(c)
    head = F.regexp_extract(text, r"^([^.\n]*)", 1)
    return F.when(F.length(text) <= max_len, collapse_space(text)).otherwise(
        F.when(F.length(head) >= min_len, F.substring(collapse_space(head), 1, max_len)).otherwise(F.lit(""))
    )


def first_long_lines(c: Column, n: int = 3, min_len: int = 30, max_len: int = 500) -> Column:
    lines = F.filter(F.transform(F.split(c, r"\n"), lambda x: F.trim(x)), lambda s: F.length(s) > min_len)
    return F.substring(collapse_space(F.array_join(F.slice(lines, 1, n), " ")), 1, max_len)


def head_tail(c: Column, limit: int, head: int, tail: int, marker: str) -> Column:
    """Text over ``limit`` characters shortened to its head, a marker and its tail."""
    return F.when(F.length(c) <= limit, c).otherwise(
        F.concat(F.substring(c, 1, head), F.lit(marker), F.right(c, F.lit(tail)))
    )


def context_snippet(text: Column, needle: Column, around: int = 30, max_len: int = 200) -> Column:
    """Text around the first occurrence of ``needle``, newlines as spaces."""
    at = F.position(needle, text)
    start = F.greatest(at - F.lit(around), F.lit(1))
    stop = at + F.length(needle) + F.lit(around)
    piece = F.substring(text, start, stop - start)
    return F.when(at > 0, F.substring(F.trim(F.replace(piece, F.lit("\n"), F.lit(" "))), 1, max_len))


def preview(parts: Column, sep: str = " | ", max_len: int = 100) -> Column:
    """Array joined by ``sep``; over-long results end in an ellipsis."""
    joined = F.array_join(parts, sep)
    return F.when(F.length(joined) > max_len, F.concat(F.substring(joined, 1, max_len - 3), F.lit("..."))).otherwise(joined)


def safe_name(c: Column, max_len: int = 100) -> Column:
    """ASCII name for a file: accents folded, specials dropped, blanks and hyphens as underscore."""
    plain = F.regexp_replace(F.translate(c, ACCENTED + ACCENTED.upper(), UNACCENTED + UNACCENTED.upper()), r"[^\x00-\x7F]", "")
    plain = F.regexp_replace(plain, r"[^\w\s-]", "")
    return F.substring(F.regexp_replace(plain, r"[-\s]+", "_"), 1, max_len)


def drop_suffix(c: Column, suffix_pattern: str) -> Column:
    return F.trim(F.regexp_replace(c, f"(?iu)(?:{suffix_pattern})$", ""))


def lot_number(c: Column) -> Column:
    """Lot number without a leading word such as ``Lote``, ``Item`` or ``Nº``."""
    return F.trim(F.regexp_replace(collapse_space(c), r"(?iu)^(lote|item|n[°º.]?)\s*", ""))


def content_key(c: Column) -> Column:
    """Key for equal text up to case and spacing."""
    return F.sha2(collapse_space(F.lower(c)), 256)
