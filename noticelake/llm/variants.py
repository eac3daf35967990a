"""Spelling variants by permuterm rotations.

A word is closed by a mark and rotated to every place. Two words that differ in one replaced code point
agree on the rotation that ends in it, up to that last code point; if one has a code point more, the other's
whole rotation is what they agree on. So every rotation stands under its prefix without the last code point, as a
word that has something there, and under itself, as a word that has nothing. Sorted by these prefixes, near
words are neighbours: a range holds all words with one code point of any kind in one place, at most one a letter
of the alphabet, and the one word without it.

Rotations carry ranks in place of words: the place of a word by falling number, then by text. The best near
word is the smallest rank, and texts are joined back at the end. A range hands on numbers and best ranks of its
members, never pairs. An indel inside a repeated letter shows at several places and counts at the last one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.store import Scratch
from noticelake.llm.tokens import counted_pairs, latin, letter_runs
from noticelake.llm.words import slices
from noticelake.operators.ranks import with_rank

MARK = "$"
#: Prefixes of more code points than this are held by name, so that a word of n letters takes n rows of bounded width.
WHOLE = 64
SLICE = 4 << 20

_PRIME, _BASE = (1 << 127) - 1, 0x2545F4914F6CDD1D9E3779B97F4A7C15
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


# ---------------------------------------------------------------- words
def crc32_after(start: np.ndarray, words: pa.Array, codes: np.ndarray) -> np.ndarray:
    """CRC-32 of the word of each code, going on from the sums in ``start``."""
    _, offsets, data = words.buffers()
    off = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at, size = off[codes], off[codes + 1] - off[codes]
    out = start.astype(np.uint32)
    long = np.flatnonzero(size > WHOLE)
    for i in long.tolist():
        out[i] = zlib.crc32(data[at[i] : at[i] + size[i]], int(out[i]))
    now = np.flatnonzero(size <= WHOLE)
    sums = ~out
    step = 0
    while len(now := now[size[now] > step]):
        sums[now] = _CRC[(sums[now] ^ data[at[now] + step]) & 0xFF] ^ (sums[now] >> np.uint32(8))
        step += 1
    short = size <= WHOLE
    out[short] = ~sums[short]
    return out


def _counted(one_in: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words, codes, doc = letter_runs(part.column("text"), latin)
                doc, code, n = counted_pairs(doc, codes, len(words))
                prefix = [zlib.crc32(b"%s:" % (i or "").encode()) for i in part.column("id").to_pylist()]
                hit = crc32_after(np.array(prefix, np.uint32)[doc], words, code) if len(code) else np.zeros(0, np.uint32)
                marked = hit % np.uint32(one_in) == 0
                whole = np.bincount(code[~marked], n[~marked], len(words)).astype(np.int64)
                cut: Counter[str] = Counter()
                texts = words.take(pa.array(code[marked])).to_pylist()
                for word, h, k in zip(texts, hit[marked].tolist(), n[marked].tolist()):
                    at = h % len(word)
                    cut[word[:at] + word[at + 1 :]] += k
                size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
                kept = pa.array((whole > 0) & (size >= least))
                out = [w for w in cut if len(w) >= least]
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([words.filter(kept).cast(pa.string()), pa.array(out, pa.string())]),
                     pa.concat_arrays([pa.array(whole).filter(kept), pa.array([cut[w] for w in out], pa.int64())])],
                    ["word", "n"],
                )

    return run


def vocabulary(docs: DataFrame, id_col: str, text_col: str, least: int, often: int, one_in: int) -> DataFrame:
    """(word, n, rank) of the words of at least ``least`` code points that occur ``often`` times.

    In one of ``one_in`` pairs of document and word a code point is left out, as a slip of the pen: the pair's CRC-32 says
    in which and where.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    n = rows.mapInArrow(_counted(one_in, least), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return with_rank(n.where(F.col("n") >= often), F.col("n").desc(), F.col("word").asc())


# ---------------------------------------------------------------- rotations
def _names(word: str) -> Iterator[tuple[str, str]]:
    """For each place of a long word the names of the rotation that starts there and of the one that skips the code point there."""
    n = len(word)
    head, power = [0] * (n + 1), [1] * (n + 2)
    for i, c in enumerate(word):
        head[i + 1] = (head[i] * _BASE + ord(c)) % _PRIME
    for i in range(n + 1):
        power[i + 1] = power[i] * _BASE % _PRIME

    def name(to: int, start: int) -> str:
        tail = (head[n] - head[start] * power[n - start]) % _PRIME
        return f"#{n - start + to + 1:x}.{((tail * _BASE + ord(MARK)) * power[to] + head[to]) % _PRIME:x}"

    for i in range(n + 1):
        yield name(i, i), name(i, i + 1) if i < n else ""


def rotations(word: str, whole: int = WHOLE) -> Iterator[tuple[str, int, bool]]:
    """(prefix, kind, twin): kind 0 has a code point after the prefix, kind 1 has none; a twin is a code point like the one after it."""
    n = len(word)
    names = _names(word) if n >= whole else (("", ""),) * (n + 1)
    for i, (full, skipping) in enumerate(names):
        yield (word[i:] + MARK + word[:i] if n < whole else full), 1, False
        if i < n:
            yield (word[i + 1 :] + MARK + word[:i] if n <= whole else skipping), 0, i + 1 < n and word[i + 1] == word[i]


def _rotated(whole: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list) -> pa.RecordBatch:
            prefix, kind, twin, rank = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(prefix, pa.string()), pa.array(kind, pa.int32()), pa.array(twin, pa.bool_()), pa.array(rank, pa.int64())],
                ["prefix", "kind", "twin", "rank"],
            )

        rows: list = []
        for batch in batches:
            for word, rank in zip(batch.column("word").to_pylist(), batch.column("rank").to_pylist()):
                for prefix, kind, twin in rotations(word, whole):
                    rows.append((prefix, kind, twin, rank))
                    if len(rows) >= 1 << 16:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    return run


def near(words: DataFrame, whole: int = WHOLE) -> DataFrame:
    """(rank, n_near, best) of the words (word, rank) that have near words; ``best`` is the smallest rank of these."""
    rows = words.select("word", "rank").mapInArrow(_rotated(whole), "prefix string, kind int, twin boolean, rank bigint")
    w = Window.partitionBy("prefix").orderBy("kind", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    some = F.col("kind") == 0
    scan = rows.select(
        "kind", "twin", "rank",
        F.sum(F.when(some, 1).otherwise(0)).over(w).alias("having"),
        F.first("rank").over(w).alias("first"),
        F.nth_value("rank", 2).over(w).alias("second"),
        F.max(F.when(~some, F.col("rank"))).over(w).alias("lacking"),
        F.max(F.when(F.col("twin"), F.col("rank"))).over(w).alias("twin_rank"),
    )

    def best_but(rank):
        """The smallest rank among those that have a code point there, other than ``rank``."""
        other = F.when(F.col("first") != F.coalesce(rank, F.lit(-1)), F.col("first")).when(F.col("having") >= 2, F.col("second"))
        return F.when(F.col("having") >= 1, other)

    lacking = F.when(~F.col("twin"), F.col("lacking"))
    found = scan.select(
        "rank",
        F.when(some, F.col("having") - 1 + lacking.isNotNull().cast("int")).otherwise(F.col("having") - F.col("twin_rank").isNotNull().cast("int")).alias("n"),
        F.when(some, F.least(best_but(F.col("rank")), lacking)).otherwise(best_but(F.col("twin_rank"))).alias("best"),
    )
    return found.where("n > 0").groupBy("rank").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(rank, root) of all ranks that have a form: each round doubles the steps that are followed."""
    now, round_no = scratch.save(forms.select("rank", F.col("form").alias("root")), "roots0"), 0
    while True:
        onward = now.select(F.col("rank").alias("_rank"), F.col("root").alias("_root"))
        step = now.join(onward, F.col("root") == F.col("_rank"), "left")
        if step.where(F.col("_root").isNotNull()).isEmpty():
            return now
        round_no += 1
        now = scratch.save(step.select("rank", F.coalesce("_root", "root").alias("root")), f"roots{round_no}")


def group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 6,
    often: int = 5,
    times: int = 5,
    one_in: int = 199,
    whole: int = WHOLE,
) -> DataFrame:
    """Returns (word, form, root, n, n_near, form_n), one row for each word of the vocabulary.

    Words are runs of Latin letters (``[A-Za-z\\u00C0-\\u00FF]``) with A-Z lower-cased, after one code point was
    left out of one in ``one_in`` pairs of document and word. Near words differ in one inserted, deleted or replaced
    code point; a word's form is the most frequent of them if it is ``times`` as frequent, ties to the smaller text.

    * Null and empty texts have no words. A null id stands as nothing before the colon.
    * Repeated rows are rows: their words count as often as they stand there.
    * Words of any length take part; rotations of more than ``whole`` code points are held by 127-bit names.
    * Without words the result is empty. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "variants")
    words = scratch.save(vocabulary(docs, id_col, text_col, least, often, one_in), "words")
    around = scratch.save(near(words, whole), "near")
    by_rank = words.select(F.col("rank").alias("_rank"), F.col("n").alias("_n"), F.col("word").alias("_word"))
    own = words.join(around, "rank", "left").join(by_rank, F.col("best") == F.col("_rank"), "left")
    good = F.col("_n") >= F.col("n") * times
    rows = own.select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best")).alias("form_rank"),
                      F.when(good, F.col("_word")).alias("form"), F.when(good, F.col("_n")).alias("form_n"))
    rows = scratch.save(rows, "forms")
    last = roots(rows.where("form_rank is not null").select("rank", F.col("form_rank").alias("form")), scratch)
    named = last.join(words.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root").select("rank", "root_word")
    return rows.join(named, "rank", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
