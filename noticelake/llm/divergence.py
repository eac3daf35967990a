"""Audit of how the vocabulary of sources diverges, with terms as digests and their strings joined back last.

Counts are shuffled under 64-bit digests of terms. Beside them goes one row a distinct digest and task with the
smallest and largest string seen under it; where these differ once all tasks are put together, strings
collide, and the terms of that digest are counted again under their own strings. All arithmetic is on
whole numbers. Strings of kept terms are joined only to the rows that leave with a term: the first ranks of a group with their ties.

Pairs of sources are compared over all kept terms of a language, though most are absent from most
sources: the value over absent terms is counted, not summed, and each term adds only its differences from that, for
each source that has it and for each two sources that share it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm import bitfilter
from noticelake.llm.store import Scratch
from noticelake.llm.tokens import any_script, counted_pairs, letter_runs
from noticelake.llm.words import slices, word_hashes

SLICE = 8 << 20
FILTER_BITS = 1 << 20
ROWS = "lang string, source string, digest bigint, sub string, n bigint, docs bigint"


def digests(words: pa.Array, bits: int) -> np.ndarray:
    """64-bit digests of distinct words, or their lowest ``bits`` (fewer only where collisions are to be seen)."""
    _, offsets, data = words.buffers()
    off = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    out = word_hashes(data[: off[-1]], off[:-1], off[1:])
    return (out & np.uint64((1 << bits) - 1)).view(np.int64)


def _strings(bits: int):
    """(digest, term) of the distinct terms of each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words, _, _ = letter_runs(part.column("text"), any_script)
                yield pa.RecordBatch.from_arrays([pa.array(digests(words, bits)), words.cast(pa.string())], ["digest", "term"])

    return run


def _counted(bits: int, colliding=None):
    """Rows of ``ROWS``: occurrences and documents of each digest in each group of a slice.

    With ``colliding`` (a bit filter of digests) only terms that it holds, under their own strings as ``sub``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words, codes, doc = letter_runs(part.column("text"), any_script)
                name = digests(words, bits)
                if colliding is not None:
                    held = bitfilter.holds(colliding.value, _slot(name))[codes]
                    doc, codes = doc[held], codes[held]
                at, groups = _groups(part)
                doc, code, n = counted_pairs(doc, codes, len(words))
                key, where = np.unique(at[doc] * max(1, len(words)) + code, return_inverse=True)
                times = np.bincount(where, n, len(key)).astype(np.int64)
                in_docs = np.bincount(where, minlength=len(key)).astype(np.int64)
                group, code = pa.array(key // max(1, len(words))), key % max(1, len(words))
                sub = words.take(pa.array(code)).cast(pa.string()) if colliding is not None else pa.array([""] * len(key), pa.string())
                columns = [c.take(group) for c in groups]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(name[code]), sub, pa.array(times), pa.array(in_docs)], ["lang", "source", "digest", "sub", "n", "docs"]
                )

    return run


def _slot(digest: np.ndarray) -> np.ndarray:
    return digest & (FILTER_BITS - 1)


def _groups(part: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
    """Number of each row's (lang, source), and the columns of these."""
    seen: dict[tuple, int] = {}
    pairs = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
    at = np.array([seen.setdefault(k, len(seen)) for k in pairs], np.int64)
    return at, [pa.array([k[i] for k in seen], pa.string()) for i in (0, 1)]


def share(n: Column, total: Column, kept: Column, scale: int, add: int) -> Column:
    """1 + floor(scale * (n + add) / (total + add * kept)), exact at any size; scale where there is nothing to divide by."""
    whole = total + F.lit(add) * kept
    big = (n + F.lit(add)).cast("decimal(20,0)") * F.lit(scale).cast("decimal(18,0)")
    return F.lit(1) + F.call_function("div", big, F.when(whole > 0, whole).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def counts(rows: DataFrame, scratch: Scratch, bits: int) -> tuple[DataFrame, DataFrame]:
    """((lang, source, digest, sub, n, docs), (digest, sub, term)): ``sub`` is empty but for terms whose digests collide."""
    sums = [F.sum("n").alias("n"), F.sum("docs").alias("docs")]
    plain = scratch.save(rows.mapInArrow(_counted(bits), ROWS).groupBy("lang", "source", "digest", "sub").agg(*sums), "counts")
    strings = rows.select("text").mapInArrow(_strings(bits), "digest bigint, term string").groupBy("digest")
    strings = scratch.save(strings.agg(F.min("term").alias("least"), F.max("term").alias("most")), "strings")
    clash = strings.where("least <> most").select("digest")
    texts = strings.select("digest", F.lit("").alias("sub"), F.col("least").alias("term"))
    if clash.isEmpty():
        return plain, texts
    slots = clash.select(F.col("digest").bitwiseAND(FILTER_BITS - 1).alias("slot"))
    held = rows.sparkSession.sparkContext.broadcast(bitfilter.build(slots, FILTER_BITS))
    again = rows.mapInArrow(_counted(bits, held), ROWS).join(clash, "digest", "left_semi")
    split = scratch.save(again.groupBy("lang", "source", "digest", "sub").agg(*sums), "split")
    named = split.select("digest", "sub", F.col("sub").alias("term")).distinct()
    alone = [t.join(clash, "digest", "left_anti").select(*t.columns) for t in (plain, texts)]
    return alone[0].unionByName(split), alone[1].unionByName(named)


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = 3,
    ranks: int = 200,
    scale: int = 1_000_000_000,
    add: int = 1,
    bits: int = 64,
) -> DataFrame:
    """Returns (lang, source, part, item, value, rank), ranked from 1 in each (lang, source, part).

    A term is kept in a language if at least ``min_docs`` of its documents hold it. With p = 1 + floor(scale * (n + add) / (N + add * V))
    a source's value is floor((p - q)^2 / q): in part ``pair`` the sum over all kept terms against
    another source of the language, in part ``term`` for a kept term that the source uses more than the language does, to ``ranks``.

    * Null texts, languages and sources are ''. Groups without terms take part in pairs; a language of one source has none.
    * Every row is a document; repeated rows count as often as they stand there.
    * Ties go to the smaller item by code points. Any number of ties is kept until strings decide.
    * An empty table gives an empty result. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    clean = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))]
    rows = docs.select(*clean)
    found, texts = counts(rows, scratch, bits)

    by_term = Window.partitionBy("lang", "digest", "sub")
    kept = found.withColumn("in_docs", F.sum("docs").over(by_term)).withColumn("n_lang", F.sum("n").over(by_term)).where(F.col("in_docs") >= min_docs)
    kept = scratch.save(kept.select("lang", "source", "digest", "sub", "n", "n_lang"), "kept")

    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("has"))
    of_lang = kept.select("lang", "digest", "sub", "n_lang").distinct().groupBy("lang").agg(F.sum("n_lang").alias("total_lang"), F.count(F.lit(1)).alias("v"))
    none = F.lit(0).cast("bigint")
    groups = rows.select("lang", "source").distinct().join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "has", "total_lang", "v")])
    zero = share(F.lit(0), F.col("total"), F.col("v"), scale, add)
    groups = scratch.save(groups.withColumn("zero", zero), "groups")

    p = share(F.col("n"), F.col("total"), F.col("v"), scale, add).alias("p")
    terms = kept.join(groups.select("lang", "source", "total", "total_lang", "v", "zero"), ["lang", "source"])
    q = share(F.col("n_lang"), F.col("total_lang"), F.col("v"), scale, add).alias("q")
    terms = scratch.save(terms.select("lang", "source", "digest", "sub", "n", p, q, "zero"), "terms")

    return _pairs(terms, groups, scratch, scale, add).unionByName(_top_terms(terms, texts, ranks))


def _pairs(terms: DataFrame, groups: DataFrame, scratch: Scratch, scale: int, add: int) -> DataFrame:
    a = groups.select("lang", "source", F.col("zero").alias("zero_a"), "v", F.col("total").alias("total_a"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_b"), F.col("total").alias("total_b"))
    pairs = scratch.save(a.join(b, "lang").where("source <> item"), "pairs")
    base = pairs.select("lang", "source", "item", (F.col("v") * gap(F.col("zero_a"), F.col("zero_b"))).alias("value")).where("value is not null")

    # Terms of one source alone: their counts are few, so each count is worked out once for each other source.
    alone = terms.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("k"), F.first("p").alias("p"))
    left = alone.join(pairs, ["lang", "source"]).select("lang", "source", "item", (F.col("k") * (gap(F.col("p"), F.col("zero_b")) - gap(F.col("zero_a"), F.col("zero_b")))).alias("value"))
    mine = alone.withColumnRenamed("source", "item")
    right = mine.join(pairs, ["lang", "item"]).select("lang", "source", "item", (F.col("k") * (gap(F.col("zero_a"), F.col("p")) - gap(F.col("zero_a"), F.col("zero_b")))).alias("value"))

    # Terms of both sources: at most one row a source under each term, so no group is hot.
    one = terms.select("lang", "digest", "sub", "source", F.col("p").alias("p_a"), F.col("zero").alias("zero_a"))
    two = terms.select("lang", "digest", "sub", F.col("source").alias("item"), F.col("p").alias("p_b"), F.col("zero").alias("zero_b"))
    met = one.join(two.hint("merge"), ["lang", "digest", "sub"]).where("source <> item")
    pa_, pb, za, zb = (F.col(c) for c in ("p_a", "p_b", "zero_a", "zero_b"))
    both = met.select("lang", "source", "item", (gap(pa_, pb) - gap(pa_, zb) - gap(za, pb) + gap(za, zb)).alias("value"))
    both = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    values = base.unionByName(left).unionByName(right).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    every = pairs.select("lang", "source", "item").join(values, ["lang", "source", "item"], "left")
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    every = every.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))
    return every.withColumn("rank", F.row_number().over(w))


def _top_terms(terms: DataFrame, texts: DataFrame, ranks: int) -> DataFrame:
    above = terms.where("p > q").select("lang", "source", "digest", "sub", gap(F.col("p"), F.col("q")).cast("bigint").alias("value"))
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    first = above.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") <= ranks)
    named = first.join(texts, ["digest", "sub"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    by_text = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return named.withColumn("rank", F.row_number().over(by_text)).where(F.col("rank") <= ranks)


