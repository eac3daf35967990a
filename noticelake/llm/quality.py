"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

Symbols are the bytes of UTF-8, so an n-gram of up to seven is an exact 64-bit number and no text has
unknown symbols. The model is a set of tables joined by n-gram, each as long as its number of distinct
n-grams: counts of the highest order over all trusted text, numbers of distinct left neighbours for
the lower orders, discounts from the counts of counts, and what a context leaves to the next order.

Scoring looks up the ``HOT`` most frequent n-grams inside the scan, a table of fixed size. All other
n-grams of a document go, once each with their count, to a join with the model, sharded by n-gram.
A document's perplexity is drawn to the mean of its language by ``PRIOR`` bytes, so that a few words
decide little, and is held against a quantile of the trusted documents of the same language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.llm import bitfilter
from noticelake.llm.store import Scratch
from noticelake.llm.words import slices, text_bytes
from noticelake.llm.workers import released

ORDER, HOT, FLUSH, FILTER_BITS, PRIOR = 5, 1 << 18, 1 << 20, 1 << 21, 60.0
#: Bytes of text that are worked on at once: every byte takes about a hundred in the arrays of a scan.
SLICE = 1 << 18
FEW = 200
#: Languages up to which their figures are sent to every task.
LANGUAGES = 1 << 16
SYMBOLS = 256


# ---------------------------------------------------------------- n-grams of bytes
def grams(data: np.ndarray, off: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each byte, as a number; before a text's start stand zero bytes."""
    place = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
    key = data.astype(np.int64)
    for j in range(1, order):
        before = np.zeros(len(data), np.int64)
        before[j:] = data[: len(data) - j]
        before[place < j] = 0
        key |= before << (8 * j)
    return key


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        key, count = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_pydict({"gram": key, "a": count.astype(np.int64)})

    for batch in batches:
        for part in slices(batch, "text", SLICE):
            held.append(grams(*text_bytes(part.column("text"))))
            if sum(map(len, held)) >= FLUSH:
                yield flush()
    if held:
        yield flush()


class HotTable:
    """Log-probabilities of a bounded number of n-grams, by open addressing."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        bits = max(4, int(2 * max(1, len(key))).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.value, self.steps = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits), 0
        left = np.arange(len(key))
        while len(left):
            at = (self._home(key[left]) + self.steps) & self.mask
            free = np.flatnonzero(self.key[at] == -1)
            at, first = np.unique(at[free], return_index=True)
            placed = left[free[first]]
            self.key[at], self.value[at] = key[placed], value[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            self.steps += 1

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where there is none), and the places without one."""
        out, left, at = np.zeros(len(key)), np.arange(len(key)), self._home(key)
        missing = []
        for _ in range(self.steps):
            here = self.key[at]
            hit = here == key[left]
            out[left[hit]] = self.value[at[hit]]
            missing.append(left[here == -1])
            on = ~hit & (here != -1)
            left, at = left[on], (at[on] + 1) & self.mask
            if not len(left):
                break
        return out, np.sort(np.concatenate([*missing, left]))


def _scored(hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HotTable(*hot.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, off = text_bytes(part.column("text"))
                n = np.diff(off)
                value, miss = table.look_up(key := grams(data, off))
                total = np.add.reduceat(np.append(value, 0.0), np.minimum(off[:-1], len(value))) if len(n) else np.zeros(0)
                total[n == 0] = 0.0
                doc = np.repeat(np.arange(len(n)), n)[miss]
                pair, count = np.unique((doc.astype(np.int64) << (8 * ORDER)) | key[miss], return_counts=True)
                ends = np.searchsorted(pair >> (8 * ORDER), np.arange(len(n) + 1)).astype(np.int32)
                rest = pa.array(pair & ((1 << (8 * ORDER)) - 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("hash"), part.column("lang"), pa.array(n), pa.array(total),
                        pa.ListArray.from_arrays(pa.array(ends), rest), pa.ListArray.from_arrays(pa.array(ends), pa.array(count.astype(np.int32))),
                    ],
                    ["id", "hash", "lang", "n", "hot", "grams", "counts"],
                )

    return run


SCORED = "id bigint, hash bigint, lang string, n bigint, hot double, grams array<bigint>, counts array<int>"


# ---------------------------------------------------------------- model
def _low(gram: Column | str, symbols: int) -> Column:
    """The last symbols of an n-gram."""
    return (F.col(gram) if isinstance(gram, str) else gram).bitwiseAND(F.lit((1 << (8 * symbols)) - 1))


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams that count 1 to 4; 0.5, 1, 1.5 where these say nothing."""
    n = table.agg(*[F.sum((F.col("a") == i).cast("bigint")).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in n)
    if not n1 or not n2 or not n3:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(x, 1e-3), i + 1 - 1e-3) for i, x in enumerate(d))  # type: ignore[return-value]


class Model:
    """``seen[k]``: (gram, logp) of order k; ``left[k]``: (context, loggamma) of contexts of k symbols."""

    def __init__(self, counts: DataFrame, scratch: Scratch, order: int = ORDER):
        adjusted = {order: counts}
        for k in range(order - 1, 0, -1):
            adjusted[k] = scratch.save(adjusted[k + 1].groupBy(_low("gram", k).alias("gram")).agg(F.count(F.lit(1)).alias("a")), f"adjusted{k}")
        self.seen: dict[int, DataFrame] = {}
        self.left: dict[int, DataFrame] = {}
        self.order = order
        for k in range(1, order + 1):
            d1, d2, d3 = _discounts(adjusted[k])
            t = adjusted[k].withColumn("context", F.shiftright("gram", 8))
            a = F.col("a")
            take = F.when(a == 1, d1).when(a == 2, d2).otherwise(d3)
            per = t.groupBy("context").agg(F.sum("a").alias("s"), F.sum(take).alias("d")).withColumn("gamma", F.col("d") / F.col("s"))
            per = scratch.save(per.select("context", "s", "gamma"), f"contexts{k - 1}")
            self.left[k - 1] = per.select("context", F.log("gamma").alias("loggamma"))
            t = t.join(per, "context")
            if k == 1:
                lower = F.lit(1.0 / SYMBOLS)
            else:
                t = t.join(self.seen[k - 1].select(F.col("gram").alias("_lower"), F.col("logp").alias("_logp")), _low("gram", k - 1) == F.col("_lower"))
                lower = F.exp("_logp")
            logp = F.log((a - take) / F.col("s") + F.col("gamma") * lower)
            self.seen[k] = scratch.save(t.select("gram", logp.alias("logp"), "a"), f"seen{k}")

    def resolve(self, wanted: DataFrame) -> DataFrame:
        """(gram, logp) of distinct n-grams of the highest order, seen or not: backs off from order to order."""
        at = wanted.select("gram", F.lit(0.0).alias("sum"), F.lit(False).alias("done"))
        for k in range(self.order, 0, -1):
            seen = self.seen[k].select(F.col("gram").alias("_g"), F.col("logp").alias("_p"))
            left = self.left[k - 1].select(F.col("context").alias("_c"), F.col("loggamma").alias("_l"))
            at = at.join(seen, _low("gram", k) == F.col("_g"), "left")
            at = at.join(left, F.shiftright(_low("gram", k), 8) == F.col("_c"), "left")
            step = F.when(F.col("done"), 0.0).when(F.col("_p").isNotNull(), F.col("_p")).otherwise(F.coalesce("_l", F.lit(0.0)))
            at = at.select("gram", (F.col("sum") + step).alias("sum"), (F.col("done") | F.col("_p").isNotNull()).alias("done"))
        return at.select("gram", F.when(F.col("done"), F.col("sum")).otherwise(F.col("sum") - float(np.log(SYMBOLS))).alias("logp"))


# ---------------------------------------------------------------- classifier
def _slot(c: str) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))


def trusted_text(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Texts of the documents whose ids are in ``trusted`` (id).

    A bit filter of fixed size drops most other texts in the scan; the join then decides.
    """
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(bitfilter.build(trusted.select(_slot("id").alias("slot")), FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = bitfilter.holds(wanted.value, batch.column("slot").to_numpy())
            yield batch.select(["id", "text"]).filter(pa.array(mask))

    rows = docs.where("id is not null").select("id", "text", _slot("id").alias("slot")).mapInArrow(released(run), "id bigint, text string")
    return rows.join(trusted.hint("merge"), "id", "left_semi").select("text")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    good: str = "quality = 1",
    quantile: float = 0.995,
    margin: float = 1.03,
    calibrate: int | None = 2,
) -> DataFrame:
    """Returns (id_col, text_hash, lang, n_bytes, perplexity, threshold, accepted), one row for each distinct (id, text, language).

    The model is trained on the texts of ``labels`` (id_col and the columns of ``good``) that are good, but for one
    in ``calibrate`` by a hash of the id: a text is less perplexing to a model that has read it, so thresholds come from good
    texts that it has not read. ``threshold`` is ``margin`` times the ``quantile`` of their perplexity in the language; a
    language with fewer than ``FEW`` of them takes that over all languages where it is larger. Null languages are one language. A null or empty text has no
    perplexity and is not accepted. Null ids are scored, but never trained on. Without any good text
    every text is accepted. Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang")
    )
    ids = labels.where(good).where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id")).distinct()
    ids = scratch.save(ids, "trusted")
    held_out = ids
    if calibrate:
        aside = F.pmod(F.xxhash64("id", F.lit(23)), F.lit(calibrate)) == 0
        if not ids.where(aside).isEmpty() and not ids.where(~aside).isEmpty():
            ids, held_out = ids.where(~aside), ids.where(aside)
    counts = trusted_text(rows, ids).mapInArrow(released(_counted), "gram bigint, a bigint").groupBy("gram").agg(F.sum("a").alias("a"))
    model = Model(scratch.save(counts, "counts"), scratch)

    top = model.seen[ORDER]
    level = F.floor(F.log2("a") * 8).cast("int")
    room, least = HOT, None
    for r in top.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # a few hundred levels
        room -= r["count"]
        if room < 0:
            break
        least = r["level"]
    held = np.zeros(0, np.int64), np.zeros(0)
    if least is not None:
        hot = top.where(level >= least).select("gram", "logp").toArrow()  # at most HOT rows
        held = hot["gram"].to_numpy(), hot["logp"].to_numpy()
    shared = spark.sparkContext.broadcast(held)

    key = ["id", "hash", "lang"]
    scored = rows.withColumn("hash", F.xxhash64(F.coalesce("text", F.lit("")))).select("id", "hash", "lang", "text").mapInArrow(released(_scored(shared)), SCORED)
    scored = scratch.save(scored, "scored")
    rest = scored.where(F.size("grams") > 0).select(*key, F.explode(F.arrays_zip("grams", "counts")).alias("g"))
    rest = rest.select(*key, F.col("g.grams").alias("gram"), F.col("g.counts").alias("count"))
    known = scratch.save(model.resolve(rest.select("gram").distinct()), "resolved")
    # One plan at every size: documents and n-grams both grow, so neither side is ever broadcast.
    tail = rest.join(known.hint("merge"), "gram").groupBy(*key).agg(F.sum(F.col("count") * F.col("logp")).alias("sum"))
    # Repeated rows are one document: each brings the same n-grams, so their sum is divided by the number of rows.
    base = scored.groupBy(*key).agg(F.max("n").alias("n"), F.max("hot").alias("hot"), F.count(F.lit(1)).alias("rows"), F.lit(0.0).alias("sum"))
    none = F.lit(0).cast("bigint")
    both = base.unionByName(tail.select(*key, none.alias("n"), F.lit(0.0).alias("hot"), none.alias("rows"), "sum"))
    total = both.groupBy(*key).agg(F.sum("n").alias("n"), (F.sum("hot") + F.sum("sum") / F.sum("rows")).alias("sum"))
    total = scratch.save(total, "total")

    return _decide(total, held_out, quantile, margin, scratch).withColumnRenamed("id", id_col)


def _with_figures(df: DataFrame, figures: DataFrame) -> DataFrame:
    """``df`` with the figures of its language, one row a language.

    Documents are not shuffled by language, of which one may hold most, but where there are more than ``LANGUAGES`` of them.
    """
    few = figures.limit(LANGUAGES + 1).count() <= LANGUAGES
    return df.join(F.broadcast(figures) if few else figures, "lang", "left")


def _decide(total: DataFrame, ids: DataFrame, quantile: float, margin: float, scratch: Scratch) -> DataFrame:
    good = total.join(ids, "id", "left_semi").where("n > 0")
    mean = scratch.save(good.groupBy("lang").agg((-F.sum("sum") / F.sum("n")).alias("mean")), "mean")
    mean_all = good.agg((-F.sum("sum") / F.sum("n")).alias("mean_all"))

    def smooth(df: DataFrame) -> DataFrame:
        df = _with_figures(df, mean).join(F.broadcast(mean_all))  # one row
        rate = (-F.col("sum") + PRIOR * F.coalesce("mean", "mean_all", F.lit(0.0))) / (F.col("n") + PRIOR)
        return df.withColumn("perplexity", F.when(F.col("n") > 0, F.exp(rate)))

    marks = smooth(good)
    limit = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10000)) * margin
    per = scratch.save(marks.groupBy("lang").agg(limit.alias("own"), F.count(F.lit(1)).alias("n_own")), "per")
    over_all = marks.agg(limit.alias("any"))
    out = _with_figures(smooth(total), per).join(F.broadcast(over_all))  # one row
    threshold = F.when(F.col("n_own") >= FEW, F.col("own")).otherwise(F.greatest("own", "any"))
    return out.select(
        "id", F.col("hash").alias("text_hash"), F.nullif("lang", F.lit("")).alias("lang"), F.col("n").alias("n_bytes"), "perplexity", threshold.alias("threshold"),
        (F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).alias("accepted"),
    )


def keep_accepted(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that were accepted, with the columns of ``docs``."""
    v = verdicts.where("accepted").select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"), F.coalesce("lang", F.lit("")).alias("_lang"))
    d = docs.select(
        F.struct("*").alias("_row"),
        F.col(id_col).alias("_my_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_my_hash"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_my_lang"),
    )
    met = d.join(v, F.col("_my_id").eqNullSafe(F.col("_id")) & (F.col("_my_hash") == F.col("_hash")) & (F.col("_my_lang") == F.col("_lang")), "left_semi")
    return met.select("_row.*")
