"""Removal of long repeats by recompression.

Recompression rewrites a text of words in rounds: runs of one symbol become a symbol, then pairs of
a left and a right symbol do, where a hash of the name decides the side. A name is a hash of what it
stands for, so equal contents have one name on every executor. Each symbol carries its support, the
stretch of words that decided it: two equal passages have equal symbols wherever the support
lies inside, whatever surrounds the passages.

1. After ``ROUNDS`` rounds the symbols with a support that fits into a window are named by it and counted over
   the corpus. A window that holds the support of a symbol that is nowhere else is no repeat.
2. The windows that are left are named by 128 bits and counted over the corpus. One slice of
   texts sends each window once, so a window that is in a third of all texts is a row a slice. Two windows
   of equal names are a repeat.
3. The words that repeats cover are removed.

Step 1 passes its result on in a bit filter of fixed size. A bit that is set by chance leaves a window to
step 2 and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.llm import bitfilter
from noticelake.llm.store import Scratch
from noticelake.llm.words import mix, prefix_sums, slices, split_words, stretch_hash, text_bytes, word_hashes

ROUNDS, ONE_IN = 3, 3
FILTER_BITS, DOC_BITS = 1 << 26, 1 << 21
#: Windows that one part of step 2 holds, about.
PART = 1 << 19


# ---------------------------------------------------------------- recompression
def recompress(name: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and supports [low, high) of the symbols of many texts; ``first`` holds the texts' first words.

    A symbol that a text's edge decided has a support that reaches over it.
    """
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    low = np.arange(len(name))
    high = low + 1
    before, after = first[:-1] - 1, first[1:] + 1
    for r in range(rounds):
        salt = np.uint64((0x9E3779B97F4A7C15 * (r + 1)) & (2**64 - 1))
        if not len(name):
            break
        # runs: decided by their symbols and by both neighbours being others
        new = np.append(True, (name[1:] != name[:-1]) | (doc[1:] != doc[:-1]))
        at = np.flatnonzero(new)
        end = np.append(at[1:], len(name))
        left_edge, right_edge = np.append(True, doc[1:] != doc[:-1])[at], np.append(doc[1:] != doc[:-1], True)[end - 1]
        lo = np.minimum(np.minimum.reduceat(low, at), np.where(left_edge, before[doc[at]], low[at - 1]))
        hi = np.maximum(np.maximum.reduceat(high, at), np.where(right_edge, after[doc[at]], high[np.minimum(end, len(name) - 1)]))
        count = (end - at).astype(np.uint64)
        name = np.where(count > 1, mix(name[at] * np.uint64(0xD1342543DE82EF95) + count + salt), name[at])
        doc, low, high = doc[at], lo, hi
        # pairs of a left and a right symbol; one that stays is decided by the neighbour it might have met
        right = (mix(name ^ salt) & np.uint64(1)) == 1
        same = doc[1:] == doc[:-1]
        pair = np.append(~right[:-1] & right[1:] & same, False)
        second = np.append(False, pair[:-1])
        to_left, to_right = np.append(False, same), np.append(same, False)
        at = np.arange(len(name))
        toward = np.where(right, np.where(to_left, at - 1, at), np.where(to_right, at + 1, at))
        lo = np.minimum(low, low[toward])
        hi = np.maximum(high, high[toward])
        lo = np.where(right & ~to_left, before[doc], lo)
        hi = np.where(~right & ~to_right, after[doc], hi)
        nxt = np.minimum(at + 1, len(name) - 1)
        joined = mix(name * np.uint64(0xAF251AF3B0F025B5) + mix(name[nxt] + salt))
        name = np.where(pair, joined, name)[~second]
        low = np.where(pair, np.minimum(low, low[nxt]), lo)[~second]
        high = np.where(pair, np.maximum(high, high[nxt]), hi)[~second]
        doc = doc[~second]
    return name, low, high


class Words:
    """Words of one slice of texts, their symbols and windows."""

    def __init__(self, column: pa.Array, window: int):
        data, off = text_bytes(column)
        start, end, self.first = split_words(data, off)
        self.window, self.n = window, np.diff(self.first)
        self.names = word_hashes(data, start, end)
        self.sums = prefix_sums(self.names)
        self.second = (data, start, end)

    def tests(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names and supports of the sampled symbols whose support fits into a window."""
        name, low, high = recompress(self.names, self.first)
        drawn = (mix(name) % np.uint64(ONE_IN) == 0) & (high - low <= self.window)
        low, high, name = low[drawn], high[drawn], name[drawn]
        doc = np.searchsorted(self.first, np.maximum(low, 0), side="right") - 1
        inside = (low >= self.first[doc]) & (high <= self.first[np.minimum(doc + 1, len(self.first) - 1)])
        low, high, name = low[inside], high[inside], name[inside]
        return mix(stretch_hash(self.sums, low, high) ^ name), low, high

    def starts(self, kill_low: np.ndarray, kill_high: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold none of the stretches [low, high)."""
        total = len(self.names)
        change = np.zeros(total + 1, np.int64)
        np.add.at(change, np.maximum(kill_high - self.window, 0), 1)
        np.add.at(change, kill_low + 1, -1)
        fits = np.zeros(total, bool)
        for a, b in zip(self.first[:-1], self.first[1:]):
            fits[a : max(a, b - self.window + 1)] = True
        return np.flatnonzero((np.cumsum(change)[:-1] == 0) & fits)

    def window_names(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        other = prefix_sums(word_hashes(*self.second, which=1), which=1)
        return stretch_hash(self.sums, starts, starts + self.window), stretch_hash(other, starts, starts + self.window, which=1)


def slots_of(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = np.uint64(FILTER_BITS - 1)
    return (name & half).astype(np.int64), ((name >> np.uint64(32)) & half).astype(np.int64)


# ---------------------------------------------------------------- Spark steps
def _name_symbols(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                name, count = np.unique(Words(part.column("text"), window).tests()[0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"name": name.view(np.int64), "n": np.minimum(count, 2).astype(np.int64)})

    return run


SENT = "part bigint, slice bigint, h1 binary, h2 binary, doc binary, start binary, ids array<bigint>, hashes array<bigint>"


def _name_windows(window: int, shared, parts: int):
    """Rows for step 2: windows by part; and, one for each slice, its documents with the windows it found repeated itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for texts in slices(batch, "text"):
                number += 1
                w = Words(texts.column("text"), window)
                name, low, high = w.tests()
                a, b = slots_of(name)
                alone = ~(bitfilter.holds(shared.value, a) & bitfilter.holds(shared.value, b))
                starts = w.starts(low[alone], high[alone])
                h1, h2 = w.window_names(starts)
                order = np.lexsort((h2, h1))
                new = np.append(True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]))[: len(order)]
                group = np.cumsum(new) - 1
                several = np.bincount(group)[group] > 1 if len(order) else new
                doc = np.searchsorted(w.first, starts, side="right") - 1
                place = starts - w.first[doc]

                here = np.sort(order[several])
                first = np.sort(order[new])  # one of each name, in the order of the text
                local = np.zeros(len(starts), bool)
                local[here] = True
                part = (h1[first] % np.uint64(parts)).astype(np.int64)
                by_part = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[by_part], np.arange(parts + 1))
                rows: dict[str, list] = {k: [] for k in ("part", "slice", "h1", "h2", "doc", "start", "ids", "hashes")}

                def add(p: int, x1: bytes, x2: bytes, d: np.ndarray, s: np.ndarray, ids: list, hashes: list) -> None:
                    for k, v in zip(rows, (p, number, x1, x2, np.diff(d, prepend=0).astype("<u2" if len(w.n) < 65536 else "<u4").tobytes(), s.astype("<u4").tobytes(), ids, hashes)):
                        rows[k].append(v)

                for p in np.flatnonzero(np.diff(cuts)):
                    i = first[by_part[cuts[p] : cuts[p + 1]]]
                    # a window known to be repeated is sent for the others: its place is 0, places count from 1
                    add(int(p), h1[i].tobytes(), h2[i].tobytes(), doc[i], np.where(local[i], 0, place[i] + 1), [], [])
                if len(starts):
                    ids, hashes = texts.column("id").to_pylist(), texts.column("hash").to_pylist()
                    add(number % parts, b"", b"", doc[here], place[here] + 1, ids, hashes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows["part"], pa.int64()), pa.array(rows["slice"], pa.int64()), *[pa.array(rows[k], pa.binary()) for k in ("h1", "h2", "doc", "start")],
                        *[pa.array(rows[k], pa.list_(pa.int64())) for k in ("ids", "hashes")],
                    ],
                    ["part", "slice", "h1", "h2", "doc", "start", "ids", "hashes"],
                )

    return run


FOUND = "slice bigint, doc binary, start binary, ids array<bigint>, hashes array<bigint>"


def _docs_of(delta: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(delta, "<u2" if len(delta) == 2 * n else "<u4").astype(np.int64))


def _count_windows(rows: pa.Table) -> pa.Table:
    """Of one part: the windows that stand in several slices."""
    rows = rows.combine_chunks()
    own = [i for i, ids in enumerate(rows.column("ids")) if len(ids)]
    sent = [i for i in range(rows.num_rows) if i not in set(own)]
    h1 = np.concatenate([np.frombuffer(rows.column("h1")[i].as_py(), np.uint64) for i in sent]) if sent else np.zeros(0, np.uint64)
    h2 = np.concatenate([np.frombuffer(rows.column("h2")[i].as_py(), np.uint64) for i in sent]) if sent else np.zeros(0, np.uint64)
    order = np.lexsort((h2, h1))
    new = np.append(True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]))[: len(order)]
    again = np.zeros(len(order), bool)
    if len(order):
        group = np.cumsum(new) - 1
        again[order] = np.bincount(group)[group] > 1
    out: dict[str, list] = {k: [] for k in ("slice", "doc", "start", "ids", "hashes")}
    at = 0
    for i in sent:
        start = np.frombuffer(rows.column("start")[i].as_py(), "<u4")
        doc = _docs_of(rows.column("doc")[i].as_py(), len(start))
        keep = again[at : at + len(start)] & (start > 0)
        at += len(start)
        if keep.any():
            for k, v in zip(out, (rows.column("slice")[i].as_py(), np.diff(doc[keep], prepend=0).astype("<u4").tobytes(), start[keep].tobytes(), [], [])):
                out[k].append(v)
    for i in own:
        start = rows.column("start")[i].as_py()
        doc = _docs_of(rows.column("doc")[i].as_py(), len(start) // 4)
        for k, v in zip(out, (rows.column("slice")[i].as_py(), np.diff(doc, prepend=0).astype("<u4").tobytes(), start, rows.column("ids")[i].as_py(), rows.column("hashes")[i].as_py())):
            out[k].append(v)
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    return pa.table({k: pa.array(out[k], t) for k, t in zip(out, kinds)})


RUNS = "id bigint, hash bigint, runs array<int>"


def _cover(window: int):
    """Of one slice: the words that repeats cover, as runs [first, end) one after the other."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        doc, start, ids, hashes = [], [], [], []
        for d, s, i, h in zip(*(rows.column(k).to_pylist() for k in ("doc", "start", "ids", "hashes"))):
            start.append(np.frombuffer(s, "<u4").astype(np.int64) - 1)
            doc.append(np.cumsum(np.frombuffer(d, "<u4").astype(np.int64)))
            if i:
                ids, hashes = i, h
        doc_all, start_all = np.concatenate(doc), np.concatenate(start)
        order = np.lexsort((start_all, doc_all))
        doc_all, start_all = doc_all[order], start_all[order]
        out_id, out_hash, out_runs = [], [], []
        for a, b in zip(*(lambda c: (c[:-1], c[1:]))(np.append(np.flatnonzero(np.append(True, doc_all[1:] != doc_all[:-1])), len(doc_all)).tolist() if len(doc_all) else [0])):
            s = start_all[a:b]
            new = np.append(True, s[1:] > s[:-1] + window)
            ends = np.append(s[np.flatnonzero(new)[1:] - 1], s[-1]) + window
            out_id.append(ids[doc_all[a]])
            out_hash.append(hashes[doc_all[a]])
            out_runs.append(np.stack([s[new], ends], axis=1).ravel().astype(np.int32))
        return pa.table({"id": pa.array(out_id, pa.int64()), "hash": pa.array(out_hash, pa.int64()), "runs": pa.array(out_runs, pa.list_(pa.int32()))})

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            n_words, n_removed, kept = [], [], []
            for text, runs in zip(part.column("text").to_pylist(), part.column("runs").to_pylist()):
                words = (text or "").encode().split()
                n, gone = len(words), 0
                for a, b in reversed(list(zip(runs[::2], runs[1::2])) if runs else []):
                    gone += b - a
                    del words[a:b]
                n_words.append(n)
                n_removed.append(gone)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"]
            )


def _slot(bits: int) -> Column:
    return F.pmod(F.xxhash64("id", "hash"), F.lit(bits)).alias("slot")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """(id, hash, runs) of the documents with repeated windows: runs of words to remove, [first, end) one after the other.

    ``hash`` is that of the text, which tells apart texts of one id. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    rows = _rows(docs, id_col, text_col)
    names = rows.select("text").mapInArrow(_name_symbols(window), "name bigint, n bigint").groupBy("name").agg(F.sum("n").alias("n"))
    names = scratch.save(names, "names")
    shared = names.where("n > 1")
    halves = [F.col("name").bitwiseAND(F.lit(FILTER_BITS - 1)), F.shiftrightunsigned("name", 32).bitwiseAND(F.lit(FILTER_BITS - 1))]
    bits = bitfilter.build(shared.select(F.explode(F.array(*halves)).alias("slot")), FILTER_BITS)
    symbols = names.agg(F.sum("n")).first()[0] or 0
    parts = max(1, int(symbols) * 3 // PART)
    sent = rows.mapInArrow(_name_windows(window, spark.sparkContext.broadcast(bits), parts), SENT)
    found = sent.groupBy("part").applyInArrow(_count_windows, FOUND)
    return scratch.save(found.groupBy("slice").applyInArrow(_cover(window), RUNS).distinct(), "runs")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Returns (id_col, n_words, n_removed, kept), one row for each row of ``docs``.

    Each word is removed that is covered by a window of ``window`` consecutive words of its document whose words
    also start anywhere else, in the same document too; ``kept`` joins the other words by one space. Words
    end at ASCII white space and are compared unchanged. A null or empty text has no words. Repeated rows are
    two documents, so their windows are repeats. Null ids take part. An empty table gives an empty result.
    """
    found = find(docs, id_col, text_col, window)
    bits = docs.sparkSession.sparkContext.broadcast(bitfilter.build(found.select(_slot(DOC_BITS)), DOC_BITS))
    rows = _rows(docs, id_col, text_col).withColumn("slot", _slot(DOC_BITS))

    def having(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = bitfilter.holds(bits.value, batch.column("slot").to_numpy()) == wanted
                yield batch.select(["id", "hash", "text"]).filter(pa.array(mask))

        return run

    kinds = "id bigint, hash bigint, text string"
    clean = rows.mapInArrow(having(False), kinds).select("id", "text", F.lit(None).cast("array<int>").alias("runs"))
    r = found.select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), "runs")
    touched = rows.mapInArrow(having(True), kinds)
    touched = touched.join(r, touched.id.eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left").select("id", "text", "runs")
    cut = clean.unionByName(touched).mapInArrow(_cut, "id bigint, n_words bigint, n_removed bigint, kept string")
    return cut.withColumnRenamed("id", id_col)
