"""Incremental, reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

A line's key is the line without white space around it, with A-Z lower-cased; it is known by 128 bits of its
BLAKE2b digest. The index counts in how many documents a key stands. Inserting documents writes a segment of
counts to add, deleting them one of counts to take away, so any change can be taken back. Keys
in at least ``min_docs`` documents are frequent; a shard's cuckoo filter holds the fingerprints of its
frequent keys, and a change moves only the keys that cross the limit in or out.

Cutting tests the lines of a text in the filters, where nearly all others end. What the filters hold is looked
up in the exact counts, and only keys that are frequent there lose their lines.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm.cuckoo import Cuckoo, Filters
from noticelake.llm.store import Scratch
from noticelake.llm.words import LOWER, slices
from noticelake.sources.snapshots import Snapshots, Version

SHARDS = 256
#: Filters and frequent keys up to this many bytes are held by every task; beyond it keys are joined.
HELD_BYTES = 32 << 20
SALTS = 16
SLICE = 8 << 20

_WHITE, _LOWER = b" \t\n\x0b\x0c\r", LOWER.tobytes()
FILTER = "shard int, filter binary"
SEGMENT = "hi bigint, lo bigint, docs bigint"


def line_keys(text: bytes, least: int) -> tuple[list[bytes], list[bytes]]:
    """Lines of a text, and the digest of each line's key: empty where the key has fewer than ``least`` code points."""
    lines, keys = text.split(b"\n"), []
    for line in lines:
        key = line.strip(_WHITE).translate(_LOWER)
        good = len(key) >= least and (least < 2 or len(key.decode()) >= least)
        keys.append(hashlib.blake2b(key, digest_size=16).digest() if good else b"")
    return lines, keys


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), ">i8").reshape(-1, 2).astype(np.int64)
    return both[:, 0], both[:, 1]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for part in slices(batch, "text", SLICE):
        yield part, [b if b is not None else b"" for b in part.column("text").cast(pa.large_binary()).to_pylist()]


def _counted(least: int, filters=None):
    """Distinct keys of documents and the number of documents with each; with ``filters`` only what they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _texts(batch):
                docs: Counter[bytes] = Counter()
                for text in texts:
                    docs.update({k for k in line_keys(text, least)[1] if k})
                hi, lo = _halves(list(docs))
                n = np.fromiter(docs.values(), np.int64, len(docs))
                if filters is not None:
                    held = filters.value.holds(hi, lo)
                    hi, lo, n = hi[held], lo[held], n[held]
                yield pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(n)], ["hi", "lo", "docs"])

    return run


CUT = "n_lines bigint, n_dropped bigint, kept string"


def _cut_out(texts: list[bytes], least: int, dropped) -> list[pa.Array]:
    """Arrays of ``CUT``; ``dropped`` says which of a text's keys lose their lines."""
    n_lines, n_dropped, kept = [], [], []
    for i, text in enumerate(texts):
        lines, keys = line_keys(text, least)
        gone = dropped(i, keys)
        rest = [line for line, g in zip(lines, gone) if not g]
        n_lines.append(len(lines))
        n_dropped.append(len(lines) - len(rest))
        kept.append(b"\n".join(rest))
    return [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]


def _updated(before: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
    """The filter of one shard after its moves; null where it has no more room."""
    up = moves["up"].to_numpy(bool)
    hi, lo = moves["hi"].to_numpy(np.int64), moves["lo"].to_numpy(np.int64)
    shard = int(before["shard"].iat[0] if len(before) else moves["shard"].iat[0])
    if not len(before):
        made = Cuckoo.build(hi[up], lo[up]).dump()
    else:
        now = Cuckoo.load(before["filter"].iat[0])
        now.delete(hi[~up], lo[~up])
        made = now.dump() if now.insert(hi[up], lo[up]) else None
    return pd.DataFrame({"shard": pd.array([shard], "int32"), "filter": [made]})


def _built(keys: pd.DataFrame) -> pd.DataFrame:
    made = Cuckoo.build(keys["hi"].to_numpy(np.int64), keys["lo"].to_numpy(np.int64)).dump()
    return pd.DataFrame({"shard": pd.array([int(keys["shard"].iat[0])], "int32"), "filter": [made]})


class LineIndex:
    """Counts of line keys over the documents inserted so far, in a folder that all executors reach.

    * A null text is one empty line, as an empty one. White space alone makes an empty key.
    * Keys of fewer than ``min_length`` code points are never counted and never lose their lines.
    * Every row is a document: repeated rows count as often as they are inserted.
    * Deleting what was not inserted is refused and changes nothing.
    * A change is one commit: a job that dies in the middle leaves the index as it was. A change with a ``batch`` id that is
      in the index already does nothing, so it can be run again.
    * Settings are those of the first change; an index opened with others is refused.
    """

    def __init__(self, spark: SparkSession, path: str, min_docs: int = 10, min_length: int = 1, shards: int = SHARDS, held_bytes: int = HELD_BYTES):
        if shards & (shards - 1):
            raise ValueError("shards has to be a power of two")
        self.spark, self.table, self.held_bytes = spark, Snapshots(spark, path), held_bytes
        self.min_docs, self.min_length, self.shards = min_docs, min_length, shards
        self.settings = [min_docs, min_length, shards]
        if self._facts(self.table.newest())["settings"] != self.settings:
            raise ValueError(f"{path} was made with other settings")

    # ------------------------------------------------------------ state
    def _facts(self, version: Version) -> dict:
        return dict(version.facts) or {"settings": self.settings, "batches": []}

    def _segments(self, version: Version) -> list[str]:
        return [f"{self.table.path}/{f}" for name, f in sorted(version.parts.items()) if name != "filters"]

    def _filters(self, version: Version) -> DataFrame:
        if "filters" not in version.parts:
            return self.spark.createDataFrame([], FILTER)
        return self.spark.read.schema(FILTER).parquet(f"{self.table.path}/{version.parts['filters']}")

    def counts(self, version: Version | None = None, keys: DataFrame | None = None) -> DataFrame:
        """(hi, lo, docs) of all keys, or of those in ``keys`` (hi, lo): the sum of all segments."""
        segments = self._segments(version or self.table.newest())
        if not segments:
            return self.spark.createDataFrame([], SEGMENT)
        rows = self.spark.read.schema(SEGMENT).parquet(*segments)
        if keys is not None:
            rows = rows.join(keys.select("hi", "lo"), ["hi", "lo"], "left_semi")
        if len(segments) > 1:
            rows = rows.groupBy("hi", "lo").agg(F.sum("docs").alias("docs"))
        return rows.where("docs <> 0")

    def frequent(self, keys: DataFrame | None = None) -> DataFrame:
        return self.counts(keys=keys).where(F.col("docs") >= self.min_docs).select("hi", "lo")

    def _shard(self):
        return F.col("hi").bitwiseAND(self.shards - 1).cast("int").alias("shard")

    # ------------------------------------------------------------ changes
    def insert(self, docs: DataFrame, text_col: str = "text", batch: str | None = None) -> None:
        self._change(docs, text_col, 1, batch)

    def delete(self, docs: DataFrame, text_col: str = "text", batch: str | None = None) -> None:
        self._change(docs, text_col, -1, batch)

    def _change(self, docs: DataFrame, text_col: str, sign: int, batch: str | None) -> None:
        base = self.table.newest()
        facts = self._facts(base)
        if batch is not None and batch in facts["batches"]:
            return
        found = docs.select(F.col(text_col).alias("text")).mapInArrow(_counted(self.min_length), SEGMENT)
        delta = found.groupBy("hi", "lo").agg((F.sum("docs") * sign).alias("docs"))
        segment = self.table.folder()
        delta.write.parquet(f"{self.table.path}/{segment}")
        delta = self.spark.read.schema(SEGMENT).parquet(f"{self.table.path}/{segment}")

        known = self.counts(base, delta).select("hi", "lo", F.col("docs").alias("before"))
        moved = delta.join(known, ["hi", "lo"], "left") if self._segments(base) else delta.withColumn("before", F.lit(0).cast("bigint"))
        before = F.coalesce("before", F.lit(0))
        after = before + F.col("docs")
        if sign < 0 and not moved.where(after < 0).isEmpty():
            raise ValueError("some of these documents were not inserted")
        was, now = before >= self.min_docs, after >= self.min_docs
        moves = moved.where(was != now).select(self._shard(), "hi", "lo", now.alias("up"))
        filters = self._moved_filters(base, moves, delta)
        name = f"segment-{base.number + 1:012d}"
        batches = facts["batches"] + ([batch] if batch is not None else [])
        self.table.commit(base, {**base.parts, name: segment, "filters": filters}, {**facts, "batches": batches})

    def _moved_filters(self, base: Version, moves: DataFrame, delta: DataFrame) -> str:
        folder, draft = self.table.folder(), self.table.folder()
        groups = self._filters(base).groupBy("shard").cogroup(moves.groupBy("shard"))
        groups.applyInPandas(_updated, FILTER).write.parquet(f"{self.table.path}/{draft}")
        done = self.spark.read.schema(FILTER).parquet(f"{self.table.path}/{draft}")
        full = done.where("filter is null").select("shard")
        if full.isEmpty():
            return draft
        # A full filter is built anew from the exact counts, those of this change included.
        both = self.counts(base).unionByName(delta).groupBy("hi", "lo").agg(F.sum("docs").alias("docs"))
        keys = both.where(F.col("docs") >= self.min_docs).select(self._shard(), "hi", "lo").join(full, "shard", "left_semi")
        built = keys.groupBy("shard").applyInPandas(_built, FILTER)
        done.where("filter is not null").unionByName(built).write.parquet(f"{self.table.path}/{folder}")
        return folder

    def compact(self) -> None:
        """All segments summed into one; counts and filters stay as they are."""
        base = self.table.newest()
        folder = self.table.folder()
        self.counts(base).write.parquet(f"{self.table.path}/{folder}")
        self.table.commit(base, {"filters": base.parts["filters"], f"segment-{base.number + 1:012d}": folder}, self._facts(base))

    # ------------------------------------------------------------ cutting
    def cut(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id_col, n_lines, n_dropped, kept), one row for each row of ``docs``, inserted or not.

        ``kept`` is the text of the lines that stay, joined by a line feed.
        """
        rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
        filters = self._filters(self.table.newest())
        size = filters.agg(F.sum(F.octet_length("filter"))).first()[0] or 0
        if size <= self.held_bytes:
            held = self.spark.sparkContext.broadcast(Filters(self.shards, {r["shard"]: bytes(r["filter"]) for r in filters.collect()}))
            found = rows.select("text").mapInArrow(_counted(self.min_length, held), SEGMENT).select("hi", "lo").distinct()
            frequent = Scratch(self.spark, "lines").save(self.frequent(found), "frequent")
        else:
            frequent = self.frequent()
        if size <= self.held_bytes and frequent.count() * 16 <= self.held_bytes:
            out = self._cut_here(rows, frequent)
        else:
            out = self._cut_joined(rows, frequent)
        return out.withColumnRenamed("_id", id_col)

    def _cut_here(self, rows: DataFrame, frequent: DataFrame) -> DataFrame:
        keys = frequent.toArrow()  # at most ``held_bytes``
        both = np.stack([keys["hi"].to_numpy(), keys["lo"].to_numpy()], 1).astype(">i8")
        known = np.sort(np.frombuffer(both.tobytes(), "S16"))
        shared, least = self.spark.sparkContext.broadcast(known), self.min_length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            drop = {k.ljust(16, b"\0") for k in shared.value.tolist()}
            for batch in batches:
                for part, texts in _texts(batch):
                    cut = _cut_out(texts, least, lambda _, keys: [k in drop for k in keys])
                    yield pa.RecordBatch.from_arrays([part.column("_id"), *cut], ["_id", "n_lines", "n_dropped", "kept"])

        return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, {CUT}")

    def _cut_joined(self, rows: DataFrame, frequent: DataFrame) -> DataFrame:
        """Without anything held in tasks: keys of distinct texts meet the frequent ones, which are salted, as a key can stand in all texts."""
        least = self.min_length

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, texts in _texts(batch):
                    of, keys = [], []
                    for text in texts:
                        own = sorted({k for k in line_keys(text, least)[1] if k})
                        of.extend([hashlib.sha256(text).hexdigest()] * len(own))
                        keys.extend(own)
                    hi, lo = _halves(keys)
                    yield pa.RecordBatch.from_arrays([pa.array(of, pa.string()), pa.array(hi), pa.array(lo)], ["text_sha", "hi", "lo"])

        salt = F.pmod(F.xxhash64("text_sha"), F.lit(SALTS)).cast("int").alias("salt")
        lines = rows.select("text").mapInArrow(keyed, "text_sha string, hi bigint, lo bigint").select("*", salt)
        salted = frequent.select("hi", "lo", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        hit = lines.join(salted.hint("merge"), ["hi", "lo", "salt"]).select("text_sha", "hi", "lo").distinct()
        drops = hit.groupBy("text_sha").agg(F.collect_list(F.struct("hi", "lo")).alias("drops"))
        own_sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
        met = rows.withColumn("text_sha", own_sha).join(drops, "text_sha", "left").select("_id", "text", "drops")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, texts in _texts(batch):
                    of = [{(d["hi"], d["lo"]) for d in ds or ()} for ds in part.column("drops").to_pylist()]

                    def gone(i: int, keys: list[bytes], of=of) -> list[bool]:
                        hi, lo = _halves([k or bytes(16) for k in keys])
                        return [bool(k) and (a, b) in of[i] for k, a, b in zip(keys, hi.tolist(), lo.tolist())]

                    yield pa.RecordBatch.from_arrays([part.column("_id"), *_cut_out(texts, least, gone)], ["_id", "n_lines", "n_dropped", "kept"])

        return met.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, {CUT}")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_length: int = 1) -> DataFrame:
    """All documents inserted into a new index and cut by it; an empty table gives an empty result."""
    index = LineIndex(docs.sparkSession, Scratch(docs.sparkSession, "line-index").path, min_docs, min_length)
    index.insert(docs, text_col)
    return index.cut(docs, id_col, text_col)


