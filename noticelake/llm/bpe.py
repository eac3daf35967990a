"""Byte-level BPE encoding and decoding with a public vocabulary file.

A text is cut at special tokens, then into pieces by the vocabulary's pattern. A piece is a doubly
linked list of byte symbols; a priority queue holds the rank and place of every pair that can be
merged. The lowest rank, leftmost first, is taken; an entry whose symbols have changed since is
stale and skipped. Decoding concatenates the byte strings of the ids.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.llm.words import ragged, slices
from noticelake.llm.workers import released

CACHED_PIECES = 400_000
#: Bytes of text that are worked on at once.
SLICE = 1 << 18
#: Fixed value: the pre-tokenization pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others take the code points from 256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Merges and byte strings of one vocabulary file; ``encode_piece`` results are kept up to a bound."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        to_byte = {c: b for b, c in enumerate(letters)}
        ids: dict[str, int] = spec["model"]["vocab"]
        self.of_byte = [ids[c] for c in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] or ()}
        strings = {i: bytes(to_byte[c] for c in s) for s, i in ids.items()} | {i: s.encode() for s, i in self.special.items()}
        table = [strings.get(i, b"") for i in range(max(strings) + 1)]
        self.size = np.array([len(x) for x in table], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.pieces = regex.compile(PATTERN)
        by_length = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None
        self.known: dict[str, bytes] = {}

    def encode_piece(self, piece: bytes) -> list[int]:
        symbol = [self.of_byte[b] for b in piece]
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges, queue = self.merges, []
        for i in range(n - 1):
            if m := merges.get((symbol[i], symbol[i + 1])):
                queue.append((m[0], i, m[1], symbol[i], symbol[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, merged, left, right = heapq.heappop(queue)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue
            symbol[i], symbol[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((merged, symbol[k])):
                    heapq.heappush(queue, (m[0], i, m[1], merged, symbol[k]))
            h = before[i]
            if h >= 0 and (m := merges.get((symbol[h], merged))):
                heapq.heappush(queue, (m[0], h, m[1], symbol[h], merged))
        return [s for s in symbol if s >= 0]

    def _stretch(self, text: str) -> bytes:
        """Ids of a text without special tokens, as little-endian 32-bit integers."""
        pieces, known = self.pieces.findall(text), self.known
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            out = []
            for p in pieces:
                ids = known.get(p)
                if ids is None:
                    ids = np.array(self.encode_piece(p.encode()), "<u4").tobytes()
                    if len(p) <= 64:
                        if len(known) >= CACHED_PIECES:
                            known.clear()
                        known[p] = ids
                out.append(ids)
            return b"".join(out)

    def encode(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return self._stretch(text)
        parts = self.cut.split(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if k % 2 else self._stretch(p) for k, p in enumerate(parts))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes[ragged(self.start[ids], self.size[ids])].tobytes()


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, of which a worker keeps four at most."""
    if path not in _loaded:
        if len(_loaded) >= 4:
            _loaded.clear()
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _forget_pieces() -> None:
    """Empties the kept pieces at a task's end: texts share few but the common ones, and the worker serves other stages."""
    for vocab in _loaded.values():
        vocab.known.clear()


def _add(df: DataFrame, columns: dict[str, T.DataType], column: str, work, instead: bool = False) -> DataFrame:
    """``df`` with ``work`` of one column's values as further columns (they take the place of columns so named); ``instead``: without that one."""
    names = {name.lower() for name in columns}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    if all(f.name != column for f in kept):
        raise ValueError(f"{' or '.join(columns)} would take the place of its own input")
    kept = [f for f in kept if not (instead and f.name == column)]
    schema = T.StructType([*kept, *[T.StructField(name, kind) for name, kind in columns.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, SLICE):
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in kept], *work(part.column(column))], [*[f.name for f in kept], *columns])

    return df.mapInArrow(released(run, _forget_pieces), schema)


def _ids(vocab: Vocabulary, texts: pa.Array) -> list[bytes]:
    return [vocab.encode(t) if t else b"" for t in texts.to_pylist()]


def _texts(vocab: Vocabulary, ids: list[bytes | None]) -> pa.Array:
    return pa.array((None if b is None else vocab.decode(np.frombuffer(b, "<u4")).decode("utf-8", "replace") for b in ids), pa.string())


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Adds ``ids_col``: the ids of the whole text, as binary of little-endian unsigned 32-bit integers.

    Null and empty texts have no ids (empty binary). Rows keep their order and number, repeated rows
    have equal ids, an empty table stays empty. A column already named ``ids_col`` is replaced.
    """
    return _add(docs, {ids_col: T.BinaryType()}, text_col, lambda texts: [pa.array(_ids(vocabulary(path), texts), pa.binary())])


def decode(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds ``text_col``: the text of binary ids; null ids give null, bytes that are no UTF-8 the replacement sign."""
    return _add(rows, {text_col: T.StringType()}, ids_col, lambda column: [_texts(vocabulary(path), column.to_pylist())])


def encode_and_decode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``decode`` of ``encode``, without ``text_col``: a task has one Python worker with one vocabulary for both, not two."""

    def work(texts: pa.Array) -> list[pa.Array]:
        vocab = vocabulary(path)
        ids = _ids(vocab, texts)
        return [pa.array(ids, pa.binary()), _texts(vocab, ids)]

    return _add(docs, {ids_col: T.BinaryType(), decoded_col: T.StringType()}, text_col, work, instead=True)


def digests(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded rows."""
    return rows.select(
        F.col(id_col),
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
