"""Token ids in files of fixed-width packed bits.

A file holds the documents of one range of ids in ascending order:

    header      8 unsigned 64-bit numbers: magic, version, bits, documents, ids, ids a block, blocks, 0
    documents   ids (signed 64 bits), 1 byte each whether the id is set, ends of the documents (unsigned 64 bits)
    blocks      offset of every block from the first one, and the end of the last (unsigned 64 bits)
    data        blocks of ``BLOCK`` ids, ``bits`` bits an id, lowest bit first

``bits`` is the least that holds every id of the vocabulary. Eight ids fill ``bits`` whole bytes, so
numpy packs and unpacks columns of bytes; any stretch of ids needs its own blocks alone.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticelake.llm.store import Scratch
from noticelake.llm.words import LOWER, SPACE, ragged, slices, split_words, text_bytes, word_hashes

MAGIC, VERSION, BLOCK = 0x4B4341504E454B4F, 1, 4096
CACHED_PIECES = 400_000


# ---------------------------------------------------------------- bits
def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def _places(bits: int) -> Iterator[tuple[int, int, int]]:
    """(id of eight, byte of the group, shift of the id's bits in it)."""
    for i in range(8):
        for b in range(i * bits // 8, ((i + 1) * bits - 1) // 8 + 1):
            yield i, b, i * bits - 8 * b


def pack(ids: np.ndarray, bits: int) -> bytes:
    groups = np.zeros((len(ids) + 7) // 8 * 8, np.uint64)
    groups[: len(ids)] = ids
    groups = groups.reshape(-1, 8)
    out = np.zeros((len(groups), bits), np.uint8)
    for i, b, shift in _places(bits):
        v = groups[:, i]
        out[:, b] |= (v << np.uint64(shift) if shift >= 0 else v >> np.uint64(-shift)).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(-1, bits)
    out = np.zeros((len(rows), 8), np.uint64)
    for i, b, shift in _places(bits):
        v = rows[:, b].astype(np.uint64)
        out[:, i] |= v >> np.uint64(shift) if shift >= 0 else v << np.uint64(-shift)
    return (out & np.uint64((1 << bits) - 1)).astype("<u4").ravel()[:n]


# ---------------------------------------------------------------- files
def write_file(uri: str, doc_ids: list, ends: np.ndarray, ids: np.ndarray, bits: int) -> None:
    """Writes under another name and moves it: a task that is run again replaces whole files by equal ones."""
    blocks = (len(ids) + BLOCK - 1) // BLOCK
    packed = pack(ids, bits)
    offsets = np.minimum(np.arange(blocks + 1) * (BLOCK * bits // 8), len(packed)).astype("<u8")
    head = np.array([MAGIC, VERSION, bits, len(doc_ids), len(ids), BLOCK, blocks, 0], "<u8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{os.path.dirname(path)}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as f:
        for part in (head, numbers, known, ends.astype("<u8"), offsets):
            f.write(part.tobytes())
        f.write(packed)
    fs.move(draft, path)


class PackedFile:
    """Random access to one file."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.f = fs.open_input_file(path)
        head = np.frombuffer(self.f.read_at(64, 0), "<u8").astype(int)
        if head[0] != MAGIC or head[1] != VERSION:
            raise ValueError(f"{uri} is no packed token file")
        _, _, self.bits, docs, self.n_ids, self.block, blocks, _ = map(int, head)
        at = 64

        def array(kind: str, n: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize * n
            out = np.frombuffer(self.f.read_at(size, at), kind)
            at += size
            return out

        self.doc_ids, self.known = array("<i8", docs), array("u1", docs).astype(bool)
        self.ends, self.offsets = array("<u8", docs).astype(np.int64), array("<u8", blocks + 1).astype(np.int64)
        self.data = at

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end) of the file."""
        if end <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (end - 1) // self.block
        a, b = int(self.offsets[first]), int(self.offsets[last + 1])
        n = min(self.n_ids, (last + 1) * self.block) - first * self.block
        ids = unpack(self.f.read_at(b - a, self.data + a), self.bits, n)
        return ids[start - first * self.block : end - first * self.block]


# ---------------------------------------------------------------- encoding
#: The rules of word_bpe_49k, by which words are cut.
RULES = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
)


def matches(path: str) -> bool:
    """Whether a vocabulary file has the rules that ``PieceEncoder`` relies on."""
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    steps = (held.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    first = steps[0]
    cut = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True and first.get("pattern") == RULES[1]
    return held.get("normalizer") == RULES[0] and cut and [s.get("type") for s in steps[1:]] == ["ByteLevel"]


class PieceEncoder:
    """The tokenizers library with its work shared between equal pieces of text.

    The vocabulary's rules never look across white space, so words can be encoded one by one. A word
    of printable ASCII without an apostrophe or "<" is lower-cased and cut further where letters,
    single digits and other signs meet, as the vocabulary's pattern cuts it; every other word is
    given to the library whole. This holds for vocabularies with the rules of
    word_bpe_49k (NFC, lower case, split at white space); a file with others is refused.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        if not matches(path):
            raise ValueError(f"{path} has other rules than those this encoder cuts words by")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}
        kind = np.full(256, 3, np.uint8)
        kind[[*range(65, 91), *range(97, 123)]] = 1
        kind[48:58] = 2
        self.kind = kind
        odd = np.zeros(256, bool)
        odd[[*range(0, 32), 127, 39, 60, *range(128, 256)]] = True
        self.odd = odd

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def pieces(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes to encode, starts and ends of the pieces."""
        start, end, _ = split_words(data, off)
        odd = np.zeros(len(data) + 1, np.int32)
        np.cumsum(self.odd[data], out=odd[1:])
        whole = odd[end] > odd[start]
        as_is = ragged(start[whole], (end - start)[whole])
        kind, low = self.kind[data], LOWER[data]
        kind[as_is], low[as_is] = 4, data[as_is]
        inside = ~SPACE[data]
        first = np.zeros(len(data) + 1, bool)
        first[start] = True
        first[1:-1] |= inside[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == 2)) & inside[:-1]
        s = np.flatnonzero(first[:-1] & inside)
        nxt = np.append(s[1:], len(data))
        word_end = end[np.searchsorted(start, s, side="right") - 1] if len(s) else s
        return low, s, np.minimum(nxt, word_end)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's number of ids."""
        low, start, end = self.pieces(data, off)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(off) - 1, np.int64)
        codes, names = pd.factorize(word_hashes(low, start, end))
        sample = np.empty(len(names), np.int64)
        sample[codes[::-1]] = np.arange(len(codes))[::-1]
        raw = low.tobytes()
        keys = [raw[a:b] for a, b in zip(start[sample].tolist(), end[sample].tolist())]
        known = self.known
        if len(known) > CACHED_PIECES:
            known.clear()
        new = [k for k in keys if k not in known]
        for k, e in zip(new, self.tokenizer.encode_batch_fast([k.decode() for k in new], add_special_tokens=False)):
            known[k] = np.array(e.ids, np.uint32).tobytes()
        found = [known[k] for k in keys]
        flat = np.frombuffer(b"".join(found), np.uint32)
        size = np.array([len(x) for x in found], np.int64) // 4
        at = np.cumsum(size) - size
        each = size[codes]
        before = np.append(0, np.cumsum(each))[np.searchsorted(start, off)]
        return flat[ragged(at[codes], each)], np.diff(before)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


# ---------------------------------------------------------------- Spark
MANIFEST = "part int, file string, n_docs bigint, n_tokens bigint"


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes whole texts and writes packed files under ``folder``; returns the manifest, one row a file.

    Documents are dealt out by ranges of (id, hash of the text), so files are in ascending id order and
    many equal ids are no single task. Null texts are empty, null ids come first, repeated rows are
    written as often as they come. ``end_id`` is appended to each document. Other columns are not read.
    An empty table gives an empty manifest.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions(F.col("id").asc_nulls_first(), "tie", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        ids, counts, names = [], [], []
        part = TaskContext.get().partitionId()
        uri = f"{folder}/part-{part:06d}.ids"
        for batch in batches:
            for piece in slices(batch, "text"):
                flat, n = enc.encode(*text_bytes(piece.column("text")))
                if end_id is not None:
                    flat, n = np.insert(flat, np.cumsum(n), end_id), n + 1
                ids.append(flat.astype(np.uint32))
                counts.append(n)
                names += piece.column("id").to_pylist()
        if names:
            bits = bits_for(max(enc.vocabulary, (end_id or 0) + 1))
            ends = np.cumsum(np.concatenate(counts))
            write_file(uri, names, ends, np.concatenate(ids), bits)
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [uri], "n_docs": pa.array([len(names)], pa.int64()), "n_tokens": pa.array([int(ends[-1])], pa.int64())}
            )

    return rows.select("id", "text").mapInArrow(run, MANIFEST)


def read(manifest: DataFrame, docs_at_once: int = 1024) -> DataFrame:
    """The documents of packed files: (doc_id, start, n_tokens, ids as binary), read file by file in parallel."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("bigint")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                f = PackedFile(file)
                starts = np.append(0, f.ends[:-1])
                for a in range(0, len(f.ends), docs_at_once):
                    b = min(a + docs_at_once, len(f.ends))
                    ids = f.read(int(starts[a]), int(f.ends[b - 1]))
                    cut = starts[a:b] - starts[a], f.ends[a:b] - starts[a]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(f.doc_ids[a:b], pa.int64(), mask=~f.known[a:b]),
                            "start": pa.array(base + starts[a:b], pa.int64()),
                            "n_tokens": pa.array(f.ends[a:b] - starts[a:b], pa.int64()),
                            "ids": pa.array([ids[x:y].tobytes() for x, y in zip(*cut)], pa.binary()),
                        }
                    )

    n = max(1, files.sparkSession.sparkContext.defaultParallelism)
    return files.repartition(4 * n, "file").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def checksums(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").cast("bigint").alias("ids_crc32"))


def write_and_read(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    tables = Scratch(spark, "packed")
    manifest = tables.save(write(docs, f"{tables.path}/ids", tokenizer, end_id), "manifest")
    return checksums(read(manifest))
