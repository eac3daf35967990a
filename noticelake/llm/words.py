"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Word names are 64-bit hashes of the bytes: equal words have equal names on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_TABLES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**64 - 1, (2, 256), dtype=np.uint64)
_STEPS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``max_bytes`` of text each; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the offset of each text (one more at the end). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(off):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of runs of True bytes; a text's edge ends a run."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, last = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = off[(off > 0) & (off < n)]
    start[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(start), np.flatnonzero(last) + 1


def split_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text the index of its first word (one more at the end)."""
    start, end = runs(~SPACE[data], off)
    return start, end, np.searchsorted(start, off)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number and of its inverse modulo 2**64."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        out = []
        for base in (_STEPS[which], pow(_STEPS[which], -1, 2**64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 4 * SLICE_BYTES:
            _powers[which] = have
    return have[0][:n], have[1][:n]


def prefix_sums(values: np.ndarray, which: int = 0) -> np.ndarray:
    """Running sums of values times powers: the hash of any stretch is a difference of two."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), which)[0], dtype=np.uint64, out=sums[1:])
    return sums


def stretch_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of stretches [start, end), equal for equal contents wherever they lie."""
    return mix((sums[end] - sums[start]) * powers(len(sums), which)[1][start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    return stretch_hash(prefix_sums(_TABLES[which][data], which), start, end, which)


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of many stretches one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)
