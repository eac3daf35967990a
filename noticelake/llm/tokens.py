"""Runs of letters of many texts at once, as Arrow strings and numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from noticelake.llm.words import LOWER, runs, text_bytes

ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
BEYOND_ASCII = np.arange(256) >= 0x80


def latin(data: np.ndarray) -> np.ndarray:
    """Bytes of ``[A-Za-z\\u00C0-\\u00FF]``: those beyond ASCII are C3 and the byte after it in UTF-8."""
    lead = data == 0xC3
    inside = ASCII_LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return inside


def any_script(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of all characters beyond ASCII."""
    return (ASCII_LETTER | BEYOND_ASCII)[data]


def letter_runs(column: pa.Array, letters) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Runs of letters with A-Z lower-cased: the code of each in a dictionary, the dictionary, and each run's text."""
    data, off = text_bytes(column)
    inside = letters(data)
    start, end = runs(inside, off)
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    flat = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(LOWER[data[inside]]))
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary, codes, np.searchsorted(off, start, side="right") - 1


def counted_pairs(left: np.ndarray, right: np.ndarray, n_right: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (left, right) pairs in order, and how often each stands there."""
    both, n = np.unique(left * max(1, n_right) + right, return_counts=True)
    return both // max(1, n_right), both % max(1, n_right), n.astype(np.int64)
