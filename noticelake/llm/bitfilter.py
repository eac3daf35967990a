"""Bit filters of a fixed size, put together on the executors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BITS = 1 << 16


def build(slots: DataFrame, bits: int) -> np.ndarray:
    """Bit array with the bits of ``slots`` (slot from 0 to bits - 1) set.

    Each chunk of 8 kB is made by a task; the driver receives ``bits / 8`` bytes at most, whatever the number of rows.
    """
    chunk = F.floor(F.col("slot") / CHUNK_BITS).alias("chunk")
    inside = F.pmod("slot", F.lit(CHUNK_BITS)).cast("int").alias("inside")

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        b = np.zeros(CHUNK_BITS, bool)
        b[group["inside"].to_numpy()] = True
        return pd.DataFrame({"chunk": group["chunk"].iloc[:1], "bits": [np.packbits(b, bitorder="little").tobytes()]})

    out = np.zeros(max(bits, CHUNK_BITS) // 8, np.uint8)
    for row in slots.select(chunk, inside).distinct().groupBy("chunk").applyInPandas(fill, "chunk bigint, bits binary").collect():
        at = row["chunk"] * (CHUNK_BITS // 8)
        out[at : at + CHUNK_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def holds(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1
