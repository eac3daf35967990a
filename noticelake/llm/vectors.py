"""Vectors as DataFrame columns and as numpy blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vec_col: str, with_zero: bool) -> DataFrame:
    """(id, vec as array of double) of the rows that take part.

    Left out: null ids and vectors, vectors that are empty or hold null, NaN or infinite components,
    vectors of another length than most (the smaller length, if two are as frequent), and zero
    vectors unless ``with_zero``. Repeated rows count once; of several vectors with one id the
    smallest is taken.
    """
    v = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    bad: Column = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & ~bad)
    if not with_zero:
        v = v.where(F.exists("vec", lambda x: x != 0))
    lengths = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    v = v.where(F.size("vec") == (lengths[0]["d"] if lengths else 0))
    return v.groupBy("id").agg(F.min("vec").alias("vec"))


def matrix(column: pa.ChunkedArray | pa.Array, kind: type = float) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0), kind)


def lists(rows: np.ndarray) -> pa.Array:
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, max(d, 1), dtype=np.int32)[: n + 1]), pa.array(rows.ravel()))
