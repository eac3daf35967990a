"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are grouped by length into buckets of about ``ROWS``. The longest bucket gives every query
a first score that its k-th result will reach; the query then needs, in a bucket whose longest vector
is l, a cosine of at least that score over (length of the query times l). Above 1 the whole bucket is
left out, before it is read. In the others the local threshold picks the pruning: near 1, by the length
of the single vectors; else by coordinates, with the product over the query's largest coordinates plus
what Cauchy and Schwarz allow for the rest. What is left is verified by whole products.

Queries and buckets meet in blocks; a block hands on the k best of each query alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.store import Scratch
from noticelake.llm.vectors import matrix, usable

ROWS, QUERIES = 4096, 2048
#: Above this cosine a vector's own length decides nearly as well as its coordinates do, at no cost.
LENGTH_FROM = 0.9
RESULT = "query_id bigint, vec_id bigint, score bigint"


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer products of rows of q with rows of x; floating point only where it is exact."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if top < 2**52:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return q @ x.T


def prune(q: np.ndarray, x: np.ndarray, least: np.ndarray, focus: int) -> np.ndarray:
    """Mask (queries, vectors) of pairs that can still reach ``least``, by length or by coordinates."""
    qf, xf = q.astype(float), x.astype(float)
    ql, xl = np.linalg.norm(qf, axis=1), np.linalg.norm(xf, axis=1)
    slack = 1e-9
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(ql > 0, least / (ql * max(xl.max(initial=0), 1e-300)), 0)
    may = np.zeros((len(q), len(x)), bool)
    by_length = local >= LENGTH_FROM
    may[by_length] = ql[by_length, None] * xl[None] * (1 + slack) + slack >= least[by_length, None]
    rows = np.flatnonzero(~by_length)
    if len(rows):
        dims = np.argsort(-(qf[rows] ** 2).sum(axis=0))[:focus]
        part = qf[np.ix_(rows, dims)] @ xf[:, dims].T
        q_rest = np.sqrt(np.maximum(0, ql[rows] ** 2 - (qf[np.ix_(rows, dims)] ** 2).sum(axis=1)))
        x_rest = np.sqrt(np.maximum(0, xl**2 - (xf[:, dims] ** 2).sum(axis=1)))
        size = 1 + ql[rows, None] * xl[None]
        may[rows] = part + q_rest[:, None] * x_rest[None] + slack * size >= least[rows, None]
    return may


def _verify(k: int):
    def run(bucket: pa.Table, asked: pa.Table) -> pa.Table:
        ids, qid = bucket.column("id").to_numpy(), asked.column("query_id").to_numpy()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids) and len(qid):
            x, q = matrix(bucket.column("vec"), np.int64), matrix(asked.column("asked"), np.int64)
            least = asked.column("least").to_numpy(zero_copy_only=False).astype(float)
            for a in range(0, len(q), 256):
                may = prune(q[a : a + 256], x, least[a : a + 256], max(1, q.shape[1] // 2))
                may &= ids[None] != qid[a : a + 256, None]
                cols = np.flatnonzero(may.any(axis=0))
                if not len(cols):
                    continue
                score = exact_products(q[a : a + 256], x[cols])
                for i in range(len(score)):
                    rows = np.flatnonzero(may[i, cols])
                    s = score[i, rows]
                    if len(rows) > k:
                        limit = np.partition(s, len(s) - k)[len(s) - k]
                        rows, s = rows[s >= limit], s[s >= limit]
                    best = np.lexsort((ids[cols[rows]], -s))[:k]
                    out.append((np.full(len(best), qid[a + i]), ids[cols[rows[best]]], s[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), cols)))

    return run


def _meet(buckets: DataFrame, asked: DataFrame, blocks: int, k: int) -> DataFrame:
    """k best of each query in each of its buckets; ``asked`` is (bucket, query_id, asked, least)."""
    own = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    every = buckets.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    return every.groupBy("bucket", "block").cogroup(own.groupBy("bucket", "block")).applyInArrow(_verify(k), RESULT)


def search(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: float = 1024.0,
    query_every: int = 100,
    k: int = 10,
) -> DataFrame:
    """The ``k`` largest integer products of floor(scale * x) for each row whose id is divisible by ``query_every``.

    Returns (query_id, rank from 1, vec_id, score). All rows but the query's own are candidates; ties go to
    the smaller id; with fewer candidates all are returned. Which rows take part: see ``vectors.usable``
    (zero vectors do). Products have to fit 64 bits. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "products")
    v = usable(vectors, id_col, vec_col, with_zero=True)
    v = v.select("id", F.transform("vec", lambda x: F.floor(F.lit(scale) * x).cast("bigint")).alias("vec"))
    squares = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    v = scratch.save(v.withColumn("length", F.sqrt(squares)), "rows")
    n = v.count()
    if n == 0:
        return _ranked(spark.createDataFrame([], RESULT), k)
    n_buckets = math.ceil(n / ROWS)
    # Bounds between buckets: n_buckets - 1 numbers; many vectors of one length are dealt to their buckets by id.
    cuts = v.approxQuantile("length", [i / n_buckets for i in range(1, n_buckets)], 0.1 / n_buckets) if n_buckets > 1 else []
    below = F.lit(0)
    upto = F.lit(0)
    if cuts:
        table = F.array(*[F.lit(float(c)) for c in cuts])
        below = F.size(F.filter(table, lambda c: c < F.col("length")))
        upto = F.size(F.filter(table, lambda c: c <= F.col("length")))
    slot = below + F.pmod(F.xxhash64("id"), upto - below + 1).cast("int")
    buckets = scratch.save(v.select((F.lit(n_buckets - 1) - slot).cast("bigint").alias("bucket"), "id", "vec", "length"), "buckets")
    longest = scratch.save(buckets.groupBy("bucket").agg(F.max("length").alias("longest")), "longest")

    queries = buckets.where(F.pmod("id", F.lit(query_every)) == 0).select(F.col("id").alias("query_id"), F.col("vec").alias("asked"), "length")
    blocks = max(1, math.ceil(n / query_every / QUERIES))
    rows = buckets.select("bucket", "id", "vec")
    start = longest.agg(F.min("bucket")).first()[0]
    none = F.lit(float("-inf"))
    first = _meet(rows.where(F.col("bucket") == start), queries.select(F.lit(start).alias("bucket"), "query_id", "asked", none.alias("least")), blocks, k)
    first = scratch.save(first, "first")

    least = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
    least = least.select("query_id", F.when(F.col("n") >= k, F.col("s").cast("double")).alias("least"))
    asked = queries.join(least, "query_id", "left").withColumn("least", F.coalesce("least", none))
    reach = F.col("length") * F.col("longest") * (1 + 1e-9) + 1e-9
    asked = asked.join(longest.where(F.col("bucket") != start), reach >= F.col("least"))  # a query set against buckets
    rest = _meet(rows.where(F.col("bucket") != start), asked.select("bucket", "query_id", "asked", "least"), blocks, k)
    return _ranked(first.unionByName(rest), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
