"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table cuts ``hashes`` random projections into slots of one width; the slots together are a bucket.
A query visits its own bucket and perturbed ones: every slot can move by one either way at a cost of
the squared distance to that edge, and sets of moves are taken in the order of their summed cost, the
estimated order of success. Candidates of all tables are merged and ranked by the exact distance.

Width and number of probes are fitted on ``SAMPLE_QUERIES`` queries (those with the smallest hashes of their
ids), whose exact neighbours one scan of all rows finds. The distance of a query's own k-th neighbour is its
radius. Radii that differ by more than ``RATIO`` get hashings of their own, from dense to sparse: probes are
added, then the width is grown, until a mean share ``target`` of the neighbours of a sampled query is met.
Every row is in every hashing. A query is done at the first hashing where its k-th candidate lies within the
hashing's radius, as its k neighbours then do; the others go on to the next one. Queries that are sparser than all
sampled ones are held against all rows. Last, the recall of the sampled queries is measured on the
result itself; below ``LEAST_RECALL`` the search fails.

A bucket with more than ``ROWS`` vectors is dealt to several parts, which its probes all visit; a
part of the work hands on the k best of each query alone, so no list of candidate pairs is made.
"""

from __future__ import annotations

import heapq
import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.store import Scratch
from noticelake.llm.vectors import lists, matrix, usable

log = logging.getLogger(__name__)

SAMPLE_QUERIES, ROWS = 256, 16384
#: Radii of one hashing differ by this factor at most, but for those of the densest of ``LEVELS``.
RATIO, LEVELS, WIDER, LEAST_RECALL = 2.0, 4, 1.25, 0.9
PROBES = (1, 2, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128)


class Hashing:
    """``tables`` x ``hashes`` p-stable functions floor((a.x + b) / width)."""

    def __init__(self, dim: int, width: float, tables: int, hashes: int, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.a = rng.normal(size=(tables, dim, hashes))
        self.b = rng.uniform(0, width, (tables, hashes))
        self.factor = rng.integers(1, 2**63, (tables, hashes), dtype=np.int64) | 1
        self.base = rng.integers(1, 2**63, tables, dtype=np.int64)
        self.width = width

    def slots(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Slots and the distances to their lower edges."""
        p = (x @ self.a[table] + self.b[table]) / self.width
        s = np.floor(p)
        return s.astype(np.int64), (p - s) * self.width

    def keys(self, slots: np.ndarray, table: int) -> np.ndarray:
        return (slots * self.factor[table]).sum(axis=-1) + self.base[table]

    def probes(self, slots: np.ndarray, edge: np.ndarray, n: int, table: int) -> np.ndarray:
        """Keys of the first ``n`` buckets of one vector, its own first."""
        moves = np.array([s for s, _ in zip(move_sets(edge, self.width), range(n))])
        return self.keys(slots[None, :] + moves, table)


def move_sets(edge: np.ndarray, width: float) -> Iterator[np.ndarray]:
    """Moves of the slots (-1, 0, 1), the likeliest first. A slot moves one way at most."""
    hashes = len(edge)
    cost = np.concatenate([edge**2, (width - edge) ** 2])
    order = np.argsort(cost, kind="stable")
    z = cost[order]
    yield np.zeros(hashes, np.int64)
    queue = [(z[0], (0,))]
    while queue:
        total, chosen = heapq.heappop(queue)
        last = chosen[-1]
        if last + 1 < len(z):
            heapq.heappush(queue, (total - z[last] + z[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(queue, (total + z[last + 1], (*chosen, last + 1)))
        slot = order[list(chosen)]
        if len({int(i) % hashes for i in slot}) == len(chosen):
            move = np.zeros(hashes, np.int64)
            move[slot % hashes] = np.where(slot < hashes, -1, 1)
            yield move


def _exact(ids: np.ndarray, q: np.ndarray, k: int):
    """The ``k`` nearest rows of each sampled query in a stretch of the scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, found = np.full((len(q), k), np.inf), np.zeros((len(q), k), np.int64)
        for batch in batches:
            rows, every = batch.column("id").to_numpy(), matrix(batch.column("vec"))
            for at in range(0, len(rows), 4096):
                x, mine = every[at : at + 4096], rows[at : at + 4096]
                d2 = (q**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * q @ x.T
                d2[ids[:, None] == mine[None]] = np.inf
                near = np.argpartition(d2, k - 1, axis=1)[:, :k] if len(x) > k else np.tile(np.arange(len(x)), (len(q), 1))
                d = np.sqrt(((x[near] - q[:, None]) ** 2).sum(2))
                d[np.isinf(np.take_along_axis(d2, near, 1))] = np.inf
                best, found = np.concatenate([best, d], 1), np.concatenate([found, mine[near]], 1)
                order = np.argsort(best, axis=1, kind="stable")[:, :k]
                best, found = np.take_along_axis(best, order, 1), np.take_along_axis(found, order, 1)
        i, j = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(found[i, j]), pa.array(best[i, j])], ["query_id", "vec_id", "score"])

    return run


def neighbours(v: DataFrame, q: DataFrame, k: int, scratch: Scratch) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Sampled queries that have neighbours: vectors, vectors of their ``k`` neighbours, distances of the last of these, ids."""
    sample = q.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_QUERIES).collect()
    ids, x = np.array([r["id"] for r in sample], np.int64), np.array([r["vec"] for r in sample], float)
    if not len(ids):
        return x, [], np.zeros(0), ids
    near = scratch.save(_ranked(v.mapInArrow(_exact(ids, x, k), RESULT), k), "neighbours")
    rows = near.join(v.select(F.col("id").alias("vec_id"), "vec"), "vec_id").select("query_id", "score", "vec").collect()  # k a sampled query
    met: dict[int, list] = {}
    for r in rows:
        met.setdefault(r["query_id"], []).append((r["score"], r["vec"]))
    has = np.array([i for i, d in enumerate(ids.tolist()) if d in met], np.int64)
    own = [met[d] for d in ids[has].tolist()]
    return x[has], [np.array([vec for _, vec in m], float) for m in own], np.array([max(d for d, _ in m) for m in own]), ids[has]


def recall_by_probes(hashing: Hashing, q: np.ndarray, near: list[np.ndarray]) -> np.ndarray:
    """Mean share of its neighbours that a query meets, for each number of ``PROBES``."""
    of = np.repeat(np.arange(len(q)), [len(x) for x in near])
    rows, met = np.concatenate(near), np.full(len(of), 1 << 40)
    first = np.searchsorted(of, np.arange(len(q) + 1))
    for t in range(len(hashing.base)):
        qs, edge = hashing.slots(q, t)
        slots = hashing.slots(rows, t)[0]
        at, close = hashing.keys(slots, t), (np.abs(slots - qs[of]) <= 1).all(axis=1)
        for i in range(len(q)):
            mine = slice(first[i], first[i + 1])
            if not (close[mine] & (met[mine] > 0)).any():
                continue
            order = {int(key): rank for rank, key in reversed(list(enumerate(hashing.probes(qs[i], edge[i], PROBES[-1], t))))}
            met[mine] = np.minimum(met[mine], [order.get(int(x), 1 << 40) for x in at[mine]])
    share = 1 / np.bincount(of)[of]
    return np.array([(share * (met < probes)).sum() / len(q) for probes in PROBES])


def fit(q: np.ndarray, near: list[np.ndarray], radius: np.ndarray, tables: int, hashes: int, target: float, slack: float, seed: int) -> list[tuple[Hashing, int, float]]:
    """Hashings, their numbers of probes and radii, from dense to sparse; together they hold all sampled queries."""
    out: list[tuple[Hashing, int, float]] = []
    left = np.arange(len(q))
    while len(left):
        most = radius[left].max()
        mine = left if len(out) == LEVELS - 1 else left[radius[left] >= most / RATIO]
        left = np.setdiff1d(left, mine)
        width = slack * (float(np.median(radius[mine])) or most or 1.0)
        while True:
            hashing = Hashing(q.shape[1], width, tables, hashes, seed + len(out))
            recall = recall_by_probes(hashing, q[mine], [near[i] for i in mine])
            if recall[-1] >= target:
                break
            width *= WIDER
        out.append((hashing, PROBES[int(np.argmax(recall >= target))], float(most)))
    return out[::-1]


def _index(hashing: Hashing, with_vectors: bool):
    tables = range(len(hashing.base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("vec"))
            for t in tables:
                keys = pa.array(hashing.keys(hashing.slots(x, t)[0], t))
                if with_vectors:
                    yield pa.RecordBatch.from_arrays([keys, batch.column("id"), batch.column("vec")], ["key", "id", "vec"])
                else:
                    yield pa.RecordBatch.from_arrays([keys], ["key"])

    return run


def _probe(hashing: Hashing, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = matrix(batch.column("vec")), batch.column("id").to_numpy()
            for t in range(len(hashing.base)):
                slots, edge = hashing.slots(x, t)
                keys = [np.unique(hashing.probes(s, e, n, t)) for s, e in zip(slots, edge)]
                size = [len(k) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.repeat(ids, size)), lists(np.repeat(x, size, axis=0))], ["key", "query_id", "vec"]
                )

    return run


RESULT = "query_id bigint, vec_id bigint, score double"


def _rank(k: int):
    def run(index: pa.Table, probes: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if index.num_rows and probes.num_rows:
            order = np.argsort(key := index.column("key").to_numpy(), kind="stable")
            key, ids, x = key[order], index.column("id").to_numpy()[order], matrix(index.column("vec"))[order]
            pkey, qid, q = probes.column("key").to_numpy(), probes.column("query_id").to_numpy(), matrix(probes.column("vec"))
            first, last = np.searchsorted(key, pkey, "left"), np.searchsorted(key, pkey, "right")
            for i in np.flatnonzero(last > first):
                a, b = first[i], last[i]
                d = np.sqrt(((x[a:b] - q[i]) ** 2).sum(axis=1))
                d[ids[a:b] == qid[i]] = np.inf
                best = np.lexsort((ids[a:b], d))[:k] if b - a <= 4 * k else _smallest(d, ids[a:b], k)
                best = best[np.isfinite(d[best])]
                out.append((np.full(len(best), qid[i]), ids[a:b][best], d[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), cols)))

    return run


def _smallest(d: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    limit = np.partition(d, k - 1)[k - 1]
    rows = np.flatnonzero(d <= limit)
    return rows[np.lexsort((ids[rows], d[rows]))][:k]


def search(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    query_every: int = 100,
    k: int = 10,
    tables: int = 8,
    hashes: int = 6,
    target: float = 0.96,
    slack: float = 1.9,
    seed: int = 7,
) -> DataFrame:
    """The ``k`` nearest vectors found for each query: (query_id, rank from 1, vec_id, score).

    ``queries`` has the columns of ``vectors``; without it the rows whose id is divisible by
    ``query_every`` are the queries. A query's own id is no candidate of it. ``score`` is the Euclidean
    distance of the original vectors in double precision; ties go to the smaller id. Which rows take
    part: see ``vectors.usable``. A query that met fewer than ``k`` candidates is held against all
    rows, so it gets ``k`` results or all there are. An empty table gives an empty result.
    """
    scratch = Scratch(vectors.sparkSession, "nearest")
    v = scratch.save(usable(vectors, id_col, vec_col, with_zero=False), "vectors")
    q = v.where(F.pmod("id", F.lit(query_every)) == 0) if queries is None else usable(queries, id_col, vec_col, with_zero=False)
    n = v.count()
    sample, near, radius, ids = neighbours(v, q, k, scratch)
    found = vectors.sparkSession.createDataFrame([], RESULT)
    wanted = min(k, n - 1)
    for i, (hashing, probes, reach) in enumerate(fit(sample, near, radius, tables, hashes, target, slack, seed)):
        met = scratch.save(_met(v, q, n, hashing, probes, k, scratch, i), f"found{i}")
        last = _ranked(met, k).groupBy("query_id").agg(F.count(F.lit(1)).alias("count"), F.max("score").alias("last"))
        done = last.where((F.col("count") >= wanted) & (F.col("last") <= reach * (1 + 1e-9)))
        q = scratch.save(q.join(done, q.id == done.query_id, "left_anti"), f"left{i}")
        found = found.unionByName(met)

    if not q.isEmpty():
        blocks = max(1, math.ceil(n / ROWS))
        block = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("part")
        rows = v.select(block, F.lit(0).cast("bigint").alias("key"), "id", "vec")
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("part")
        asked = q.select(every, F.lit(0).cast("bigint").alias("key"), F.col("id").alias("query_id"), "vec")
        rest = rows.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(_rank(k), RESULT)
        found = found.unionByName(rest)
    result = scratch.save(_ranked(found.dropDuplicates(["query_id", "vec_id"]), k), "result")
    _check_recall(result, ids, radius, [len(x) for x in near])
    return result


def _met(v: DataFrame, q: DataFrame, n: int, hashing: Hashing, probes: int, k: int, scratch: Scratch, level: int) -> DataFrame:
    """The best candidates of each query in the buckets of one hashing."""
    crowded = v.mapInArrow(_index(hashing, False), "key bigint").groupBy("key").count().where(F.col("count") > ROWS)
    crowded = scratch.save(crowded.select("key", F.ceil(F.col("count") / ROWS).alias("spread")), f"crowded{level}")
    spread = F.coalesce("spread", F.lit(1))
    parts = F.lit(max(1, math.ceil(len(hashing.base) * n / ROWS)))
    part = F.pmod(F.xxhash64("key", "salt"), parts).alias("part")
    index = v.mapInArrow(_index(hashing, True), "key bigint, id bigint, vec array<double>")
    index = index.join(crowded, "key", "left").withColumn("salt", F.pmod(F.xxhash64("id"), spread)).select(part, "key", "id", "vec")
    tries = q.mapInArrow(_probe(hashing, probes), "key bigint, query_id bigint, vec array<double>").join(crowded, "key", "left")
    tries = tries.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), spread - 1))).select(part, "key", "query_id", "vec")
    found = index.groupBy("part").cogroup(tries.groupBy("part")).applyInArrow(_rank(k), RESULT)
    return found.dropDuplicates(["query_id", "vec_id"])


def _check_recall(result: DataFrame, ids: np.ndarray, radius: np.ndarray, size: list[int]) -> None:
    """Fails if the sampled queries, whose exact neighbours are known, got too few of them. Equal distances count alike."""
    if not len(ids):
        return
    known = result.sparkSession.createDataFrame(list(zip(ids.tolist(), (radius * (1 + 1e-9)).tolist())), "query_id bigint, radius double")
    right = dict(result.join(F.broadcast(known), "query_id").where("score <= radius").groupBy("query_id").count().collect())  # SAMPLE_QUERIES rows at most
    recall = float(np.mean([right.get(i, 0) / s for i, s in zip(ids.tolist(), size)]))
    log.info("recall of %d sampled queries: %.4f", len(ids), recall)
    if recall < LEAST_RECALL:
        raise RuntimeError(f"recall {recall:.3f} of {len(ids)} sampled queries is below {LEAST_RECALL}")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
