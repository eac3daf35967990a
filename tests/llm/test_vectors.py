import math

import numpy as np
import pytest

from noticelake.llm import nearest, products
from noticelake.llm.queries import op1_nearest, op9_products

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, vec string, score double"
SF = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", 1.0) for i, v in rows], SCHEMA)


def brute(rows, kind, k=10, every=100):
    """rows: {id: vector}; (query, rank, id, score)."""
    out = []
    for q in (i for i in rows if i % every == 0):
        if kind == "nearest":
            s = sorted((math.sqrt(((rows[q] - v) ** 2).sum()), i) for i, v in rows.items() if i != q)
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(s[:k])]
        else:
            s = sorted((-int((rows[q] * v).sum()), i) for i, v in rows.items() if i != q)
            out += [(q, r + 1, i, -d) for r, (d, i) in enumerate(s[:k])]
    return out


def table(spark):
    return {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}


def test_nearest_recall_and_scores(spark):
    rows = table(spark)
    got = [tuple(r) for r in op1_nearest(spark, SF).collect()]
    want = brute(rows, "nearest")
    hit = {(q, i) for q, _, i, _ in want}
    assert len(got) == len(want)
    assert len({(q, i) for q, _, i, _ in got} & hit) >= 0.9 * len(hit)
    for q, _, i, s in got:
        assert s == pytest.approx(math.sqrt(((rows[q] - rows[i]) ** 2).sum()), rel=1e-12)


def test_nearest_over_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(nearest, "ROWS", 64)
    rng = np.random.default_rng(3)
    rows = {i: v for i, v in enumerate(rng.normal(size=(600, 8)).astype(np.float32))}
    for i in range(200):  # a third of all rows alike
        rows[i] = rows[0]
    got = [tuple(r) for r in nearest.search(frame(spark, [(i, v.tolist()) for i, v in rows.items()])).collect()]
    want = brute({i: v.astype(float) for i, v in rows.items()}, "nearest")
    assert len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)
    assert [g for g in sorted(got) if g[0] == 0] == [w for w in want if w[0] == 0]  # ties to smaller ids


def test_nearest_beside_a_dense_group(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[::3] = x[0] + 0.06 * rng.normal(size=(2000, 32))  # a third of all rows in one dense group
    rows = dict(enumerate(x.astype(np.float32)))
    got = [tuple(r) for r in nearest.search(frame(spark, [(i, v.tolist()) for i, v in rows.items()]), query_every=20).collect()]
    want = {(q, i) for q, _, i, _ in brute({i: v.astype(float) for i, v in rows.items()}, "nearest", every=20)}
    for dense in (True, False):
        part = {(q, i) for q, i in want if (q % 3 == 0) == dense}
        assert len({(q, i) for q, _, i, _ in got} & part) >= 0.9 * len(part)


def test_fit_holds_dense_and_sparse_queries():
    rng = np.random.default_rng(12)
    x = rng.normal(size=(3000, 16))
    x[:1000] = x[0] + 1e-3 * rng.normal(size=(1000, 16))
    q = np.r_[0:60, 1000:1120]
    d = np.sqrt(((x[q][:, None] - x[None]) ** 2).sum(2))
    d[np.arange(len(q)), q] = np.inf
    order = np.argsort(d, axis=1)[:, :10]
    radius = np.take_along_axis(d, order, 1)[:, -1]
    levels = nearest.fit(x[q], [x[o] for o in order], radius, 8, 6, 0.96, 1.9, 7)
    assert len(levels) > 1 and [r for _, _, r in levels] == sorted(r for _, _, r in levels)
    low = 0.0
    for hashing, probes, high in levels:
        mine = np.flatnonzero((radius > low) & (radius <= high))
        assert nearest.recall_by_probes(hashing, x[q][mine], [x[order[i]] for i in mine])[nearest.PROBES.index(probes)] >= 0.96
        low = high


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [0.0, 0.0]), (6, [1.0]), (7, []), (8, [1.0, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 1.0]), (100, [-2.0, 0.5])]
    df = frame(spark, rows)
    near = [tuple(r) for r in nearest.search(df).collect()]
    assert sorted((q, i) for q, _, i, _ in near) == [(0, 8), (0, 100), (100, 0), (100, 8)]
    prod = sorted(tuple(r) for r in products.search(df).collect())
    ints = {0: np.array([1024, 0]), 5: np.array([0, 0]), 8: np.array([1024, 1024]), 100: np.array([-2048, 512])}
    assert prod == sorted(brute(ints, "products"))
    assert nearest.search(df.limit(0)).count() == 0 and products.search(df.limit(0)).count() == 0
    assert nearest.search(df.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("norms", ["one", "spread", "zero"])
def test_products_equal_brute_force(spark, monkeypatch, norms):
    monkeypatch.setattr(products, "ROWS", 97)
    monkeypatch.setattr(products, "QUERIES", 3)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 6))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x *= {"one": 1, "spread": rng.lognormal(0, 2, (700, 1)), "zero": (np.arange(700) % 3 == 0)[:, None]}[norms]
    x = x.astype(np.float32)
    got = sorted(tuple(r) for r in products.search(frame(spark, list(enumerate(x.tolist())))).collect())
    assert got == sorted(brute({i: np.floor(1024 * v.astype(float)).astype(np.int64) for i, v in enumerate(x)}, "products"))


def test_products_query(spark):
    rows = {i: np.floor(1024 * v).astype(np.int64) for i, v in table(spark).items()}
    assert sorted(tuple(r) for r in op9_products(spark, SF).collect()) == sorted(brute(rows, "products"))


def test_moves_come_in_order_of_cost():
    edge, width = np.array([0.1, 0.9, 0.4]), 1.0
    cost = [sum((e if m < 0 else width - e) ** 2 for e, m in zip(edge, s) if m) for s in nearest.move_sets(edge, width)]
    assert len(cost) == 27 and cost == sorted(cost)
