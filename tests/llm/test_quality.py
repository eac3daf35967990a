import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from noticelake.llm import quality
from noticelake.llm.queries import op6_quality


def model(texts, order=quality.ORDER):
    """Plain interpolated modified Kneser-Ney over bytes: log p of the last byte of an n-gram."""
    top = Counter()
    for t in texts:
        b = bytes(order - 1) + t.encode()
        top.update(b[i : i + order] for i in range(len(b) - order + 1))
    a = {order: top}
    for k in range(order - 1, 0, -1):
        a[k] = Counter(g[1:] for g in a[k + 1])
    d = {}
    for k in a:
        n = [sum(v == i for v in a[k].values()) for i in range(5)]
        if n[1] and n[2] and n[3]:
            y = n[1] / (n[1] + 2 * n[2])
            d[k] = [min(max(i - (i + 1) * y * n[i + 1] / n[i], 1e-3), i - 1e-3) for i in (1, 2, 3)]
        else:
            d[k] = [0.5, 1.0, 1.5]
    total, freed = defaultdict(float), defaultdict(float)
    for k in a:
        for g, v in a[k].items():
            total[k, g[:-1]] += v
            freed[k, g[:-1]] += d[k][min(v, 3) - 1]

    def p(g, k=order):
        if k == 0:
            return 1 / 256
        g = g[len(g) - k :]
        if not total[k, g[:-1]]:
            return p(g, k - 1)
        v = a[k][g]
        own = (v - d[k][min(v, 3) - 1]) / total[k, g[:-1]] if v else 0.0
        return own + freed[k, g[:-1]] / total[k, g[:-1]] * p(g, k - 1)

    def log_prob(text):
        b = bytes(order - 1) + text.encode()
        return sum(math.log(p(b[i : i + order])) for i in range(len(b) - order + 1))

    return p, log_prob


def test_equals_plain_kneser_ney(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "HOT", 60)
    good = ["the cat sat on the mat", "a cat and a dog sat", "the dog ate the cat é", "mat " * 9]
    other = ["zzzz 🎉🎉", "the", "dog on a mat, the cat"]
    df = docs(*enumerate(good + other))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4)] + [(4, 0, 0)], "doc_id bigint, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality.classify(df, labels, calibrate=None).collect()}
    p, log_prob = model(good)
    assert sum(p(b"\0\0t" + b"h" + bytes([c])) for c in range(256)) == pytest.approx(1)
    mean = -sum(map(log_prob, good)) / sum(len(t.encode()) for t in good)
    for i, t in enumerate(good + other):
        n = len(t.encode())
        want = math.exp((-log_prob(t) + quality.PRIOR * mean) / (n + quality.PRIOR))
        assert rows[i]["perplexity"] == pytest.approx(want, rel=1e-9) and rows[i]["n_bytes"] == n


def test_repeated_rows_are_one_document(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "HOT", 20)
    good = ["the cat sat on the mat", "a cat and a dog sat", "the dog ate the cat"]
    rows = [(0, good[0])] * 3 + [(1, good[1]), (2, good[2])] + [(3, "dog on a mat, the cat")] * 5 + [(None, "zebra on the mat")] * 4
    labels = spark.createDataFrame([(i, 1) for i in range(3)], "doc_id bigint, quality int")
    out = {r["doc_id"]: r for r in quality.classify(docs(*rows), labels, calibrate=None).collect()}
    _, log_prob = model([good[0]] * 3 + good[1:])
    mean = -sum(map(log_prob, good)) / sum(map(len, good))
    assert len(out) == 5
    for i, t in dict(rows).items():
        assert out[i]["n_bytes"] == len(t)
        assert out[i]["perplexity"] == pytest.approx(math.exp((-log_prob(t) + quality.PRIOR * mean) / (len(t) + quality.PRIOR)), rel=1e-9)


def test_query_separates_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = op6_quality(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").distinct().count()
    met = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r["accepted"] for r in met if r["quality"] == 1]
    bad = [r["accepted"] for r in met if r["quality"] == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.2
    # documents that the model has not read are judged alike
    seen = {r["doc_id"] for r in met}
    assert np.mean([r["accepted"] for r in got.collect() if r["doc_id"] not in seen]) >= 0.75


def test_thresholds_are_by_language(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "FEW", 1)
    df = docs((1, "aaaa bbbb", "x"), (2, "abab abab", "x"), (3, "qwertz uiop", "y"), (4, "other words", "z"), (5, "no lang", None), (6, "no lang", None))
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (5, 1)], "doc_id bigint, quality int")
    t = {r["doc_id"]: r["threshold"] for r in quality.classify(df, labels, calibrate=None).collect()}
    assert len({t[1], t[3], t[5]}) == 3 and t[1] == t[2] and t[5] == t[6] and t[4] >= max(t.values())


def test_edge_rows(spark, docs):
    df = docs((1, None), (2, ""), (None, "good text"), (3, "good text"), (3, "good text"), (4, "good " * 4000), (5, "\x00\x00"))
    labels = spark.createDataFrame([(3, 1), (4, 1), (None, 1), (9, 1), (5, None)], "doc_id bigint, quality int")
    out = quality.classify(df, labels)
    rows = {(r["doc_id"], r["n_bytes"]): r for r in out.collect()}
    assert len(rows) == 6 and not rows[1, 0]["accepted"] and rows[1, 0]["perplexity"] is None and rows[3, 9]["accepted"]
    kept = quality.keep_accepted(df, out)
    assert kept.columns == df.columns and kept.where("doc_id = 3").count() == 2 and kept.where("text is null").count() == 0
    assert quality.classify(df.limit(0), labels).count() == 0
    assert all(r["accepted"] for r in quality.classify(df, labels.limit(0)).collect() if r["n_bytes"])
