import re
from collections import defaultdict

import numpy as np
import pytest

from noticelake.llm import mixing
from noticelake.llm.queries import op10_mixing


def targets(sizes, weights=(1, 2, 3), limit=3.0):
    """Water filling by repeated sharing."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        share = (total - sum(full.values())) / sum(w[s] for s in rest) if rest else 0
        over = [s for s in rest if w[s] * share >= limit * sizes[s]]
        if not over:
            return {**full, **{s: w[s] * share for s in rest}}
        full.update({s: limit * sizes[s] for s in over})


def check(rows, texts):
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, source, text in texts:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    want = targets(sizes)
    for r in rows:
        s = r["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-9, abs=1e-9)
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def test_query_near_targets(spark, documents):
    texts = [(r["doc_id"], r["source"], r["text"]) for r in documents.collect()]
    rows = op10_mixing(spark, "/root/testdata/sf0.001").withColumnRenamed("mix_source", "source").collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_many_buckets_a_hot_source_and_reruns(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 8)
    monkeypatch.setattr(mixing, "FAN", 3)
    rng = np.random.default_rng(1)
    texts = [(i, None if i % 11 == 0 else "hot" if i % 3 else f"s{i % 7}", " ".join(["w"] * int(rng.integers(0, 30)))) for i in range(600)]
    df = docs(*[(i, t, "en", s) for i, s, t in texts])
    rows = mixing.mix(df).collect()
    check(rows, texts)
    again = mixing.mix(df.repartition(7)).collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} == {(r["doc_id"], r["taken"]) for r in again}


def test_expected_copies_are_kept():
    share, size = np.array([0.3, 0.7, 0.5, 0.2]), np.array([10.0, 3.0, 7.0, 1.0])
    rng, total = np.random.default_rng(0), np.zeros(4)
    for _ in range(6000):
        out, left = mixing.pivot(share, size, rng.random(4))
        if left >= 0:
            assert abs(out @ size - share @ size) < 1e-9
            out[left] = float(rng.random() < out[left])
        assert set(np.round(out, 9)) <= {0.0, 1.0}
        total += out
    assert np.allclose(total / 6000, share, atol=0.03)


def test_one_id_of_a_third_of_a_source(docs, monkeypatch):
    monkeypatch.setattr(mixing, "DEALT", 16)
    ten = " ".join(["w"] * 10)
    texts = [(1, "a", ten)] * 200 + [(i, "a", ten) for i in range(1000, 1200)] + [(i, "b", ten) for i in range(2000, 2300)]
    df = docs(*[(i, t, "en", s) for i, s, t in texts])
    rows = mixing.mix(df).collect()
    assert len(rows) == len(texts)
    check(rows, texts)  # within the largest document of the target
    same = [r["copies"] for r in rows if r["doc_id"] == 1]
    assert max(same) - min(same) == 1
    assert mixing.apply_mix(df, mixing.mix(df)).where("doc_id = 1").count() == sum(same)


def test_equal_ids_and_sizes_with_different_texts(docs):
    texts = [(1, "a", f"x{i} y") for i in range(50)] + [(2, "b", "one two three")] * 60
    df = docs(*[(i, t, "en", s) for i, s, t in texts])
    out = sorted(map(str, mixing.apply_mix(df, mixing.mix(df)).select("doc_id", "text").collect()))
    again = df.repartition(5)
    assert out == sorted(map(str, mixing.apply_mix(again, mixing.mix(again)).select("doc_id", "text").collect()))
    assert len(out) == sum(r["copies"] for r in mixing.mix(df).collect())


def test_edge_rows(docs):
    df = docs((1, None, "en", "a"), (None, "one two", "en", None), (None, "one two", "en", None), (3, "", "en", "a"), (4, "x", "en", "b"))
    rows = mixing.mix(df).collect()
    assert len(rows) == 5
    check(rows, [(r["doc_id"], r["source"], r["text"]) for r in df.collect()])
    out = mixing.apply_mix(df, mixing.mix(df))
    assert out.columns == df.columns
    assert out.where("text is not null and text != ''").count() == sum(r["copies"] for r in rows if r["size"])
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.where("doc_id in (1, 3)")).count() == 2
