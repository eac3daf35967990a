import itertools
import zlib

import numpy as np
import pytest

from noticelake.llm import crf
from noticelake.llm.queries import op7_languages


def brute_marginals(emit, trans):
    """Sums over all label sequences; the state before the first word is free."""
    n, k = emit.shape
    p = np.zeros((n, k))
    for s in itertools.product(range(k), repeat=n + 1):
        w = np.exp(sum(emit[i, s[i + 1]] + trans[s[i], s[i + 1]] for i in range(n)))
        for i in range(n):
            p[i, s[i + 1]] += w
    return p / p.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("chunk", [1, 2, 3, 128])
def test_forward_backward_is_exact(chunk):
    rng = np.random.default_rng(0)
    emit, trans = rng.normal(size=(12, 3)), rng.normal(size=(3, 3))
    first = np.array([0, 0, 5, 6, 12, 12])
    got = crf.marginals(emit, first, trans, chunk)
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            assert np.allclose(got[a:b], brute_marginals(emit[a:b], trans))


def log_likelihood(emit, truth, first, trans):
    """Of the true labels, over all label sequences; the state before a first word is summed out."""
    total = 0.0
    for a, b in zip(first[:-1], first[1:]):
        weight = lambda s, a=a, b=b: np.exp(sum(emit[i, s[i - a + 1]] + trans[s[i - a], s[i - a + 1]] for i in range(a, b)))
        k = emit.shape[1]
        over_all = sum(weight(s) for s in itertools.product(range(k), repeat=b - a + 1))
        total += np.log(sum(weight((s, *truth[a:b])) for s in range(k)) / over_all)
    return total


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(2)
    emit, trans, truth, first = rng.normal(size=(9, 3)), rng.normal(size=(3, 3)), rng.integers(0, 3, 9), np.array([0, 4, 5, 9])
    by_score, by_trans = crf.gradient(emit, truth, first, trans)
    for given, found in ((emit, by_score), (trans, by_trans)):
        for at in np.ndindex(given.shape):
            was, ends = given[at], []
            for step in (1e-5, -1e-5):
                given[at] = was + step
                ends.append(log_likelihood(emit, truth, first, trans))
            given[at] = was
            assert abs(found[at] + (ends[0] - ends[1]) / 2e-5) < 1e-6


def test_expected_transitions_do_not_depend_on_chunks():
    rng = np.random.default_rng(3)
    emit, trans, first = rng.normal(size=(40, 3)), rng.normal(size=(3, 3)), np.array([0, 17, 17, 18, 40])
    sums = []
    for chunk in (1, 3, 16, 128):
        sums.append(np.zeros((3, 3)))
        crf.marginals(emit, first, trans, chunk, sums[-1])
    assert np.allclose(sums[0].sum(), 40) and all(np.allclose(s, sums[0]) for s in sums)


def test_long_texts_stay_finite():
    rng = np.random.default_rng(1)
    p = crf.marginals(rng.normal(size=(50_000, 4)) * 40, np.array([0, 50_000]), rng.normal(size=(4, 4)))
    assert np.isfinite(p).all() and np.allclose(p.sum(axis=1), 1)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op7_languages(spark, sf).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        assert r["lang_pred"] in {"en", "de", "fr", "es", "und"}
    held = [r["lang_pred"] == truth[r["doc_id"]][0] for r in rows if r["held_out"]]
    assert np.mean(held) >= 0.97


def _two(spark, docs, extra=()):
    rng = np.random.default_rng(4)
    a = ["der", "die", "und", "nicht", "schule", "haus", "wird", "mit"]
    b = ["the", "and", "with", "house", "school", "not", "will", "this"]
    rows = [(i, " ".join(rng.choice(a if i % 2 else b, 30)), "de" if i % 2 else "en") for i in range(80)]
    return docs(*rows, *extra)


def test_code_switched_text_has_segments(spark, docs):
    text = "the house and this school will not " * 3 + "die schule wird nicht mit und der haus " * 3
    rows = crf.identify(_two(spark, docs, [(1000, text, None)])).where("doc_id = 1000").collect()
    found = rows[0]["segments"]
    assert [s["lang"] for s in found] == ["en", "de"] and abs(found[0]["last"] - 20) <= 1 and found[-1]["last"] == 44


def test_labels_of_held_out_rows_do_not_matter(spark, docs):
    df = _two(spark, docs)
    held = [i for i in range(80) if zlib.crc32(str(i).encode()) % 3 == 1]
    swapped = df.selectExpr("doc_id", "text", f"case when doc_id in ({','.join(map(str, held))}) then 'xx' else lang end as lang")
    assert sorted(map(str, crf.identify(df).collect())) == sorted(map(str, crf.identify(swapped).collect()))


def test_edge_rows(spark, docs):
    extra = [(1001, None), (1002, ""), (1003, "123 --- !!"), (None, "the house"), (1004, "the house"), (1004, "the house"), (1005, "die " * 20_000, "de")]
    rows = crf.identify(_two(spark, docs, extra)).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 87
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1001, 1002, 1003))
    assert by[None]["lang_pred"] == "en" and not by[None]["held_out"] and by[1005]["lang_pred"] == "de"
    df = docs((1, "the house", None), (2, None, "en"))
    assert {r["lang_pred"] for r in crf.identify(df).collect()} == {"und"}
    assert crf.identify(df.limit(0)).count() == 0
