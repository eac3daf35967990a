import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from noticelake.llm import repeats
from noticelake.llm.queries import op8_repeats

SF = "/root/testdata/sf0.01"


def brute(texts, window=35):
    """(words, removed, digest of what is kept) of each text."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = True
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def result(df, **options):
    return [(r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in repeats.remove(df, **options).collect()]


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows])))
    got = op8_repeats(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r["doc_id"]]


@pytest.mark.parametrize("window", [1, 5, 12, 35])
def test_mixed_passages(docs, window, monkeypatch):
    monkeypatch.setattr(repeats, "PART", 50)
    rng = np.random.default_rng(window)
    words = [f"w{i}" for i in range(30)] + ["é", "🎉"]
    passages = [rng.choice(words, rng.integers(3, 60)).tolist() for _ in range(6)] + [["a"] * 40, ["a", "b"] * 30]
    texts = []
    for _ in range(60):
        t = rng.choice(words, rng.integers(0, 40)).tolist()
        for p in rng.choice(len(passages), rng.integers(0, 3)):
            t += passages[p][int(rng.integers(0, 3)) :] + rng.choice(words, rng.integers(0, 9)).tolist()
        texts.append(" \n".join(t))
    want = [(i, *b) for i, b in enumerate(brute(texts, window))]
    assert sorted(result(docs(*enumerate(texts)).repartition(5), window=window)) == want


def test_equal_passages_have_equal_symbols():
    """Symbols with their support inside are found in any surroundings."""
    rng = np.random.default_rng(0)
    for _ in range(200):
        p = rng.integers(0, 5, 40)
        a, b = (np.concatenate([rng.integers(0, 5, rng.integers(0, 9)), p, rng.integers(0, 5, rng.integers(0, 9))]) for _ in "ab")
        sets = []
        for x in (a, b):
            at = next(i for i in range(len(x)) if (x[i : i + 40] == p).all())
            name, low, high = repeats.recompress(repeats.mix(x.astype(np.uint64)), np.array([0, len(x)]))
            inside = (low >= at) & (high <= at + 40)
            sets.append(set(zip(name[inside].tolist(), (low[inside] - at).tolist(), (high[inside] - at).tolist())))
        assert sets[0] == sets[1]


def test_edge_rows(docs):
    long = " ".join(f"x{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "y " + long + " z"), (4, "a " * 34), (5, "a " * 36), (6, "short"), (3, "other text")]
    df = docs(*rows)
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(result(df), key=key) == sorted([(r[0], *b) for r, b in zip(rows, brute([t for _, t in rows]))], key=key)
    assert result(df.limit(0)) == []
    assert result(docs((1, ""), (2, None))) == [(1, 0, 0, hashlib.sha256(b"").hexdigest()), (2, 0, 0, hashlib.sha256(b"").hexdigest())]
