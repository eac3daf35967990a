import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from noticelake.llm import divergence
from noticelake.llm.queries import op13_divergence

SCALE = 1_000_000_000


def brute(rows, min_docs=3, ranks=200):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        n[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        total = {s: sum(n[lang, s][t] for t in kept) for s in sources}
        p = lambda k, size: 1 + SCALE * (k + 1) // (size + len(kept))  # noqa: E731, B023
        over = {t: sum(n[lang, s][t] for s in sources) for t in kept}
        for s in sources:
            mine = {t: p(n[lang, s][t], total[s]) for t in kept}
            pairs = []
            for o in sources - {s}:
                pairs.append((o, sum((mine[t] - q) ** 2 // q for t in kept for q in [p(n[lang, o][t], total[o])])))
            terms = [(t, (mine[t] - q) ** 2 // q) for t in kept if n[lang, s][t] for q in [p(over[t], sum(over.values()))] if mine[t] > q]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[: ranks if part == "term" else None])]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_query_equals_brute_force(spark, documents):
    want = brute([(r["lang"], r["source"], r["text"]) for r in documents.collect()])
    assert result(op13_divergence(spark, "/root/testdata/sf0.001")) == want


def corpus(seed):
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in "abcdefghijklmnop" for b in ("x", "é", "日本", "Z", "zz")]
    weight = np.arange(1, len(words) + 1.0)
    pick = lambda of: of[int(rng.integers(len(of)))]
    rows = []
    for i in range(120):
        drawn = rng.choice(words, int(rng.integers(0, 40)), p=weight / weight.sum())
        rows.append((i, "".join(w + pick(" 1-") for w in drawn), pick(["en", "de", None]), pick(["a", "b", "hot", "hot", None])))
    return rows


@pytest.mark.parametrize("bits", [1, 4, 64])
def test_colliding_digests_are_split(docs, bits):
    rows = corpus(bits)
    want = brute([(r[2], r[3], r[1]) for r in rows], ranks=7)
    assert result(divergence.audit(docs(*rows), ranks=7, bits=bits)) == want
    assert any(x[2] == "term" for x in want)


def test_ties_at_the_last_rank_go_by_text(docs):
    words = " ".join(f"w{'abcdefghijklmnopqrstuvwxyz'[i]}" for i in range(26))
    rows = [(i, words, "en", "a") for i in range(3)] + [(i, "other words here", "en", "b") for i in range(3)]
    want = brute([(r[2], r[3], r[1]) for r in rows], ranks=5)
    assert result(divergence.audit(docs(*rows), ranks=5)) == want


def test_edge_rows(docs):
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, "123 ...", "xx", "only"), (4, "one two", "en", "b"), (4, "one two", "en", "b"), (4, "one two", "en", "b"),
            (None, "one", "en", "c"), (5, "Very " * 60_000, "en", "long")]
    assert result(divergence.audit(docs(*rows))) == brute([(r[2], r[3], r[1]) for r in rows])
    assert divergence.audit(docs()).count() == 0


def test_large_counts_stay_exact(spark):
    df = spark.createDataFrame([(9_999_999_999_999, 99_999_999_999_999, 7)], "n long, total long, v long")
    from pyspark.sql import functions as F

    got = df.select(divergence.share(F.col("n"), F.col("total"), F.col("v"), SCALE, 1)).first()[0]
    assert got == 1 + SCALE * (9_999_999_999_999 + 1) // (99_999_999_999_999 + 7)
