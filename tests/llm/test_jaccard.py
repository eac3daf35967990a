import re
from collections import defaultdict

import numpy as np

from noticelake.llm import jaccard
from noticelake.llm.components import components
from noticelake.llm.queries import op2_jaccard
from noticelake.llm.store import Scratch


def shingles(text, n=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, percent=85):
    """Components of {doc_id: text} by comparing all sets that share an n-gram."""
    sets = {i: shingles(t) for i, t in rows.items()}
    parent = {i: i for i in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = defaultdict(list)
    for i in sorted(sets):
        seen = set()
        for g in sets[i]:
            seen.update(lists[g])
            lists[g].append(i)
        for j in seen:
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in rows}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert result(op2_jaccard(spark, sf)) == brute(rows)


def test_group_of_near_copies_and_common_passages(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT", 40)
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    base, passage = rng.choice(words, 80).tolist(), rng.choice(words, 40).tolist()
    rows = {}
    for i in range(250):
        if i % 3 == 0:  # copies with more and more edits
            t = list(base)
            for at in rng.choice(80, rng.integers(0, 5), replace=False):
                t[at] = str(rng.choice(words))
        elif i % 3 == 1:  # a passage that a third of all share
            t = rng.choice(words, rng.integers(0, 60)).tolist() + passage
        else:
            t = rng.choice(words, rng.integers(0, 12)).tolist()
        rows[i] = " ".join(t)
    assert result(jaccard.join(docs(*rows.items()))) == brute(rows)


def test_numbers_of_links(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 7)
    monkeypatch.setattr(jaccard, "COLUMNS", 16)
    monkeypatch.setattr(jaccard, "PART_GRAMS", 4000)
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    base, rows = rng.choice(words, 70).tolist(), {}
    for i in range(120):  # near copies of several lengths, every fourth an exact copy of the one before
        t = list(base)[: int(rng.integers(50, 71))]
        for at in rng.choice(len(t), rng.integers(0, 3), replace=False):
            t[at] = str(rng.choice(words))
        rows[i] = rows[i - 1] if i % 4 == 1 else " ".join(t)
    rows |= {200: "a b c", 201: "A b c", 202: "a b", 203: "", 204: None}
    sets = {i: shingles(t) for i, t in rows.items()}
    want = {i: sum(i != j and bool(a) and 100 * len(a & b) >= 85 * len(a | b) for j, b in sets.items()) for i, a in sets.items()}
    out = jaccard.join(docs(*rows.items(), (None, "a b"), (7, rows[7])), count_links=True)
    assert {r["doc_id"]: r["n_links"] for r in out.where("doc_id is not null").collect()} == want
    assert [r["n_links"] for r in out.where("doc_id is null").collect()] == [None]
    assert result(out.where("doc_id is not null")) == brute(rows) and sum(want.values()) > 2 * len(rows)


def test_threshold_is_exact(docs):
    words = [f"w{i}" for i in range(103)]
    rows = {1: " ".join(words)}  # 100 shingles
    for k in range(2, 26):
        rows[k] = " ".join(words[: 103 - k + 1] + [f"x{k}y{j}" for j in range(k // 3)])
    assert result(jaccard.join(docs(*rows.items()))) == brute(rows)


def test_edge_rows(docs):
    df = docs((4, None), (3, ""), (9, "A b"), (8, "a B"), (7, "a b c d"), (None, "a b"), (6, "x " * 5000), (5, "x " * 9000), (2, "one two three four five"), (2, "one two three four five"), (2, "a b c d"), (1, "\x0b\x1cq r"))
    got = sorted((tuple(r) for r in jaccard.join(df).collect()), key=str)
    assert got == sorted(
        [(4, 0, 4), (3, 0, 3), (9, 1, 8), (8, 1, 8), (7, 1, 2), (None, 1, None), (6, 1, 5), (5, 1, 5), (2, 2, 2), (2, 2, 2), (2, 1, 2), (1, 1, 1)], key=str
    )
    assert jaccard.join(df.limit(0)).count() == 0
    assert result(jaccard.join(docs((1, None), (2, "")))) == {1: (0, 1), 2: (0, 2)}


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(links, Scratch(spark, "t"), "c").collect()}
    assert got == {i: root(i) for a, b in pairs if a != b for i in (a, b)}
    assert components(links.limit(0), Scratch(spark, "t"), "c").count() == 0
