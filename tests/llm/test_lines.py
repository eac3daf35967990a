import hashlib
from collections import Counter

import numpy as np
import pytest

from noticelake.llm import cuckoo, lines
from noticelake.llm.lines import LineIndex
from noticelake.llm.queries import op12_lines

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def often(texts, min_docs=10, least=1):
    n = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if len(k) >= least)
    return {k for k, c in n.items() if c >= min_docs}


def cut(texts, drop):
    out = []
    for t in texts:
        parts = (t or "").split("\n")
        kept = [x for x in parts if key(x) not in drop]
        out.append((len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def got(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect())


def want(rows, drop):
    return sorted((i if i is not None else -1, *c) for (i, _), c in zip(rows, cut([t for _, t in rows], drop)))


def test_query_equals_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    expected = want(rows, often([t for _, t in rows]))
    have = op12_lines(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in have) == [(a, b, c, hashlib.sha256(k.encode()).hexdigest()) for a, b, c, k in expected]
    assert any(r["n_dropped"] for r in have)


ROWS = [(i, f"own {i}\nShared A\n\n  shared b \r\nÀ bientôt{'' if i % 2 else ' x'}\n" + "tail\n" * (i % 4)) for i in range(12)]
EDGE = [(20, None), (21, ""), (22, "\n\n"), (None, "SHARED a"), (23, "shared a"), (23, "shared a"), (24, "z" * 200_000 + "\nshared a")]


@pytest.mark.parametrize("held", [0, lines.HELD_BYTES])
def test_edge_rows_with_filters_held_or_joined(docs, held, tmp_path, spark):
    rows = ROWS + EDGE
    df = docs(*rows)
    index = LineIndex(spark, str(tmp_path / "index"), min_docs=5, held_bytes=held)
    index.insert(df)
    drop = often([t for _, t in rows], 5)
    assert {"shared a", "shared b"} <= drop
    assert got(index.cut(df)) == want(rows, drop)
    new = [(50, "Shared B\nnever seen"), (51, None)]
    assert got(index.cut(docs(*new))) == want(new, drop)


def test_empty_table(docs):
    assert lines.dedup(docs()).count() == 0


def test_shorter_keys_stay(docs):
    rows = [(i, "é\nab\nabc") for i in range(12)]
    assert got(lines.dedup(docs(*rows), min_length=3)) == want(rows, {"abc"})


def test_insertions_and_deletions_are_reversible(docs, tmp_path, spark):
    index = LineIndex(spark, str(tmp_path / "index"), min_docs=5, shards=4)
    state = lambda: sorted(map(tuple, index.counts().collect()))
    frequent = lambda: {tuple(r) for r in index.frequent().collect()}
    first, second = ROWS[:6], ROWS[6:] + EDGE
    index.insert(docs(*first), batch="one")
    before, many = state(), frequent()
    index.insert(docs(*first), batch="one")  # run again: nothing happens
    assert state() == before
    index.insert(docs(*second), batch="two")
    assert got(index.cut(docs(*ROWS))) == want(ROWS, often([t for _, t in ROWS + EDGE], 5))
    index.delete(docs(*second))
    assert state() == before and frequent() == many
    assert got(index.cut(docs(*ROWS))) == want(ROWS, often([t for _, t in first], 5))
    filters = {r["shard"]: bytes(r["filter"]) for r in index._filters(index.table.newest()).collect()}
    assert sum(int((np.frombuffer(f, np.uint16) > 0).sum()) for f in filters.values()) == len(many)
    index.compact()
    assert state() == before and len(index._segments(index.table.newest())) == 1
    index.delete(docs(*first))
    assert state() == [] and got(index.cut(docs(*ROWS))) == want(ROWS, set())


def test_deleting_what_was_not_inserted_changes_nothing(docs, tmp_path, spark):
    index = LineIndex(spark, str(tmp_path / "index"))
    index.insert(docs(*ROWS))
    version = index.table.newest()
    with pytest.raises(ValueError):
        index.delete(docs((1, "a line of no document")))
    assert index.table.newest() == version
    with pytest.raises(ValueError):
        LineIndex(spark, str(tmp_path / "index"), min_docs=3)


def test_full_filters_are_built_anew(docs, tmp_path, spark):
    index = LineIndex(spark, str(tmp_path / "index"), min_docs=2, shards=1)
    small, large = [(i, "first") for i in range(2)], [(i, "\n".join(f"line {j}" for j in range(300))) for i in range(2)]
    index.insert(docs(*small))
    index.insert(docs(*large))
    assert got(index.cut(docs(*large))) == want(large, often([t for _, t in large], 2))


def test_filter_holds_what_it_was_given_and_little_else():
    rng = np.random.default_rng(3)
    hi, lo = (rng.integers(-(2**63), 2**63, 20_000, dtype=np.int64) for _ in range(2))
    made = cuckoo.Cuckoo.build(hi[:10_000], lo[:10_000])
    made.delete(hi[:5_000], lo[:5_000])
    held = cuckoo.Filters(1, {0: made.dump()}).holds(hi, lo)
    assert held[5_000:10_000].all() and held[:5_000].mean() < 0.01 and held[10_000:].mean() < 0.01
    assert (cuckoo.Cuckoo.load(made.dump()).table > 0).sum() == 5_000
