import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from noticelake.llm import variants
from noticelake.llm.queries import op11_variants


def vocabulary(rows, one_in=199, least=6, often=5):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % one_in == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= least and k >= often}


def near_words(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(n):
    form, near = {}, {}
    for w in n:
        around = [x for x in n if near_words(w, x)]
        best = min(around, key=lambda x: (-n[x], x), default=None)
        near[w], form[w] = len(around), best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], near[w], n.get(form[w])))
    return out


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force(spark, documents):
    want = brute(vocabulary([(r["doc_id"], r["text"]) for r in documents.collect()]))
    assert result(op11_variants(spark, "/root/testdata/sf0.001")) == want


@pytest.mark.parametrize("whole", [1, 4, 7, 64])
def test_near_words_however_long_the_prefixes_held(docs, whole):
    rng = np.random.default_rng(whole)
    words = {"".join(rng.choice(list("abé"), rng.integers(4, 10))) for _ in range(150)} | {"aaaaaa", "aaaaaaa", "aaaaaab", "é" * 90, "é" * 91, "é" * 45 + "a" + "é" * 45}
    texts = [(i, " ".join([w] * int(rng.choice([1, 5, 6, 30, 200])))) for i, w in enumerate(sorted(words))]
    n = vocabulary(texts, often=2, least=4)
    want = brute(n)
    got = result(variants.group(docs(*texts), least=4, often=2, whole=whole))
    assert got == want
    assert any(w[4] for w in want if len(w[0]) >= 90)


def test_chains_lead_to_the_last_form(docs):
    words = {"chain" + c * 1: 0 for c in "abc"}
    texts = [(0, "chainab " * 5), (1, "chainbb " * 25), (2, "chainbc " * 125), (3, "chaincc " * 625)]
    rows = {r["word"]: (r["form"], r["root"]) for r in variants.group(docs(*texts), one_in=10**9).collect()}
    assert rows["chainab"] == ("chainbb", "chaincc") and rows["chaincc"] == (None, "chaincc") and words


def test_rotations_of_a_word_of_any_length_are_bounded():
    word = "ab" * 20_000
    rows = list(variants.rotations(word))
    assert len(rows) == 2 * len(word) + 1 and max(len(r[0]) for r in rows) < 60


def test_sums_equal_zlib():
    words = ["", "a", "wörter", "x" * 63, "x" * 64, "x" * 65, "é" * 400]
    got = variants.crc32_after(np.array([zlib.crc32(b"7:")] * len(words), np.uint32), pa.array(words, pa.large_string()), np.arange(len(words)))
    assert got.tolist() == [zlib.crc32(b"7:" + w.encode()) for w in words]


def test_edge_rows(docs, spark):
    long = "Letters " * 40_000
    rows = docs((1, None), (2, ""), (3, "..12.."), (None, "Wordings " * 6), (4, "same word letterz letterz"), (4, "same word letterz letterz"), (4, "same word letterz"), (5, long))
    texts = [(r["doc_id"], r["text"]) for r in rows.collect()]
    assert result(variants.group(rows)) == brute(vocabulary(texts)) != set()
    assert variants.group(docs().limit(0)).count() == 0
    assert result(variants.group(rows.repartition(5))) == result(variants.group(rows))
