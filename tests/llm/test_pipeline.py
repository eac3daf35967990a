import hashlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from noticelake.llm import mixing, quality, secret_scan
from test_jaccard import brute as groups
from test_secrets import brute as secrets

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after every stage, each written and read again."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, f in pipeline.STAGES:
        before = docs
        f(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = (before, docs)
    return out


def test_columns(stages):
    for name, (before, after) in stages.items():
        if name != "tokens":
            assert after.columns == before.columns


def test_quality_keeps_good_and_drops_bad(spark, stages):
    before, after = stages["quality"]
    kept = {r["doc_id"] for r in after.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert np.mean([i in kept for i, q in labels.items() if q == 1]) >= 0.99
    assert np.mean([i in kept for i, q in labels.items() if q == 0]) <= 0.1
    want = {r["doc_id"] for r in quality.classify(before, spark.read.parquet(f"{SF}/labels.parquet")).where("accepted").collect()}
    assert kept == want


def test_one_of_each_group_stays(stages, monkeypatch):
    import test_jaccard

    monkeypatch.setattr(test_jaccard, "shingles", lambda text, n=5, f=test_jaccard.shingles: f(text, 5))
    before, after = stages["near_copies"]
    want = groups({r["doc_id"]: r["text"] for r in before.collect()}, percent=80)
    assert {r["doc_id"] for r in after.collect()} == {c for _, c in want.values()}
    assert after.count() == len({c for _, c in want.values()})


def test_secrets_are_gone(stages):
    before, after = stages["secrets"]
    assert before.count() == after.count()
    old = {r["doc_id"]: r for r in before.collect()}
    for r in after.collect():
        assert secrets(r["text"])[0] == [0, 0, 0] and r["n_chars"] == len(r["text"])
        if secrets(old[r["doc_id"]]["text"])[2]:
            assert "[secret]" in r["text"] or "[example]" in r["text"]
    same = [r["text"] == old[r["doc_id"]]["text"] for r in after.collect()]
    found = secret_scan.scan(before).count()
    assert same.count(False) == found


def test_mix_takes_each_document_as_decided(stages):
    before, after = stages["mixing"]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect()}
    taken: dict[int, int] = {}
    for r in after.collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + 1
    assert taken == {i: c for i, c in copies.items() if c}


def test_tokens_equal_library(stages):
    before, after = stages["tokens"]
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in before.collect():
        ids = lib.encode(r["text"], add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()))
    assert rows_of(after) == sorted(want, key=str)


def test_run_equals_its_stages(spark, stages):
    assert rows_of(pipeline.run(spark, SF)) == rows_of(stages["tokens"][1])
    assert entry.queries()["pipeline"] is pipeline.run and len(pipeline.STAGES) == 5


def test_different_texts_of_one_id_both_stay(spark, docs):
    a, b, c = (" ".join(f"{p}{i}" for i in range(40)) for p in "abc")
    df = docs((1, a), (1, b), (2, b), (None, c), (None, c, "de"), (None, a), (3, None), (3, ""), (3, ""))
    out = pipeline.keep_one_of_each_group(spark, df, "")
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in out.collect()) == sorted([("1", a), ("1", b), ("3", ""), ("None", c)])
    again = pipeline.keep_one_of_each_group(spark, df.repartition(7), "")
    assert rows_of(out) == rows_of(again)


def test_edge_rows(spark, docs, tmp_path):
    text = " ".join(f"word{i} the" for i in range(40))
    df = docs((1, text), (2, text), (2, text), (None, text), (3, None), (4, ""), (5, "short password=hunter22"))
    spark.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = df
    for name, f in pipeline.STAGES:
        out = f(spark, out, str(tmp_path))
        if name == "near_copies":
            assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "5"]
        assert name == "tokens" or out.columns == df.columns
    empty = df.limit(0)
    for _, f in pipeline.STAGES:
        empty = f(spark, empty, str(tmp_path))
    assert empty.count() == 0
