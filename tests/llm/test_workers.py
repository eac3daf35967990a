"""What the operators leave behind in the Python workers, which Spark keeps from stage to stage."""

import os
import re
import time
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from noticelake.llm import bpe, jaccard, quality

public_tokenizers = pytest.importorskip("public_tokenizers")


def in_workers(spark, value):
    """Largest ``value()`` of the workers: tasks that wait for each other's time take all of them, more than once."""

    def run(batches):
        for batch in batches:
            time.sleep(0.3)
            yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "value": [float(value())]})

    rows = spark.range(0, 24, 1, 24).mapInArrow(run, "pid bigint, value double").groupBy("pid").agg(F.max("value").alias("value"))
    return max(r["value"] for r in rows.collect())


def held_mb():
    return lambda: int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


def kept_pieces(path):
    return lambda: len(bpe.vocabulary(path).known)


@pytest.fixture
def texts(spark, tmp_path):
    """Four files of 3 MB of different words."""
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: F.substring(F.sha1(F.concat_ws("-", "id", i).cast("binary")), 1, 9)))
    ids = spark.range(0, 1200, 1, 4)
    df = ids.select(F.col("id").alias("doc_id"), words.alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    ids.select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)


def test_scans_give_their_memory_back(spark, texts):
    docs, folder = texts
    before = in_workers(spark, held_mb())
    assert quality.classify(docs, spark.read.parquet(f"{folder}/labels.parquet")).count() == 1200
    assert jaccard.join(docs).count() == 1200
    after = in_workers(spark, held_mb())
    assert after < before + 60


def test_tokens_take_one_worker_a_task_and_keep_no_pieces(spark, texts, capsys):
    docs, folder = texts
    out = pipeline.tokenize(spark, docs, folder)
    assert out.where("n_tokens > 0").count() == 1200
    capsys.readouterr()
    out.explain()
    one_pass = capsys.readouterr().out.count("MapInArrow") == 1
    assert in_workers(spark, kept_pieces(public_tokenizers.path("byte_bpe_50k.json"))) == 0
    assert one_pass
