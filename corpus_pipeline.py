"""A training corpus from raw documents: quality, near copies, secrets, mixing, tokens.

Every stage takes the documents that its predecessor kept and returns documents of the same columns; the
last one returns the token ids. ``run`` writes each stage's rows to the shared folder and reads them
back, so a lost executor costs a task and not the stages before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm import bpe, jaccard, mixing, quality, secret_scan
from noticelake.llm.queries import vocabulary_path
from noticelake.llm.store import Scratch, ship_package
from noticelake.operators.keyed import keep_first


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Rows without text go, for there is nothing to judge."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_accepted(docs, quality.classify(docs, labels))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with like n-grams the one with the smallest id; equal rows become one.

    Words of five and a similarity of 0.8, as near copies are taken elsewhere. A document is an id with a text: two texts under one id
    are two documents, and one stays of each component that they are in. A null id comes after all others. Of rows with
    one id and text the one of the smallest hash over all columns stays, so reruns agree.
    """
    ship_package(spark)
    key = F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("__key")
    marked = docs.select("*", key)
    scratch = Scratch(spark, "near-copies")
    groups = jaccard.join(docs.select(key, "text"), id_col="__key", n=5, percent=80)
    groups = scratch.save(groups.select("__key", F.col("component_id").alias("__group")).distinct(), "groups")
    named = marked.select("__key", "doc_id").distinct().join(groups, "__key")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__key"))
    heads = named.groupBy("__group").agg(F.min_by("__key", order).alias("__head"))
    # Only keys that go are joined, so that texts which stay don't travel while those are few.
    gone = scratch.save(groups.join(heads, F.col("__key") == F.col("__head"), "left_anti").select("__key"), "gone")
    several = scratch.save(marked.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__key"), "several")
    kept = marked.join(gone, "__key", "left_anti")
    one = keep_first(kept.join(several, "__key", "left_semi"), ["__key"], [F.xxhash64(*[F.col(c) for c in docs.columns])])
    return kept.join(several, "__key", "left_anti").unionByName(one).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of each secret."""
    out = secret_scan.redact(docs, secret_scan.scan(docs))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs, mixing.mix(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the kept texts, with the digests of the ids and of the text decoded from them."""
    ship_package(spark)
    path = vocabulary_path("byte_bpe_50k.json")
    return bpe.digests(bpe.encode_and_decode(docs.select("doc_id", "text"), path))


STAGES = [
    ("quality", keep_good),
    ("near_copies", keep_one_of_each_group),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: The model, the draws and the merges have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
