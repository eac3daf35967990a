"""Incremental ingest: only records with an unseen key go on."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from noticelake.sources.keyed_table import KeyedTable


def read_landing(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def unique_in_session(stream: DataFrame, keys: Sequence[str], time: str, within: str = "1 hour") -> DataFrame:
    """First record per key; state older than the watermark is dropped."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))


def incremental_ingest(
    stream: DataFrame, target: KeyedTable, checkpoint: str, order: Callable[[], list], transform: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Append new keys of every micro-batch to ``target``.

    A batch reads the key buckets that it touches, not the table. Replayed after a failure, or by a stream that has lost its
    checkpoint, it finds its keys stored and adds nothing. Progress is in the checkpoint folder, which
    must be shared storage on a cluster.
    """
    def handle(batch: DataFrame, _: int) -> None:
        target.append_new(transform(batch) if transform else batch, order())

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def full_reload(batch: DataFrame, target: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Forced run: the target is rebuilt from the whole input."""
    (transform(batch) if transform else batch).write.mode("overwrite").parquet(target)
