"""Writers. Merged tables are snapshots: a batch writes only the partitions it touches, beside the old ones, and commits once."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.operators.keyed import upsert_non_null, upsert_replace
from noticelake.sources.snapshots import Snapshots, Version


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def truncated(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Text columns cut to the length the target column holds."""
    return df.withColumns({c: F.substring(c, 1, n) for c, n in lengths.items() if c in df.columns})


def upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition: str,
    non_null_only: bool = True,
    order: str | None = None,
    keep: Sequence[str] = ("created_at",),
) -> Version:
    """Merges a batch into a table of snapshots and returns the version it made.

    The partition column must be a function of the key. Only partitions that the batch touches are read and written, into new folders;
    readers see them all at once with the commit, and a job that dies before it leaves the table as it was.
    The driver holds one name a partition, never keys.
    """
    rule = upsert_non_null if non_null_only else upsert_replace
    table = Snapshots(spark, path)
    base = table.newest()
    held = [c for c in keep if c in batch.columns]
    batch = batch.persist()
    try:
        touched = sorted(r["p"] for r in batch.select(F.coalesce(F.col(partition).cast("string"), F.lit("")).alias("p")).distinct().collect())
        current = table.read(base, touched) if base.parts else batch.limit(0)
        merged = rule(current, batch, keys, order, held)
        written = table.write_parts(merged, partition)
    finally:
        batch.unpersist()
    return table.commit(base, {**base.parts, **written}, {**base.facts, "schema": merged.schema.json()})


def append(path: str, rows: DataFrame, partition: str | None = None) -> None:
    writer = rows.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def write_run_json(path: str, rows: DataFrame, run_id: str = "run_id") -> None:
    """JSON lines per run; a re-run of the same run replaces its own folder only."""
    rows.write.option("partitionOverwriteMode", "dynamic").partitionBy(run_id).mode("overwrite").json(path)


def write_report(path: str, rows: DataFrame, statistics: DataFrame) -> None:
    """Rows and their fill statistics as two CSV folders."""
    rows.write.mode("overwrite").option("header", "true").csv(f"{path}/rows")
    statistics.write.mode("overwrite").option("header", "true").csv(f"{path}/statistics")


def write_jdbc(rows: DataFrame, url: str, table: str, keys: Sequence[str], batch_id: str, properties: Mapping[str, str], log: str = "loaded_batches") -> bool:
    """Upserts a batch into a database table once; False if the batch was loaded before.

    The executors write a staging table of the batch's own name, which a run that follows a dead one simply writes anew. One
    transaction then deletes the rows that the batch replaces, inserts the staged ones and records the batch id, whose
    primary key lets only one of two writers through. Keys have to be unique in the batch. ``table`` and ``log`` must exist or be creatable.
    """
    spark = rows.sparkSession
    stage = f"{table}_stage_{hashlib.sha256(batch_id.encode()).hexdigest()[:12]}"
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, v)
    if properties.get("driver"):
        jvm.java.lang.Class.forName(properties["driver"], True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.setAutoCommit(False)
        run = connection.createStatement()

        def has(name: str) -> bool:
            found = connection.getMetaData().getTables(None, None, None, None)
            names = set()
            while found.next():
                names.add(found.getString("TABLE_NAME").lower())
            return name.lower() in names

        if not has(log):
            run.execute(f"CREATE TABLE {log} (target VARCHAR(128) NOT NULL, batch_id VARCHAR(256) NOT NULL, PRIMARY KEY (target, batch_id))")
            connection.commit()
        seen = connection.prepareStatement(f"SELECT 1 FROM {log} WHERE target = ? AND batch_id = ?")
        seen.setString(1, table)
        seen.setString(2, batch_id)
        if seen.executeQuery().next():
            connection.rollback()
            return False
        connection.rollback()
        rows.write.jdbc(url, stage, mode="overwrite", properties=dict(properties))
        if not has(table):
            rows.limit(0).write.jdbc(url, table, mode="append", properties=dict(properties))
        names = ", ".join(f'"{c}"' for c in rows.columns)
        same = " AND ".join(f'{stage}."{k}" = {table}."{k}"' for k in keys)
        run.execute(f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {stage} WHERE {same})")
        run.execute(f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}")
        done = connection.prepareStatement(f"INSERT INTO {log} VALUES (?, ?)")
        done.setString(1, table)
        done.setString(2, batch_id)
        done.execute()
        run.execute(f"DROP TABLE {stage}")
        connection.commit()
        return True
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def status_updates(raw: DataFrame, outcome: DataFrame, key: str, as_of) -> DataFrame:
    """Raw rows with status, time and reason of their outcome; rows without one keep theirs."""
    o = outcome.select(key, F.col("status").alias("_status"), F.col("reason").alias("_reason"))
    done = F.col("_status").isNotNull()
    return (
        raw.join(o, key, "left")
        .withColumn("status", F.coalesce("_status", "status"))
        .withColumn("processed_at", F.when(done, F.lit(as_of).cast("timestamp")).otherwise(F.col("processed_at")))
        .withColumn("rejection_reason", F.when(done, F.col("_reason")).otherwise(F.col("rejection_reason")))
        .drop("_status", "_reason")
    )
