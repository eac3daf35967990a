"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from noticelake.session import ensure_checkpoint_dir


class Scratch:
    """Tables written under ``spark.checkpoint.dir``: they cut lineage and outlive a lost executor."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once as Parquet and read back, with the schema it had."""
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Removes a table that no later step reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of one Arrow batch: texts of any length reach Python in pieces that a few workers of an executor can hold.
BATCH_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Gives the executors this package's code, once for each application, as ``--py-files`` would, and bounds batches by their bytes."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if getattr(context, "_noticelake_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    zipped = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(zipped)
    context._noticelake_shipped = True
