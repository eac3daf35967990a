"""Tables as lists of finished folders: one small file for each version is the only thing ever committed.

Data folders are written under new names and never changed. A version file names the folder of each
part of the table; it is written beside its place and renamed into it, and that rename is the commit. A
job that dies before it leaves the old version readable, and folders that no version names. Two
writers that start from one version can't both commit: the second finds the next number taken. The rename must
not replace a file, as on HDFS; other file systems are asked whether the name is free just before it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticelake.session import ensure_checkpoint_dir

PART = "_part"


class Conflict(RuntimeError):
    """Another writer has committed since the version that a change started from."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    #: Folder of each part, relative to the table.
    parts: Mapping[str, str] = field(default_factory=dict)
    #: Small values that belong to this version: the schema, ids of batches, counts.
    facts: Mapping[str, Any] = field(default_factory=dict)


class Snapshots:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def numbers(self) -> list[int]:
        """Numbers of the versions that are kept, oldest first."""
        return sorted(int(n) for n in self._names("versions") if n.isdigit())

    def version(self, number: int) -> Version:
        stream = self._fs.open(self._at(f"versions/{number:012d}"))
        text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        held = json.loads(text)
        return Version(number, held["parts"], held["facts"])

    def newest(self) -> Version:
        numbers = self.numbers()
        return self.version(numbers[-1]) if numbers else Version()

    def folder(self) -> str:
        """A new folder below the table, seen by nobody until a version names it."""
        return f"data/{uuid.uuid4().hex}"

    def commit(self, base: Version, parts: Mapping[str, str], facts: Mapping[str, Any]) -> Version:
        """Makes the next version after ``base``, or raises ``Conflict``."""
        new = Version(base.number + 1, dict(parts), dict(facts))
        final, draft = self._at(f"versions/{new.number:012d}"), self._at(f"drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps({"parts": new.parts, "facts": new.facts}, sort_keys=True).encode()))
        out.close()
        self._fs.mkdirs(self._at("versions"))
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise Conflict(f"version {new.number} of {self.path} is taken")
        return new

    def read(self, version: Version | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """Rows of a version, or of some of its parts: other folders are not opened."""
        version = version or self.newest()
        schema = StructType.fromJson(json.loads(version.facts["schema"]))
        named = version.parts if parts is None else {p: version.parts[p] for p in parts if p in version.parts}
        folders = [f"{self.path}/{f}" for f in dict.fromkeys(named.values())]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def write_parts(self, rows: DataFrame, part: str, keep: bool = True) -> dict[str, str]:
        """Writes rows by their part and returns the folder of each part. ``keep`` leaves the column in the files.

        ``rebalance`` lets Spark size the writers of a part by the bytes that reach them: small parts share a
        task, a large one is split over several.
        """
        folder = self.folder()
        keyed = rows.withColumn(PART, F.coalesce(F.col(part).cast("string"), F.lit(""))).hint("rebalance", PART)
        keyed = keyed if keep else keyed.drop(part)
        keyed.write.partitionBy(PART).parquet(f"{self.path}/{folder}")
        found = [n for n in self._names(folder) if n.startswith(f"{PART}=")]
        unescape = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        values = {n: unescape(n.removeprefix(f"{PART}=")) for n in found}
        return {"" if v == "__HIVE_DEFAULT_PARTITION__" else v: f"{folder}/{n}" for n, v in values.items()}

    def vacuum(self, keep: int = 2) -> None:
        """Forgets all but the newest ``keep`` versions and deletes the folders that none of those name.

        Not to be run beside a writer: folders of a change that is not committed yet are named by no version either.
        """
        numbers = self.numbers()
        used = {f for n in numbers[-keep:] for f in self.version(n).parts.values()}
        for n in numbers[:-keep]:
            self._fs.delete(self._at(f"versions/{n:012d}"), False)
        for name in self._names("data"):
            inner = {f for f in used if f.split("/")[1] == name}
            if not inner:
                self._fs.delete(self._at(f"data/{name}"), True)
            elif f"data/{name}" not in inner:
                for sub in self._names(f"data/{name}"):
                    if sub.startswith(f"{PART}=") and f"data/{name}/{sub}" not in inner:
                        self._fs.delete(self._at(f"data/{name}/{sub}"), True)
        self._fs.delete(self._at("drafts"), True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under ``spark.checkpoint.dir`` and read back: it cuts lineage and outlives a lost executor."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
