"""Append-only tables with an index of their keys in hash buckets.

A batch is compared with the buckets its own keys fall into and with nothing else of the table. Rows and
keys of a batch become visible in one commit, so a batch that is run again, whether it had died before or not, finds
either none or all of its keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticelake.operators.keyed import keep_first
from noticelake.sources.snapshots import Snapshots, Version

BUCKETS = 64
#: Folders of a bucket that are put together when it gets one more.
FOLDERS = 8


class KeyedTable:
    """One table inside a folder of snapshots; several of different names can share it and be committed together.

    A row with a NULL in its key is never known. Rows keep the schema of the first batch.
    """

    def __init__(self, shots: Snapshots, keys: Sequence[str], name: str = "rows", buckets: int = BUCKETS):
        self.shots, self.keys, self.name, self.buckets = shots, list(keys), name, buckets

    # ------------------------------------------------------------ reading
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _folders(self, version: Version, prefix: str) -> list[str]:
        return [f"{self.shots.path}/{f}" for p, f in sorted(version.parts.items()) if p.startswith(f"{self.name}/{prefix}")]

    def rows(self, version: Version | None = None, since: int = 0) -> DataFrame | None:
        """All rows, or those committed after version ``since``; None before the first batch."""
        version = version or self.shots.newest()
        kind = version.facts.get(f"{self.name}/schema")
        if kind is None:
            return None
        schema = StructType.fromJson(kind)
        first = f"{self.name}/rows/"
        folders = [f for p, f in sorted(version.parts.items()) if p.startswith(first) and int(p.removeprefix(first)) > since]
        spark = self.shots.spark
        return spark.read.schema(schema).parquet(*[f"{self.shots.path}/{f}" for f in folders]) if folders else spark.createDataFrame([], schema)

    def known(self, version: Version, buckets: Sequence[int], like: DataFrame) -> DataFrame:
        """Stored keys of these buckets; ``like`` gives their types."""
        folders = [f for b in buckets for f in self._folders(version, f"keys/{b}/")]
        schema = like.select(*self.keys).schema
        spark = self.shots.spark
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def touched(self, batch: DataFrame) -> list[int]:
        """Buckets that the keys of a batch fall into: at most ``buckets`` numbers."""
        return sorted(r["b"] for r in batch.select(self._bucket().alias("b")).distinct().collect())

    # ------------------------------------------------------------ writing
    def stage(self, base: Version, batch: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, Version]:
        """Writes the rows of new keys, the first of each in ``order``; returns them and what ``base`` becomes with them.

        Nobody sees them until the caller commits that.
        """
        batch = batch.persist()
        try:
            touched = self.touched(batch)
            known = self.known(base, touched, batch)
            new = batch.join(known, self.keys, "left_anti")
            folder = self.shots.folder()
            keep_first(new, self.keys, order).write.parquet(f"{self.shots.path}/{folder}")
        finally:
            batch.unpersist()
        fresh = self.shots.spark.read.schema(batch.schema).parquet(f"{self.shots.path}/{folder}")
        parts = dict(base.parts)
        kind = base.facts.get(f"{self.name}/schema") or batch.schema.jsonValue()
        facts = {**base.facts, f"{self.name}/schema": kind}
        if fresh.isEmpty():
            return fresh, Version(base.number, parts, facts)
        crowded = [b for b in touched if len(self._folders(base, f"keys/{b}/")) >= FOLDERS]
        keys = fresh.select(*self.keys).unionByName(self.known(base, crowded, batch))
        written = self.shots.write_parts(keys.withColumn("__bucket", self._bucket()), "__bucket", keep=False)
        parts = {p: f for p, f in parts.items() if not any(p.startswith(f"{self.name}/keys/{b}/") for b in crowded)}
        parts |= {f"{self.name}/keys/{b}/{base.number + 1:012d}": f for b, f in written.items()}
        parts[f"{self.name}/rows/{base.number + 1:012d}"] = folder
        return fresh, Version(base.number, parts, facts)

    def append_new(self, batch: DataFrame, order: Sequence[Column], facts: Mapping | None = None) -> DataFrame:
        """Appends rows whose key is absent in one commit and returns them. Running the same batch again appends nothing."""
        base = self.shots.newest()
        fresh, staged = self.stage(base, batch, order)
        if staged.parts != base.parts or facts:
            self.shots.commit(base, staged.parts, {**staged.facts, **(facts or {})})
        return fresh
