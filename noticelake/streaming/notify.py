"""Streams that react to new rows: notifications, alerts and their outbox."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, StructField, StructType

from noticelake.operators.keyed import keep_first
from noticelake.operators.paging import top_k_per
from noticelake.plans.health import all_alerts, pipeline_alerts
from noticelake.plans.match import by_notice, condition, condition_matches, members, profiles, uncovered
from noticelake.presets import br_notices as br
from noticelake.sources.keyed_table import BUCKETS, KeyedTable
from noticelake.sources.snapshots import Snapshots, Version

NOTICE = ("notice_id", "region", "city", "tags", "value")
FILTER = ("filter_id", "user_id", "is_active", "f_region", "f_city", "f_tags", "f_min", "f_max")


class Matches:
    """Who is told about which notice, kept while notices and filters arrive in any order.

    New notices meet all filters, and new or changed filters the notices stored before: each pair is looked at
    when the later of the two arrives, so in the end the same pairs are known as if all had come at once. Notices, filters and hits are
    committed together; a change that is run again adds nothing.

    A hit is a notice and what filters ask for, found at a version: it holds for every filter that asked for it then, or only for those that
    had just begun to where the notice is older. Users and filter ids are put to it when it is read, so nothing is stored for each user.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.shots = spark, Snapshots(spark, path)
        self.notices = KeyedTable(self.shots, ["notice_id"], "notices", buckets)
        self.versions = KeyedTable(self.shots, ["filter_id", "state"], "filters", buckets)

    def filters(self, rows: DataFrame | None) -> DataFrame | None:
        """The newest state of each filter; an inactive one is kept to close the older ones."""
        return None if rows is None else keep_first(rows, ["filter_id"], [F.desc("change"), F.col("state")]).select(*FILTER, "condition")

    def change(self, notices: DataFrame | None = None, filters: DataFrame | None = None) -> DataFrame:
        """Takes new notices and new or changed filters; returns the notifications to send: (user_id, notice_id, filter_id)."""
        base = now = self.shots.newest()
        if "pairs/schema" in base.facts:
            raise ValueError(f"{self.shots.path} was written with a row for each user and notice; make it again from its notices and filters")
        old_notices = self.notices.rows(base)
        fresh_notices = fresh_filters = None
        if notices is not None:
            fresh_notices, now = self.notices.stage(now, notices.select(*NOTICE), [F.hash("region", "city")])
            fresh_notices = None if now.parts == base.parts else fresh_notices
        if filters is not None:
            f = filters.select(*FILTER)
            f = f.withColumn("state", F.sha2(F.to_json(F.struct(*FILTER)), 256)).withColumn("change", F.lit(base.number + 1)).withColumn("condition", condition())
            before = now
            fresh_filters, now = self.versions.stage(now, f, [F.col("change")])
            fresh_filters = None if now.parts == before.parts else fresh_filters
        every, changed = self.filters(self.versions.rows(base)), self.filters(fresh_filters)
        if changed is not None:
            every = changed if every is None else every.join(changed.select("filter_id"), "filter_id", "left_anti").unionByName(changed)
        parts = dict(now.parts)
        if fresh_notices is not None and every is not None:
            parts |= self._stage_hits(fresh_notices, every, base.number + 1, late=False)
        if changed is not None and old_notices is not None:
            parts |= self._stage_hits(old_notices, changed, base.number + 1, late=True)
        if parts != base.parts:
            now = self.shots.commit(base, parts, now.facts)
        sent = self.outbox(base.number, now)
        return sent if sent is not None else self.spark.createDataFrame([], "user_id string, notice_id long, filter_id string")

    def _stage_hits(self, notices: DataFrame, filters: DataFrame, at: int, late: bool) -> dict[str, str]:
        """Writes what these notices meet; ``late`` where they are older than the filters."""
        hits = condition_matches(notices, members(uncovered(filters)))
        folder = self.shots.folder()
        hits.select("notice_id", "condition", F.lit(at).alias("at"), F.lit(late).alias("late")).write.parquet(f"{self.shots.path}/{folder}")
        return {f"hits/{at:012d}/{'late' if late else 'new'}": folder}

    def _hits(self, version: Version, since: int = 0, upto: int | None = None) -> DataFrame | None:
        """Hits of the versions after ``since`` up to ``upto``."""
        numbers = {p: int(p.split("/")[1]) for p in version.parts if p.startswith("hits/")}
        folders = [f"{self.shots.path}/{version.parts[p]}" for p, n in sorted(numbers.items()) if n > since and (upto is None or n <= upto)]
        # The notices' schema names the type of their key.
        key = StructType.fromJson(version.facts["notices/schema"])["notice_id"] if folders else None
        schema = StructType([key, StructField("condition", BinaryType()), StructField("at", IntegerType()), StructField("late", BooleanType())]) if folders else None
        return self.spark.read.schema(schema).parquet(*folders) if folders else None

    def _held(self, version: Version) -> DataFrame:
        """Filters by what they ask for: (filter_id, user_id, condition, since, until), from one version up to the one that changed them."""
        states = keep_first(self.versions.rows(version), ["filter_id", "change"], [F.col("state")])
        until = F.lead("change").over(W.partitionBy("filter_id").orderBy("change"))
        return states.withColumn("until", until).where("is_active").select("filter_id", "user_id", "condition", F.col("change").alias("since"), "until")

    def _told(self, hits: DataFrame, version: Version) -> tuple[DataFrame, DataFrame]:
        """Users by profile, and (profile, notice_id, at, place) of the hits that hold for a filter of a profile.

        What belongs to a notice is in one task then, so hits are not shuffled again to be grouped by it.
        """
        users, asked = profiles(self._held(version), ["condition", "since", "until"])
        holds = F.when(F.col("late"), F.col("at") == F.col("since")).otherwise((F.col("at") >= F.col("since")) & (F.col("until").isNull() | (F.col("at") < F.col("until"))))
        return users, by_notice(hits).join(asked, "condition").where(holds).select("profile", "notice_id", "at", "place")

    def known(self) -> DataFrame | None:
        """One row a user and notice with the lowest filter id that has matched it."""
        version = self.shots.newest()
        hits = self._hits(version)
        if hits is None:
            return None
        users, told = self._told(hits, version)
        first = told.groupBy("profile", "notice_id").agg(F.min("place").alias("place"))
        return first.join(users, "profile").select("user_id", "notice_id", F.get("ids", F.col("place")).alias("filter_id"))

    def outbox(self, since: int = 0, version: Version | None = None) -> DataFrame | None:
        """Notifications first sent after version ``since``, for a pusher that keeps the number of the last version it has read."""
        version = version or self.shots.newest()
        hits = self._hits(version, since)
        if hits is None:
            return None
        # Only a notice that is older than the filter it meets can have been told of before.
        before = self._hits(version, 0, since) if any(p.startswith("hits/") and p.endswith("/late") and int(p.split("/")[1]) > since for p in version.parts) else None
        if before is not None:
            hits = hits.unionByName(before.join(hits.where("late").select("notice_id").distinct(), "notice_id", "left_semi"))
        users, told = self._told(hits, version)
        first = told.groupBy("profile", "notice_id").agg(F.min(F.struct("at", "place")).alias("first")).where(F.col("first.at") > since)
        return first.join(users, "profile").select("user_id", "notice_id", F.get("ids", F.col("first.place")).alias("filter_id"))


def notify_changes(notices: DataFrame, filters: DataFrame, state: Matches, checkpoint: str) -> StreamingQuery:
    """Two streams, of notices and of saved filters, matched as their rows arrive; each user hears of a notice once."""
    n = notices.select(F.struct(*NOTICE).alias("n"), F.lit(None).cast(filters.select(F.struct(*FILTER).alias("f")).schema["f"].dataType).alias("f"))
    f = filters.select(F.lit(None).cast(n.schema["n"].dataType).alias("n"), F.struct(*FILTER).alias("f"))

    def handle(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        state.change(batch.where("n is not null").select("n.*"), batch.where("f is not null").select("f.*"))
        batch.unpersist()

    return n.unionByName(f).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def alert_on_runs(
    runs: DataFrame, target: KeyedTable, checkpoint: str, group: str | None = None, history: Snapshots | None = None, idle: int = br.IDLE_RUNS
) -> StreamingQuery:
    """Alerts of every finished run, stored once per run and rule; ``target`` is keyed by run_id and kind.

    With ``group`` (the column of the pipeline) ``idle`` runs without new rows in a row are told too. Of earlier runs ``history`` holds the
    last few of each pipeline, all that the rule can ask for, so a batch never reads further back.
    """
    def found(batch: DataFrame, earlier: DataFrame | None) -> DataFrame:
        if group is None:
            return pipeline_alerts(batch)
        seen = batch if earlier is None else earlier.join(batch.select("run_id"), "run_id", "left_anti").unionByName(batch)
        return all_alerts(seen, group).join(batch.select("run_id").distinct(), "run_id", "left_semi")

    def handle(batch: DataFrame, _: int) -> None:
        base = history.newest() if history is not None else Version()
        earlier = history.read(base) if base.parts else None
        target.append_new(found(batch, earlier), [F.col("severity")])
        if history is None:
            return
        both = batch if earlier is None else earlier.join(batch.select("run_id"), "run_id", "left_anti").unionByName(batch)
        last = top_k_per(both, [group], [F.desc("started_at"), F.desc("run_id")], max(idle - 1, 1), rank="__place").drop("__place")
        folder = history.folder()
        last.write.parquet(f"{history.path}/{folder}")
        history.commit(base, {"last": folder}, {"schema": batch.schema.json()})

    return runs.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
