"""Saved filters against notices: which user is told about which notice.

Every filter is joined through one equality, the most selective one it has: a value range that holds few of the
notices, else its region, else one of its tags, else a fragment of its city text, else any value range. The other conditions are
checked on the joined rows. Nothing is compared with everything. Only a filter with
no condition at all meets every notice, because every notice is its result.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.arrays import overlap
from noticelake.sources.snapshots import staged

#: Cells of values, a power of two, each with about the same number of notices. A range is looked up by the largest aligned runs of cells
#: that it is made of, two of a length at most, and a notice by the run of each length that it lies in.
LEVELS = 12
CELLS = 1 << LEVELS
#: The share of cells up to which a range is looked up before a filter's region, tags or city.
SHARES = {"r": 1 / 16, "t": 1 / 16, "c": 1 / 256, "*": 1.0}


def read_filters(filters: DataFrame, params: str = "filter_params") -> DataFrame:
    """Filter rows with typed conditions out of JSON text; empty text and empty arrays are absent."""
    p = F.from_json(params, "uf string, cidade string, tags array<string>, valor_min string, valor_max string")
    f = filters.withColumn("_p", p)
    return f.select(
        "filter_id",
        "user_id",
        "label",
        "is_active",
        F.nullif(F.col("_p.uf"), F.lit("")).alias("f_region"),
        F.nullif(F.col("_p.cidade"), F.lit("")).alias("f_city"),
        F.when(F.size("_p.tags") > 0, F.col("_p.tags")).alias("f_tags"),
        F.col("_p.valor_min").try_cast("decimal(18,2)").alias("f_min"),
        F.col("_p.valor_max").try_cast("decimal(18,2)").alias("f_max"),
    )


def _splits(values: DataFrame) -> list[float]:
    """The values between the cells. They are approximate, which moves work between cells and changes no result."""
    at = F.from_json(F.lit(json.dumps([i / CELLS for i in range(1, CELLS)])), "array<double>")
    found = values.agg(F.percentile_approx(F.col("value").cast("double"), at, F.lit(4 * CELLS)).alias("v")).first()["v"]
    return [v for v in found or [] if math.isfinite(v)]


def _cell(v: Column, splits: Sequence[float]) -> Column:
    """How many of the sorted ``splits`` are not above ``v``, by halving."""
    held, x = F.from_json(F.lit(json.dumps(list(splits))), "array<double>"), v.cast("double")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(LEVELS))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(held, at + step - 1) <= x, at + step).otherwise(at))


def _run(level: int, cell: Column) -> Column:
    return F.concat(F.lit(f"v{level}:"), F.shiftright(cell, level))


def _runs(low: Column, high: Column) -> Column:
    """The aligned runs of cells that make up ``low`` to ``high``."""
    out = []
    for k in range(LEVELS + 1):
        first, end = F.shiftright(low + ((1 << k) - 1), k), F.shiftright(high + 1, k)
        for at, odd in ((first, first), (end - 1, end)):
            out.append(F.when((first < end) & (odd % 2 == 1), F.concat(F.lit(f"v{k}:"), at)))
    return F.array_compact(F.array(*out))


def _grams(c: Column) -> Column:
    """All fragments of one to three characters."""
    def of(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))

    return F.array_distinct(F.flatten(F.array(of(1), of(2), of(3))))


def _keyed_filters(f: DataFrame, cities: DataFrame, splits: Sequence[float]) -> DataFrame:
    """Every filter under the one kind of key it is looked up by; one that is looked up by its range also under another, marked n, for notices without a value."""
    kind = F.when(F.col("f_region").isNotNull(), "r").when(F.col("f_tags").isNotNull(), "t").when(F.col("f_city").isNotNull(), "c").otherwise("*")
    low = F.when(F.col("f_min").isNull(), F.lit(0)).otherwise(_cell(F.col("f_min"), splits))
    high = F.when(F.col("f_max").isNull(), F.lit(CELLS - 1)).otherwise(_cell(F.col("f_max"), splits))
    widest = F.create_map(*[F.lit(x) for name, share in SHARES.items() for x in (name, int(share * CELLS))])[F.col("kind")]
    few = (F.col("f_min").isNotNull() | F.col("f_max").isNotNull()) & (F.col("high") - F.col("low") < widest)
    f, cols = staged(f.select("*", kind.alias("kind"), low.alias("low"), high.alias("high")).withColumn("by_value", few), "conditions"), f.columns

    def under(rows: DataFrame, text: Column, tag: Column | None = None) -> DataFrame:
        mark = F.concat(F.when(F.col("by_value"), "n").otherwise(""), "kind", F.lit(":"))
        return rows.select(F.concat(mark, text).alias("key"), (F.lit(None).cast("string") if tag is None else tag).alias("tag"), *cols)

    by_region = under(f.where("kind = 'r'"), F.col("f_region"))
    by_tag = under(f.where("kind = 't'").select("*", F.explode(F.array_distinct("f_tags")).alias("one")), F.col("one"), F.col("one"))
    # Containment of the city text: a filter is looked up by that fragment of its text which the fewest cities have, so a
    # fragment that most cities share decides only for texts that have no other. One that no city has ends there.
    named = f.where("kind = 'c'")
    fragments = cities.select("city", F.explode(_grams(F.col("city"))).alias("gram"))
    shared = fragments.groupBy("gram").agg(F.count(F.lit(1)).alias("_n"))
    own = F.filter(_grams(F.col("f_city")), lambda g: F.length(g) == F.least(F.length("f_city"), F.lit(3)))
    rarest = named.select("f_city").distinct().select("f_city", F.explode(own).alias("gram")).join(shared, "gram").groupBy("f_city").agg(F.min_by("gram", F.struct("_n", "gram")).alias("gram"))
    met = fragments.join(rarest, "gram").where(F.contains("city", "f_city")).select("city", "f_city")
    by_city = under(named.join(met, "f_city"), F.col("city"))
    free = under(f.where("kind = '*'"), F.lit(""))
    by_value = f.where("by_value").select(F.explode(_runs(F.col("low"), F.col("high"))).alias("key"), F.lit(None).cast("string").alias("tag"), *cols)
    return by_region.unionByName(by_tag).unionByName(by_city).unionByName(free).unionByName(by_value)


#: What a filter asks for. Filters that ask for the same are looked up as one.
CONDITION = ("f_region", "f_city", "f_tags", "f_min", "f_max")


def members(filters: DataFrame) -> DataFrame:
    """Active filters as (condition, filter_id, user_id and the columns of ``CONDITION``); ``condition`` is a digest of these where it isn't given."""
    f = filters.where("is_active").withColumn("f_city", F.upper("f_city"))
    digest = F.col("condition") if "condition" in filters.columns else condition()
    return staged(f.select(digest.alias("condition"), "filter_id", "user_id", *CONDITION), "filters")


def condition() -> Column:
    """128 bits that stand for what a filter asks for."""
    return F.unhex(F.md5(F.to_json(F.struct(*[F.upper(c).alias(c) if c == "f_city" else c for c in CONDITION]))))


def matches(notices: DataFrame, filters: DataFrame) -> DataFrame:
    """(filter_id, user_id, notice_id) of every active filter a notice satisfies.

    ``notices``: notice_id, region, city, tags, value. ``filters``: as ``read_filters`` gives them.
    """
    every = members(filters)
    return condition_matches(notices, every).join(every.select("condition", "filter_id", "user_id"), "condition").select("filter_id", "user_id", "notice_id")


def condition_matches(notices: DataFrame, every: DataFrame, together: bool = False) -> DataFrame:
    """(condition, notice_id) of every distinct condition among ``members`` that a notice satisfies.

    Notices are read once: each is put under all keys it can be looked up by and joined once. ``together`` leaves what is found about
    a notice in one task, so that a grouping by notice that follows needs no shuffle of the hits.
    """
    n = staged(notices.select("notice_id", "region", F.upper(F.coalesce("city", F.lit(""))).alias("city"), "tags", "value"), "notices")
    f = every.select("condition", *CONDITION).dropDuplicates(["condition"])
    splits = [] if f.where("f_min is not null or f_max is not null").isEmpty() else _splits(n.select("value"))
    keyed = staged(_keyed_filters(f, n.select("city").distinct(), splits), "keyed-filters")
    # Notices stand only under the kinds of keys that some filter is looked up by: a handful, and one for each length of runs.
    kinds = {r["kind"] for r in keyed.select(F.substring_index("key", ":", 1).alias("kind")).distinct().collect()}

    n = by_notice(n) if together else n
    n = n.withColumn("cell", F.when(F.col("value").isNotNull(), _cell(F.col("value"), splits)))
    none = F.col("value").isNull()
    parts = {"r": F.col("region"), "c": F.col("city"), "*": F.lit("")}
    own = [F.concat(F.lit(f"{k}:"), c) for k, c in parts.items() if k in kinds] + [F.when(none, F.concat(F.lit(f"n{k}:"), c)) for k, c in parts.items() if f"n{k}" in kinds]
    own += [_run(k, F.col("cell")) for k in range(LEVELS + 1) if f"v{k}" in kinds]
    keys, nothing = F.array(*own).cast("array<string>"), F.array().cast("array<string>")
    for mark, asked in (("t", F.lit(True)), ("nt", none)):
        if mark in kinds:
            head = F.lit(f"{mark}:")
            tagged = F.transform(F.array_distinct("tags"), lambda t: F.concat(head, t))  # noqa: B023
            keys = F.concat(keys, F.when(asked, F.coalesce(tagged, nothing)).otherwise(nothing))
    spread = n.withColumn("key", F.explode(F.array_compact(keys))).drop("cell")

    # A notice and a filter may share several tags; the pair is kept at the first shared one only.
    shared = F.try_element_at(F.array_intersect("f_tags", "tags"), F.lit(1))
    region_ok = F.col("f_region").isNull() | (F.col("region") == F.col("f_region"))
    tags_ok = F.col("f_tags").isNull() | overlap(F.col("tags"), F.col("f_tags"))
    city_ok = F.col("f_city").isNull() | F.contains("city", "f_city")
    value_ok = F.col("value").isNull() | (
        (F.col("f_max").isNull() | (F.col("value") <= F.col("f_max"))) & (F.col("f_min").isNull() | (F.col("value") >= F.col("f_min")))
    )
    once = F.col("tag").isNull() | (F.col("tag") == shared)
    hits = spread.join(keyed.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key")).where(value_ok & region_ok & city_ok & tags_ok & once)
    return hits.select("condition", "notice_id")


def by_notice(rows: DataFrame) -> DataFrame:
    """Rows of a notice in one task. The number of tasks is fixed: what is found grows by the filters, of which the bytes of these rows say nothing."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "notice_id")


def profiles(held: DataFrame, shared: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Users as one where their filters, in the order of their ids, have the same ``shared`` columns.

    Gives (profile, user_id, ids) and, for every distinct profile, (profile, place, and the columns ``shared``); ``ids`` are filter ids by place.
    """
    own = F.array_sort(F.collect_list(F.struct("filter_id", *shared)))
    asks = F.transform("own", lambda x: F.struct(*[x[c].alias(c) for c in shared]))
    listed = held.groupBy("user_id").agg(own.alias("own")).select("user_id", F.col("own.filter_id").alias("ids"), asks.alias("asks"))
    users = staged(listed.withColumn("profile", F.unhex(F.md5(F.to_json("asks")))), "profiles")
    asked = users.select("profile", "asks").dropDuplicates(["profile"]).select("profile", F.posexplode("asks").alias("place", "ask")).select("profile", "place", "ask.*")
    return users.select("profile", "user_id", "ids"), staged(asked, "asked")


def notifications(notices: DataFrame, filters: DataFrame) -> DataFrame:
    """One notification per user and notice, for the lowest matching filter id.

    Filters that a lower filter of the same user covers are left out before they meet any notice. Users whose filters ask for the same in the
    same order are one profile: the first condition of a profile that a notice meets is found once, and its users come last.
    """
    every = members(uncovered(filters))
    users, asked = profiles(every, ["condition"])
    first = condition_matches(notices, every, together=True).join(asked, "condition").groupBy("profile", "notice_id").agg(F.min("place").alias("place"))
    return first.join(users, "profile").select("user_id", "notice_id", F.get("ids", F.col("place")).alias("filter_id"))


def uncovered(filters: DataFrame) -> DataFrame:
    """Active filters without those whose every match a lower filter id of the same user matches too.

    A filter covers another with the same region, city and tags, or none of these where it has none, and
    a value range that holds the other's. Compared are the distinct conditions of one user.
    """
    f = filters.where("is_active")
    tags = F.sort_array(F.array_distinct("f_tags"))
    own = [F.col("f_region"), F.upper("f_city"), tags, F.col("f_min"), F.col("f_max")]
    first = f.groupBy("user_id", *[c.alias(f"k{i}") for i, c in enumerate(own)]).agg(F.min("filter_id").alias("filter_id"))
    a, b = first.alias("a"), first.alias("b")

    def wider(k: str) -> Column:
        return F.col(f"a.{k}").isNull() | F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))

    low = F.col("a.k3").isNull() | (F.col("a.k3") <= F.col("b.k3"))
    high = F.col("a.k4").isNull() | (F.col("a.k4") >= F.col("b.k4"))
    cover = (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.filter_id") < F.col("b.filter_id")) & wider("k0") & wider("k1") & wider("k2") & low & high
    kept = b.join(a, cover, "left_anti").select("filter_id")
    return f.join(kept, "filter_id", "left_semi")


def new_notifications(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Notifications not stored yet; a replay of the same notices gives none."""
    return found.join(stored.select("user_id", "notice_id"), ["user_id", "notice_id"], "left_anti")


def unread(notifications: DataFrame, reads: DataFrame, user: str | None = None) -> DataFrame:
    """Notifications without a read mark. ``reads`` is append-only: (user_id, notification_id); a NULL
    notification id together with read_at marks everything of the user up to that time."""
    n = notifications.where(F.col("user_id") == user) if user is not None else notifications
    single = reads.where(F.col("notification_id").isNotNull()).select("user_id", "notification_id").distinct()
    n = n.join(single, ["user_id", "notification_id"], "left_anti")
    everything = reads.where(F.col("notification_id").isNull()).groupBy("user_id").agg(F.max("read_at").alias("_upto"))
    return n.join(everything, "user_id", "left").where(F.col("_upto").isNull() | (F.col("created_at") > F.col("_upto"))).drop("_upto")


def unread_list(unread_rows: DataFrame, notices: DataFrame, filters: DataFrame, limit: int = 10) -> DataFrame:
    """Newest unread notifications with notice columns and the filter label."""
    newest = unread_rows.orderBy(F.desc("created_at"), "notification_id").limit(limit)
    return newest.join(notices, "notice_id").join(filters.select("filter_id", F.col("label").alias("filter_label")), "filter_id", "left")


def unread_count(unread_rows: DataFrame) -> DataFrame:
    return unread_rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("unread"))


__all__ = [
    "by_notice", "condition", "condition_matches", "matches", "members", "new_notifications", "notifications", "profiles", "read_filters", "uncovered", "unread", "unread_count", "unread_list",
]
