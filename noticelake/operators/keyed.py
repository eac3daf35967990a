"""Keyed tables: keep one row per key, merge batches, skip known keys.

Every operator aggregates or limits on the map side first, so a key that holds a
large share of all rows is one row per task by the time it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    ``row_number() = 1`` is planned with a per-task limit before the shuffle.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def keep_latest(df: DataFrame, keys: Sequence[str], time: str, tie: str) -> DataFrame:
    return keep_first(df, keys, [F.col(time).desc_nulls_last(), F.col(tie).desc_nulls_last()])


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows seen, distinct keys, duplicates and their percentage."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("analysed"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )
    from noticelake.functions.money import percent

    return total.withColumn("dedup_rate", percent(F.col("duplicates"), F.col("analysed")))


def run_rates(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """``duplicate_counts`` with the distinct keys that have a date anywhere, and their percentage."""
    from noticelake.functions.money import percent

    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col(date).isNotNull()).alias("dated"))
    total = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("analysed"), F.count(F.lit(1)).alias("distinct_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"), F.count_if("dated").alias("dates_found")
    )
    return total.withColumn("dedup_rate", percent(F.col("duplicates"), F.col("analysed"))).withColumn("date_rate", percent(F.col("dates_found"), F.col("distinct_keys")))


def _ranked(current: DataFrame, incoming: DataFrame, order: str | None) -> DataFrame:
    """Both sides under one schema with a rank that puts the incoming rows last."""
    def tag(df: DataFrame, rank: int) -> DataFrame:
        within = F.col(order) if order and order in df.columns else F.lit(None)
        return df.withColumn("_rank", F.struct(F.lit(rank).alias("side"), within.cast("string").alias("at")))

    return tag(current, 0).unionByName(tag(incoming, 1), allowMissingColumns=True)


def upsert_non_null(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Merge where only non-null incoming values overwrite; ``keep`` columns never change once set.

    One aggregation on the key: for every column the value of the latest row that has one.
    """
    both = _ranked(current, incoming, order)
    cols = [c for c in both.columns if c not in (*keys, "_rank")]
    present = {c: F.when(F.col(c).isNotNull(), F.col("_rank")) for c in cols}
    aggs = [(F.min_by if c in keep else F.max_by)(F.col(c), present[c]).alias(c) for c in cols]
    order_out = [*keys, *cols]
    return both.groupBy(*keys).agg(*aggs).select(*order_out)


def upsert_replace(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Merge where the incoming row replaces all columns except ``keep`` (for example created_at)."""
    both = _ranked(current, incoming, order)
    cols = [c for c in both.columns if c not in (*keys, "_rank")]
    kept = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(f"_keep_{c}") for c in keep]
    out = both.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("_rank")).alias("_row"), *kept)
    return out.select(
        *keys, *[F.coalesce(F.col(f"_keep_{c}"), F.col(f"_row.{c}")).alias(c) if c in keep else F.col(f"_row.{c}").alias(c) for c in cols]
    )


def new_rows(incoming: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not known yet."""
    return incoming.join(known.select(*keys).distinct(), list(keys), "left_anti")


def known_rows(incoming: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return incoming.join(known.select(*keys).distinct(), list(keys), "left_semi")


def insert_if_absent(current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows to append: first of each new key. Running it again on the result adds nothing."""
    return keep_first(new_rows(incoming, current, keys), keys, order)


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """``NOT IN`` with SQL meaning: empty when the list holds a NULL, NULL rows never qualify.

    Written as an anti join on the non-null values plus one flag, so it stays a hash join.
    """
    values = other.select(F.col(other_column).alias(column))
    has_null = values.where(F.col(column).isNull()).limit(1)
    kept = df.where(F.col(column).isNotNull()).join(values.where(F.col(column).isNotNull()).distinct(), column, "left_anti")
    return kept.where(~has_null.exists())


def rewrite_ids(df: DataFrame, mapping: DataFrame, column: str, old: str = "old_id", new: str = "new_id") -> DataFrame:
    """Ids replaced by the mapping; unmapped ids stay."""
    m = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = df.join(m, F.col(column) == F.col("_old"), "left")
    return joined.withColumn(column, F.coalesce("_new", column)).drop("_old", "_new").select(*df.columns)


def current_state(transitions: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """State after the latest transition of every key."""
    return keep_latest(transitions, [key], time, tie)
