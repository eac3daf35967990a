"""Audit once: which notices are still to be read, who is reading them, and what came of it.

The log only grows. A run leases the notices that are due and later logs an outcome for each; a lease that runs out without one is an
attempt that failed. Leases and outcomes are keyed by notice and attempt, so of two runs only one gets an attempt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.sources.keyed_table import KeyedTable

#: Outcomes; all but the error are final.
OUTCOMES = ("found", "no_link", "error", "skipped")
ATTEMPTS, LEASE_MINUTES = 2, 30
LOG = "notice_id bigint, attempt int, kind string, run_id string, at timestamp, until timestamp, result string"


def audit_state(log: DataFrame, as_of, attempts: int = ATTEMPTS) -> DataFrame:
    """(notice_id, attempts, errors, result, audited_at, audit_run_id, is_open) of every notice in the log.

    ``result`` is the last outcome; a lease that is running has none yet, one that ran out counts as an error. Open are notices whose last attempt
    failed while attempts are left. Notices fold by partial aggregation: a notice of many rows is one row a task.
    """
    now = F.lit(as_of).cast("timestamp")
    lease, outcome = F.col("kind") == "lease", F.col("kind") == "outcome"
    folded = log.groupBy("notice_id", "attempt").agg(
        F.max(F.when(lease, F.col("until"))).alias("until"), F.min_by("result", F.when(outcome, F.struct("at", "run_id"))).alias("own"),
        F.min(F.when(outcome, F.col("at"))).alias("done_at"), F.max(F.when(lease, F.col("run_id"))).alias("run_id"),
    )
    result = F.coalesce("own", F.when(F.col("until") <= now, F.lit("error")))
    each = folded.withColumn("result", result).withColumn("at", F.coalesce("done_at", "until"))
    last = F.struct("attempt", "result", "at", "run_id")
    state = each.groupBy("notice_id").agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("result") == "error").alias("errors"), F.max_by(last, F.col("attempt")).alias("last"))
    return state.select(
        "notice_id", "attempts", "errors", F.col("last.result").alias("result"), F.when(F.col("last.result").isNotNull(), F.col("last.at")).alias("audited_at"),
        F.col("last.run_id").alias("audit_run_id"), F.coalesce((F.col("last.result") == "error") & (F.col("attempts") < attempts), F.lit(False)).alias("is_open"),
    )


def due(notices: DataFrame, log: DataFrame | None, as_of, attempts: int = ATTEMPTS) -> DataFrame:
    """Notices to read now with the number of their attempt: never tried, or failed with attempts left. A notice with another outcome is not read again."""
    if log is None:
        return notices.withColumn("attempt", F.lit(1))
    state = audit_state(log, as_of, attempts).select(F.col("notice_id").alias("_id"), "attempts", "is_open")
    met = notices.join(state, F.col("notice_id") == F.col("_id"), "left")
    return met.where(F.col("_id").isNull() | F.col("is_open")).withColumn("attempt", (F.coalesce("attempts", F.lit(0)) + 1).cast("int")).drop("_id", "attempts", "is_open")


class AuditLog:
    """The log as a keyed table."""

    def __init__(self, table: KeyedTable, attempts: int = ATTEMPTS, minutes: int = LEASE_MINUTES):
        if table.keys != ["notice_id", "attempt", "kind"]:
            raise ValueError("the log is keyed by notice_id, attempt and kind")
        self.table, self.attempts, self.minutes = table, attempts, minutes

    def lease(self, notices: DataFrame, run_id: str, as_of) -> DataFrame:
        """Takes the notices that are due for this run and returns their leases (notice_id, attempt, …)."""
        at = F.lit(as_of).cast("timestamp")
        rows = due(notices.select("notice_id").distinct(), self.table.rows(), as_of, self.attempts)
        rows = rows.select(
            F.col("notice_id").cast("bigint").alias("notice_id"), "attempt", F.lit("lease").alias("kind"), F.lit(run_id).alias("run_id"), at.alias("at"),
            (at + F.make_dt_interval(mins=F.lit(self.minutes))).alias("until"), F.lit(None).cast("string").alias("result"),
        )
        return self.table.append_new(rows, [F.col("run_id")])

    def finish(self, outcomes: DataFrame, run_id: str, as_of) -> None:
        """Logs ``outcomes`` (notice_id, attempt, result); an outcome that is logged again, or by another run, changes nothing."""
        rows = outcomes.where(F.col("result").isin(*OUTCOMES)).select(
            F.col("notice_id").cast("bigint").alias("notice_id"), F.col("attempt").cast("int").alias("attempt"), F.lit("outcome").alias("kind"), F.lit(run_id).alias("run_id"),
            F.lit(as_of).cast("timestamp").alias("at"), F.lit(None).cast("timestamp").alias("until"), "result",
        )
        self.table.append_new(rows, [F.col("result")])
