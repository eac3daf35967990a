"""Health, alerts and service levels of pipeline runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticelake.functions.dates import age_class, duration_seconds
from noticelake.functions.money import percent
from noticelake.operators.paging import severity_order, top_k_per
from noticelake.presets import br_notices as br


def run_health(runs: DataFrame, as_of) -> DataFrame:
    """Adds the running duration, a health class and a checked status.

    Runs: run_id, started_at, ended_at, status, quarantine_percent.
    """
    stale_before = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {br.STALE_HOURS} HOURS")
    return runs.select(
        "*",
        duration_seconds(F.col("started_at"), F.col("ended_at"), as_of).alias("duration_seconds"),
        F.when(F.col("quarantine_percent") > br.QUARANTINE_CRITICAL, F.lit("critical"))
        .when(F.col("quarantine_percent") > br.QUARANTINE_WARNING, F.lit("warning"))
        .otherwise(F.lit("healthy"))
        .alias("health_status"),
        F.when(F.col("status") == "FAILED", F.lit("error"))
        .when((F.col("status") == "RUNNING") & (F.col("started_at") < stale_before), F.lit("stale"))
        .otherwise(F.col("status"))
        .alias("status_check"),
    )


def _alert(cond: Column, kind: str, severity: str, title: Column) -> Column:
    return F.when(
        F.coalesce(cond, F.lit(False)),
        F.struct(F.lit(kind).alias("kind"), F.lit(severity).alias("severity"), title.alias("title")),
    )


def idle_runs(runs: DataFrame, group: str, n: int = br.IDLE_RUNS, slice_by: str = "day") -> DataFrame:
    """Runs that are at least the n-th in a row without new rows, per pipeline (``group``).

    The window runs per pipeline and time slice, so the history of one pipeline is spread over many
    tasks. The n-1 runs before a slice are brought to it: they are among the last n-1 runs of earlier slices.
    """
    order = ["started_at", "run_id"]
    r = runs.withColumn("_slice", F.date_trunc(slice_by, "started_at"))
    tails = top_k_per(r.select(group, "_slice", *order, "new_rows"), [group, "_slice"], [F.desc("started_at"), F.desc("run_id")], n - 1, "_k")
    tails = tails.drop("_k").withColumn("_seq", F.row_number().over(W.partitionBy(group).orderBy(*order)))
    wanted = tails.groupBy(group, "_slice").agg(F.min("_seq").alias("_first"))
    back = F.explode(F.sequence(F.lit(1), F.lit(n - 1)))
    wanted = wanted.withColumn("_back", back).select(group, "_slice", (F.col("_first") - F.col("_back")).alias("_seq"))
    before = wanted.join(tails.drop("_slice"), [group, "_seq"]).drop("_seq").withColumn("_own", F.lit(False))
    every = r.withColumn("_own", F.lit(True)).unionByName(before, allowMissingColumns=True)
    w = W.partitionBy(group, "_slice").orderBy(*order).rowsBetween(-(n - 1), 0)
    seen = every.withColumn("_new", F.sum("new_rows").over(w)).withColumn("_runs", F.count(F.lit(1)).over(w))
    return seen.where(F.col("_own") & (F.col("_new") == 0) & (F.col("_runs") == n)).select(*runs.columns)


def pipeline_alerts(runs: DataFrame) -> DataFrame:
    """One row per broken rule and run, before the idle rule.

    Runs: run_id, status, processed, valid, quarantine_percent, duration_s, downloads_ok, downloads_failed.
    """
    q, processed = F.col("quarantine_percent"), F.col("processed")
    shown = F.format_string("%.1f", q.cast("double"))
    minutes = F.format_string("%.1f", F.col("duration_s").cast("double") / 60)
    rules = F.array(
        _alert(F.col("status") == "FAILED", "execution_failed", "critical", F.lit("Execucao do pipeline falhou")),
        _alert((processed > 0) & (q > br.QUARANTINE_CRITICAL), "high_quarantine_rate", "critical", F.concat(F.lit("Taxa de quarentena critica: "), shown, F.lit("%"))),
        _alert((processed > 0) & (q > br.QUARANTINE_WARNING) & (q <= br.QUARANTINE_CRITICAL), "high_quarantine_rate", "warning", F.concat(F.lit("Taxa de quarentena elevada: "), shown, F.lit("%"))),
        _alert((processed > 0) & (F.col("valid") == 0), "no_valid_records", "warning", F.lit("Nenhum registro valido na execucao")),
        _alert(F.col("duration_s") > br.LONG_RUN_SECONDS, "long_duration", "warning", F.concat(F.lit("Execucao muito longa: "), minutes, F.lit(" minutos"))),
        _alert(F.col("downloads_failed") > F.col("downloads_ok"), "download_failures", "warning", F.lit("Mais downloads com falha do que com sucesso")),
    )
    return runs.select("run_id", F.explode(F.array_compact(rules)).alias("a")).select("run_id", "a.*")


def all_alerts(runs: DataFrame, group: str) -> DataFrame:
    idle = idle_runs(runs, group).select(
        "run_id", F.lit("no_new_rows").alias("kind"), F.lit("warning").alias("severity"), F.lit("Sem novos registros").alias("title")
    )
    return pipeline_alerts(runs).unionByName(idle)


def open_alerts(alerts: DataFrame, as_of) -> DataFrame:
    """Open alerts by severity then age, with an age class."""
    live = alerts.where(F.col("status") == "open").withColumn("age", age_class(F.col("created_at"), as_of))
    return live.orderBy(*severity_order("severity", "created_at", "alert_id"))


def open_by_severity(alerts: DataFrame) -> DataFrame:
    live = alerts.where(F.col("status") == "open")
    return live.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("severity") == s).alias(s) for s in ("critical", "warning", "info")],
    )


def daily_metrics(runs: DataFrame) -> DataFrame:
    """Runs, new rows, mean duration and success percentage per day."""
    return runs.groupBy(F.to_date("started_at").alias("day")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("new_rows").alias("new_rows"),
        F.round(F.avg(F.col("duration_s").cast("decimal(18,4)")), 0).cast("bigint").alias("mean_duration"),
        percent(F.count_if(F.col("status") == "SUCCESS"), F.count(F.lit(1))).alias("success_percent"),
    )


def last_runs_summary(runs: DataFrame, n: int = 30) -> DataFrame:
    """Sums and mean rate over the newest n runs."""
    newest = runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)
    return newest.agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("processed").alias("processed"),
        F.sum("valid").alias("valid"),
        F.round(F.avg(F.col("quarantine_percent").cast("decimal(18,4)")), 2).alias("mean_quarantine_percent"),
    )


def last_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1)


def service_levels(runs: DataFrame, rows: DataFrame, as_of) -> DataFrame:
    """(sli, measured, target, met) for success, largest and mean freshness of the rows stored from the day of ``as_of`` on, integrity and downloads.

    Runs: started_at, run_id, status, new_rows, discarded, downloads_ok, downloads_failed.
    Rows: created_at, published_at.
    """
    now = F.lit(as_of).cast("timestamp")
    in_week = runs.where(F.col("started_at") >= now - F.expr("INTERVAL 7 DAYS"))
    in_month = runs.where(F.col("started_at") >= now - F.expr("INTERVAL 30 DAYS"))
    success = in_week.agg(percent(F.count_if(F.col("status") == "SUCCESS"), F.count(F.lit(1)), 2).alias("measured"))
    hours = (F.unix_timestamp("created_at") - F.unix_timestamp("published_at")).cast("decimal(18,4)") / 3600
    today = rows.where(F.col("created_at") >= F.date_trunc("day", now))
    fresh, mean_fresh = (today.agg(F.round(f(hours), 2).alias("measured")) for f in (F.max, F.avg))
    integrity = last_run(runs).agg(percent(F.sum("new_rows"), F.sum(F.col("new_rows") + F.col("discarded")), 2).alias("measured"))
    downloads = in_month.agg(percent(F.sum("downloads_ok"), F.sum(F.col("downloads_ok") + F.col("downloads_failed")), 2).alias("measured"))

    def row(df: DataFrame, name: str, target: int, lower_is_better: bool = False) -> DataFrame:
        m = F.col("measured").cast("decimal(20,2)")
        met = (m <= target) if lower_is_better else (m >= target)
        return df.select(F.lit(name).alias("sli"), m.alias("measured"), F.lit(target).alias("target"), met.alias("met"))

    return (
        row(success, "success_percent_7d", br.SLO_SUCCESS)
        .unionByName(row(fresh, "freshness_max_hours", br.SLO_FRESH_HOURS, True))
        .unionByName(row(mean_fresh, "freshness_mean_hours", br.SLO_FRESH_HOURS, True))
        .unionByName(row(integrity, "integrity_percent_last_run", br.SLO_INTEGRITY))
        .unionByName(row(downloads, "download_percent_30d", br.SLO_DOWNLOAD))
    )


def fetch_statistics(checks: DataFrame, group: str) -> DataFrame:
    """Requests, successes, success percentage and mean response of successes per group."""
    ok = F.col("ok")
    return checks.groupBy(group).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(ok).alias("succeeded"),
        percent(F.count_if(ok), F.count(F.lit(1))).alias("success_percent"),
        F.round(F.avg(F.when(ok, F.col("response_ms").cast("decimal(18,4)"))), 2).alias("mean_response_ms"),
    )
