"""Freshness, load and run history, alerts, dashboard. ``as_of`` stands for now everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import boundary_diff
from snapmart.operators.marts import with_distincts

SECONDS, MINUTES = "second", "minute"


def freshness_of(
    df: DataFrame, name: str, column: str, as_of: Column, warn: int, stale: int,
    mark_empty: bool = False,
) -> DataFrame:
    """Rows, newest load and its age in minute boundaries.

    An empty table has no age and counts as FRESH unless ``mark_empty``.
    """
    age = F.col("minutes_since_last_load")
    status = F.when(age > stale, "STALE").when(age > warn, "WARNING")
    if mark_empty:
        status = status.when(age.isNull(), "EMPTY")
    return (
        df.agg(F.count("*").alias("total_records"), F.max(column).alias("last_load_time"))
        .withColumn(
            "minutes_since_last_load", boundary_diff(MINUTES, F.col("last_load_time"), as_of)
        )
        .select(
            F.lit(name).alias("table_name"),
            "*",
            status.otherwise("FRESH").alias("freshness_status"),
        )
    )


def freshness(
    raw: DataFrame, staging: DataFrame, mart: DataFrame, as_of: Column, mark_empty: bool = False
) -> DataFrame:
    """One row per layer: 30 and 60 minutes for tables, 60 and 120 for the mart."""
    return (
        freshness_of(raw, "raw", "_loaded_at", as_of, 30, 60, mark_empty)
        .unionByName(freshness_of(staging, "staging", "_loaded_at", as_of, 30, 60, mark_empty))
        .unionByName(freshness_of(mart, "mart", "_updated_at", as_of, 60, 120, mark_empty))
    )


def alert_stale(fresh: DataFrame) -> DataFrame:
    return fresh.filter("freshness_status = 'STALE'").select(
        F.lit("stale_data").alias("alert"), "table_name", "minutes_since_last_load"
    )


def _since(as_of: Column, **back: int) -> Column:
    return as_of - F.make_dt_interval(**{k: F.lit(v) for k, v in back.items()})


def run_history(runs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Runs of the last days with their duration in second boundaries, newest first.

    ``runs`` has run_id, stage, state, scheduled_time, completed_time, error_code.
    """
    took = boundary_diff(SECONDS, F.col("scheduled_time"), F.col("completed_time"))
    return (
        runs.filter(F.col("scheduled_time") >= _since(as_of, days=days))
        .withColumn("duration_seconds", took)
        .orderBy(F.col("scheduled_time").desc(), "run_id")
    )


def alert_failures(runs: DataFrame, as_of: Column, minutes: int = 10) -> DataFrame:
    """One row if any run of the last minutes failed, with how many did."""
    recent = F.col("scheduled_time") >= _since(as_of, mins=minutes)
    return (
        runs.filter(recent & F.col("error_code").isNotNull())
        .agg(F.count("*").alias("failures"))
        .filter("failures > 0")
        .select(F.lit("run_failure").alias("alert"), "failures")
    )


def alert_rules(
    runs: DataFrame, checks: DataFrame, quarantine: DataFrame,
    max_seconds: int = 600, max_error_rate: float = 0.05,
) -> DataFrame:
    """Alerts that hold: long runs, error rate, quarantined rows, failed checks.

    ``runs`` as for ``run_history``, ``checks`` as from ``run_checks``.
    """
    took = boundary_diff(SECONDS, F.col("scheduled_time"), F.col("completed_time"))
    per_run = runs.agg(
        F.count_if(took > max_seconds).cast("double").alias("long_run"),
        F.coalesce(
            F.try_divide(
                F.count_if(F.col("error_code").isNotNull()).cast("double"),
                F.count("*").cast("double"),
            ),
            F.lit(0.0),
        ).alias("error_rate"),
    )
    limits = {
        "long_run": (0.0, "WARNING"),
        "error_rate": (max_error_rate, "CRITICAL"),
        "quarantine_depth": (0.0, "INVESTIGATE"),
        "failed_checks": (0.0, "BLOCK"),
    }

    def rows(frame: DataFrame, *names: str) -> DataFrame:
        cells = [
            F.struct(
                F.lit(n).alias("alert"),
                F.col(n).alias("value"),
                F.lit(limits[n][0]).alias("threshold"),
                F.lit(limits[n][1]).alias("severity"),
            )
            for n in names
        ]
        return frame.select(F.inline(F.array(*cells)))

    depth = quarantine.agg(F.count("*").cast("double").alias("quarantine_depth"))
    failed = checks.agg(F.count_if(F.col("status") == "FAIL").cast("double").alias("failed_checks"))
    return (
        rows(per_run, "long_run", "error_rate")
        .unionByName(rows(depth, "quarantine_depth"))
        .unionByName(rows(failed, "failed_checks"))
        .filter("value > threshold")
    )


def file_load_history(
    raw: DataFrame, quarantine: DataFrame, as_of: Column, days: int = 7
) -> DataFrame:
    """Per file of the last days: rows parsed, loaded and failed, first error, seconds of load.

    ``quarantine`` has _source_file, _loaded_at and reason. Both sides are reduced to one row
    per file and reason before they meet.
    """
    since = _since(as_of, days=days)
    good = raw.filter(F.col("_loaded_at") >= since).groupBy("_source_file").agg(
        F.count("*").alias("row_count"),
        F.min("_loaded_at").alias("first_at"),
        F.max("_loaded_at").alias("last_at"),
    )
    bad = quarantine.filter(F.col("_loaded_at") >= since).groupBy("_source_file").agg(
        F.count("*").alias("error_count"),
        F.min("reason").alias("first_error_message"),
        F.min("_loaded_at").alias("first_at"),
        F.max("_loaded_at").alias("last_at"),
    )
    both = good.unionByName(bad, allowMissingColumns=True).groupBy("_source_file").agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("error_count"), F.lit(0)).alias("error_count"),
        F.min("first_error_message").alias("first_error_message"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_load_time"),
    )
    loaded, errors = F.col("row_count"), F.col("error_count")
    status = F.when(errors == 0, "LOADED").when(loaded == 0, "LOAD_FAILED")
    return both.select(
        F.col("_source_file").alias("file_name"),
        (loaded + errors).alias("row_parsed"),
        "row_count",
        "error_count",
        "first_error_message",
        status.otherwise("PARTIALLY_LOADED").alias("status"),
        "last_load_time",
        boundary_diff(SECONDS, F.col("first_at"), F.col("last_load_time")).alias(
            "load_duration_seconds"
        ),
    ).orderBy(F.col("last_load_time").desc(), "file_name")


def dashboard(
    staging: DataFrame, raw: DataFrame, mart: DataFrame, metrics: DataFrame, runs: DataFrame,
    as_of: Column,
) -> DataFrame:
    """Eleven figures in one row, from one aggregate per table and one per distinct count.

    The one-row aggregates are put together by a union and a maximum, not by a cross join.
    """
    day = _since(as_of, days=1)
    recent_check = F.col("check_timestamp") >= day
    recent_run = F.col("scheduled_time") >= day
    parts = [
        with_distincts(
            staging, [],
            {"unique_countries": F.col("country_code"), "unique_years": F.col("year"),
             "unique_record_types": F.col("record_type")},
            [F.count("*").alias("total_staging_records"),
             F.max("_loaded_at").alias("last_staging_load")],
        ),
        raw.agg(F.max("_loaded_at").alias("last_raw_load")),
        mart.agg(F.max("_updated_at").alias("last_mart_update")),
        metrics.agg(
            F.count_if(recent_check & (F.col("status") == "FAIL")).alias("quality_failures_24h"),
            F.count_if(recent_check & (F.col("status") == "WARNING")).alias(
                "quality_warnings_24h"
            ),
        ),
        runs.agg(
            F.count_if(recent_run & F.col("error_code").isNotNull()).alias("task_failures_24h"),
            F.count_if(recent_run & (F.col("state") == "SUCCEEDED")).alias("task_successes_24h"),
        ),
    ]
    return one_row(parts)


def one_row(parts: list[DataFrame]) -> DataFrame:
    """Columns of several one-row frames side by side."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def status_counts(log: DataFrame) -> DataFrame:
    """Runs per stage and status, with the rows they handled."""
    return log.groupBy("stage", "status").agg(
        F.count("*").alias("runs"), F.sum("records_processed").alias("records")
    )


def runs_from_log(log: DataFrame) -> DataFrame:
    """The run log in the shape the history and alerts read."""
    back = F.make_dt_interval(secs=F.coalesce(F.col("execution_time_ms"), F.lit(0)) / 1000)
    return log.select(
        "run_id",
        "stage",
        F.when(F.col("status") == "FAILED", "FAILED").otherwise("SUCCEEDED").alias("state"),
        (F.col("log_timestamp") - back.cast("interval day to second")).alias("scheduled_time"),
        F.col("log_timestamp").alias("completed_time"),
        F.when(F.col("status") == "FAILED", F.coalesce("error_message", F.lit("error"))).alias(
            "error_code"
        ),
    )


