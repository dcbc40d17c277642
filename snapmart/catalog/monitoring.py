"""Freshness, load history, run history, alerts, dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.catalog import inputs as I
from snapmart.catalog.cleaning import rules
from snapmart.catalog.registry import AS_OF, query, sql
from snapmart.operators import clean
from snapmart.plans import monitor
from snapmart.quality import checks as Q
from snapmart.quality import postload as post

NOW = "2024-01-31 00:20:00"
SEEN_BY_STAGING = "2024-01-30 23:40:00"
SEEN_BY_MART = "2024-01-30 22:00:00"


def _layers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staging lags the landing table, the mart lags staging."""
    raw = I.facts(spark, sf)
    staging = I.staging(spark, sf).filter(F.col("_loaded_at") < SEEN_BY_STAGING)
    mart = (
        raw.filter(F.col("_loaded_at") < SEEN_BY_MART)
        .groupBy("country_code", "year")
        .agg(F.max("_loaded_at").alias("_updated_at"))
    )
    return raw, staging, mart


def _probe(name: str, source: str, column: str, warn: int, stale: int) -> str:
    return f"""SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS total_records,
      max({column}) AS last_load_time,
      date_diff('minute', max({column}), TIMESTAMP '{NOW}') AS minutes_since_last_load,
      CASE WHEN date_diff('minute', max({column}), TIMESTAMP '{NOW}') > {stale} THEN 'STALE'
        WHEN date_diff('minute', max({column}), TIMESTAMP '{NOW}') > {warn} THEN 'WARNING'
        ELSE 'FRESH' END AS freshness_status FROM {source} AS {name}_rows"""


_MART = f"""(SELECT country_code, year, max(_loaded_at) AS _updated_at FROM fp
  WHERE _loaded_at < TIMESTAMP '{SEEN_BY_MART}' GROUP BY country_code, year)"""
_STAGING = f"(SELECT * FROM stg WHERE _loaded_at < TIMESTAMP '{SEEN_BY_STAGING}')"
FRESHNESS = " UNION ALL ".join(
    [
        _probe("raw", "fp", "_loaded_at", 30, 60),
        _probe("staging", _STAGING, "_loaded_at", 30, 60),
        _probe("mart", _MART, "_updated_at", 60, 120),
    ]
)


@query("freshness", sql(FRESHNESS, "stg"))
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.freshness(*_layers(spark, sf), I.as_of(NOW))


@query(
    "alert_stale",
    sql(
        f"""SELECT 'stale_data' AS alert, table_name, minutes_since_last_load
        FROM ({FRESHNESS}) AS f WHERE freshness_status = 'STALE'""",
        "stg",
    ),
)
def alert_stale(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.alert_stale(freshness(spark, sf))


@query(
    "run_history",
    sql(
        f"""SELECT *, date_diff('second', scheduled_time, completed_time) AS duration_seconds
        FROM runs WHERE scheduled_time >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""",
        "runs",
    ),
)
def run_history(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.run_history(I.runs(spark, sf), I.as_of())


@query(
    "alert_failures",
    sql(
        f"""SELECT * FROM (SELECT 'run_failure' AS alert, CAST(count(*) AS BIGINT) AS failures
        FROM runs WHERE error_code IS NOT NULL
          AND scheduled_time >= TIMESTAMP '{AS_OF}' - INTERVAL 90 MINUTE) AS x WHERE failures > 0""",
        "runs",
    ),
)
def alert_failures(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.alert_failures(I.runs(spark, sf), I.as_of(), minutes=90)


def _quarantine(spark: SparkSession, sf: str) -> DataFrame:
    bad = clean.quarantine_split(I.facts(spark, sf), rules())[1]
    return bad.select("_source_file", "_loaded_at", F.array_join("_reasons", ", ").alias("reason"))


_BAD = """(country_code = 0 OR carbon = 0 OR value < 1)"""
_REASON = """concat_ws(', ', CASE WHEN country_code = 0 THEN 'no country' END,
  CASE WHEN carbon = 0 THEN 'no carbon' END, CASE WHEN value < 1 THEN 'small value' END)"""


@query(
    "alert_rules",
    sql(
        f"""SELECT * FROM (
        SELECT 'long_run' AS alert, CAST(count(*) FILTER (WHERE date_diff('second',
          scheduled_time, completed_time) > 600) AS DOUBLE) AS value, 0::DOUBLE AS threshold,
          'WARNING' AS severity FROM runs
        UNION ALL SELECT 'error_rate', CAST(count(error_code) AS DOUBLE) / count(*), 0.05::DOUBLE,
          'CRITICAL' FROM runs
        UNION ALL SELECT 'quarantine_depth', CAST(count(*) AS DOUBLE), 0::DOUBLE, 'INVESTIGATE'
          FROM fp WHERE {_BAD}
        UNION ALL SELECT 'failed_checks',
          CASE WHEN count(*) FILTER (WHERE event_id % 50 = 0) > 0 THEN 1 ELSE 0 END::DOUBLE,
          0::DOUBLE, 'BLOCK' FROM fp
        ) AS a WHERE value > threshold""",
        "fp",
        "runs",
    ),
)
def alert_rules(spark: SparkSession, sf: str) -> DataFrame:
    """One row in fifty has lost its code, which fails one of the two checks."""
    code = F.when(F.col("event_id") % 50 > 0, F.col("country_code"))
    holed = I.facts(spark, sf).withColumn("country_code", code)
    results = Q.run_checks(holed, [post.sq_null_codes(), post.sq_names()])
    return monitor.alert_rules(I.runs(spark, sf), results, _quarantine(spark, sf))


@query(
    "file_load_history",
    sql(
        f"""SELECT _source_file AS file_name, CAST(count(*) AS BIGINT) AS row_parsed,
        CAST(count(*) FILTER (WHERE NOT {_BAD}) AS BIGINT) AS row_count,
        CAST(count(*) FILTER (WHERE {_BAD}) AS BIGINT) AS error_count,
        min({_REASON}) FILTER (WHERE {_BAD}) AS first_error_message,
        CASE WHEN count(*) FILTER (WHERE {_BAD}) = 0 THEN 'LOADED'
          WHEN count(*) FILTER (WHERE NOT {_BAD}) = 0 THEN 'LOAD_FAILED'
          ELSE 'PARTIALLY_LOADED' END AS status,
        max(_loaded_at) AS last_load_time,
        date_diff('second', min(_loaded_at), max(_loaded_at)) AS load_duration_seconds
        FROM fp WHERE _loaded_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY _source_file""",
        "fp",
    ),
)
def file_load_history(spark: SparkSession, sf: str) -> DataFrame:
    good = clean.quarantine_split(I.facts(spark, sf), rules())[0]
    return monitor.file_load_history(good, _quarantine(spark, sf), I.as_of())


@query(
    "dashboard",
    sql(
        f"""SELECT (SELECT CAST(count(*) AS BIGINT) FROM stg) AS total_staging_records,
        (SELECT CAST(count(DISTINCT country_code) AS BIGINT) FROM stg) AS unique_countries,
        (SELECT CAST(count(DISTINCT year) AS BIGINT) FROM stg) AS unique_years,
        (SELECT CAST(count(DISTINCT record_type) AS BIGINT) FROM stg) AS unique_record_types,
        (SELECT max(_loaded_at) FROM fp) AS last_raw_load,
        (SELECT max(_loaded_at) FROM stg) AS last_staging_load,
        (SELECT max(_updated_at) FROM {_MART} AS m) AS last_mart_update,
        (SELECT CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) FROM events
          WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY) AS quality_failures_24h,
        (SELECT CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) FROM events
          WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY) AS quality_warnings_24h,
        (SELECT CAST(count(error_code) AS BIGINT) FROM runs
          WHERE scheduled_time >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY) AS task_failures_24h,
        (SELECT CAST(count(*) FILTER (WHERE state = 'SUCCEEDED') AS BIGINT) FROM runs
          WHERE scheduled_time >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY) AS task_successes_24h""",
        "stg",
        "runs",
    ),
)
def dashboard(spark: SparkSession, sf: str) -> DataFrame:
    """Error events stand for failed checks, clicks for warnings."""
    kind = F.col("event_type")
    metrics = I.table(spark, sf, "events").select(
        F.col("ts").alias("check_timestamp"),
        F.when(kind == "error", "FAIL").when(kind == "click", "WARNING").otherwise("PASS").alias("status"),
    )
    raw, _, mart = _layers(spark, sf)
    staging, runs = I.staging(spark, sf), I.runs(spark, sf)
    return monitor.dashboard(staging, raw, mart, metrics, runs, I.as_of())
