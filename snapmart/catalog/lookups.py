"""Joins with lookup tables and between layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.catalog import inputs as I
from snapmart.catalog.registry import MART_METRICS, query, sql
from snapmart.operators import lookups

TYPES = """(SELECT record_type, 'type ' || max(score) AS description FROM fp
  WHERE record_type <> 'EFConsCarbonGHA' GROUP BY record_type) AS t"""


def known_types(spark: SparkSession, sf: str) -> DataFrame:
    """Types seen in the data but one, with a description."""
    rows = I.facts(spark, sf).filter("record_type <> 'EFConsCarbonGHA'")
    return rows.groupBy("record_type").agg(
        F.concat(F.lit("type "), F.max("score")).alias("description")
    )


@query(
    "describe_types",
    sql(
        f"""SELECT event_id, fp.record_type,
        coalesce(description, fp.record_type) AS record_type_description
        FROM fp LEFT JOIN {TYPES} ON t.record_type = fp.record_type""",
        "fp",
    ),
)
def describe_types(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.facts(spark, sf).select("event_id", "record_type")
    return lookups.describe_types(rows, known_types(spark, sf))


@query(
    "found_types",
    sql(
        f"""SELECT f.record_type, coalesce(description, f.record_type) AS description
        FROM (SELECT DISTINCT record_type FROM fp) AS f
        LEFT JOIN {TYPES} ON t.record_type = f.record_type""",
        "fp",
    ),
)
def found_types(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.found_types(I.facts(spark, sf), known_types(spark, sf))


def _metadata(spark: SparkSession, sf: str) -> DataFrame:
    """One entry per type and score; entries of one type have an empty name."""
    rows = I.facts(spark, sf).filter("record_type <> 'EFConsCarbonGHA'")
    return (
        rows.groupBy("record_type", "score")
        .agg(F.min("event_id").alias("position"))
        .select(
            F.concat_ws("-", "record_type", "score").alias("code"),
            F.when(F.col("record_type") == "BiocapTotGHA", "")
            .otherwise(F.concat_ws(" ", F.lit("named"), "score"))
            .alias("name"),
            F.col("record_type").alias("record"),
            "position",
        )
    )


_META = """(SELECT record_type || '-' || score AS code,
  CASE WHEN record_type = 'BiocapTotGHA' THEN '' ELSE 'named ' || score END AS name,
  record_type AS record, min(event_id) AS position
  FROM fp WHERE record_type <> 'EFConsCarbonGHA' GROUP BY record_type, score)"""


@query(
    "discover_types",
    sql(
        f"""SELECT s.record_type, coalesce(nullif(m.name, ''), s.record_type) AS description
        FROM (SELECT DISTINCT record_type FROM fp WHERE year = 2020) AS s
        LEFT JOIN (SELECT record, arg_min(name, position) AS name FROM {_META} AS e GROUP BY record)
          AS m ON m.record = s.record_type""",
        "fp",
    ),
)
def discover_types(spark: SparkSession, sf: str) -> DataFrame:
    sample = I.facts(spark, sf).filter("year = 2020")
    return lookups.discover_types(sample, _metadata(spark, sf))


@query(
    "discover_types_without_sample",
    sql(
        f"""SELECT record AS record_type, arg_max(name, position) AS description
        FROM {_META} AS e GROUP BY record""",
        "fp",
    ),
)
def discover_types_without_sample(spark: SparkSession, sf: str) -> DataFrame:
    """No rows in the sample year: the metadata alone, its last entry per type."""
    sample = I.facts(spark, sf).filter("year = 1950")
    return lookups.discover_types(sample, _metadata(spark, sf))


@query(
    "open_days",
    sql(
        """SELECT p.fund_code, p.market_date, p.return_type, p.daily_return
        FROM perf AS p JOIN cal AS c ON c.date = p.market_date
        WHERE c.is_working_day AND NOT c.is_holiday""",
        "perf",
        "cal",
    ),
)
def open_days(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.open_days(I.perf(spark, sf), I.calendar(spark, sf))


@query(
    "missing_calendar_dates",
    sql(
        """SELECT p.market_date, CAST(count(*) AS BIGINT) AS cnt
        FROM perf AS p LEFT JOIN cal AS c ON c.date = p.market_date
        WHERE c.date IS NULL GROUP BY 1""",
        "perf",
        "cal",
    ),
)
def missing_calendar_dates(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.missing_calendar_dates(I.perf(spark, sf), I.calendar(spark, sf))


@query(
    "orphaned_staging",
    sql(
        """SELECT CAST(count(*) AS BIGINT) AS orphans,
        CASE WHEN count(*) > 100 THEN 'WARNING' ELSE 'PASS' END AS status
        FROM stg AS s LEFT JOIN mart AS m
          ON s.country_code = m.country_code AND s.year = m.year
        WHERE m.country_code IS NULL""",
        "stg",
        "mart",
    ),
)
def orphaned_staging(spark: SparkSession, sf: str) -> DataFrame:
    staging = I.stored_staging(spark, sf)
    return lookups.orphaned_staging(staging, I.lagging_mart(staging))


@query(
    "latest_per_country",
    sql(
        f"""SELECT country_code, country_name, iso_alpha2, year, {MART_METRICS},
        max(_updated_at) AS last_updated FROM stg
        WHERE (country_code, year) IN (SELECT (country_code, max(year)) FROM stg GROUP BY country_code)
        GROUP BY country_code, country_name, iso_alpha2, year""",
        "stg",
    ),
)
def latest_per_country(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.latest_per_country(I.stored_staging(spark, sf))
