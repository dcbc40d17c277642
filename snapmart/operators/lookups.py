"""Joins against lookup tables, and anti and semi joins between layers.

No broadcast hints: Spark broadcasts a side when its size is below the session's threshold,
known from the files or measured while running, and otherwise shuffles and splits hot keys.
Anti joins reduce the large side to one row per key first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.functions import is_missing


def describe_types(df: DataFrame, types: DataFrame) -> DataFrame:
    """Add the description of each record type; a type without one describes itself.

    ``types`` holds (record_type, description), one row per type.
    """
    names = types.select("record_type", F.col("description").alias("record_type_description"))
    described = df.join(names, "record_type", "left")
    return described.withColumn(
        "record_type_description", F.coalesce("record_type_description", "record_type")
    )


def discover_types(
    sample: DataFrame, types_meta: DataFrame, order: str = "position"
) -> DataFrame:
    """Record types of a sample year with the name of the first metadata entry naming each.

    Without any type in the sample the metadata alone is used. ``types_meta`` holds code, name,
    record and an order column.
    """
    meta = types_meta.filter(~is_missing(types_meta, "code"))
    first_name = meta.groupBy("record").agg(F.min_by("name", order).alias("name"))
    found = sample.filter(~is_missing(sample, "record_type")).select("record_type").distinct()
    named = F.coalesce(F.nullif("name", F.lit("")), "record_type")
    from_sample = found.join(first_name, found.record_type == first_name.record, "left").select(
        "record_type", named.alias("description")
    )
    if not found.isEmpty():
        return from_sample
    last_name = meta.groupBy(F.coalesce("record", "code").alias("record_type")).agg(
        F.max_by(F.coalesce("name", "record", "code"), order).alias("description")
    )
    return last_name


def found_types(df: DataFrame, types: DataFrame) -> DataFrame:
    """Distinct record types of the data with their descriptions, in order."""
    found = df.filter(~is_missing(df, "record_type")).select("record_type").distinct()
    return (
        describe_types(found, types)
        .withColumnRenamed("record_type_description", "description")
        .orderBy("record_type")
    )


def open_days(perf: DataFrame, calendar: DataFrame) -> DataFrame:
    """Daily rows of trading days: working and no holiday."""
    days = calendar.filter("is_working_day AND NOT is_holiday").select(
        F.col("date").alias("market_date")
    )
    return perf.join(days, "market_date").select(perf.columns)


def missing_calendar_dates(perf: DataFrame, calendar: DataFrame) -> DataFrame:
    """Dates of the feed the calendar does not know, with their row counts."""
    dates = perf.groupBy("market_date").agg(F.count("*").alias("cnt"))
    known = calendar.select(F.col("date").alias("market_date"))
    return dates.join(known, "market_date", "left_anti").orderBy("market_date")


def without_match(
    df: DataFrame, other: DataFrame, key: Sequence[str] = tuple(schemas.MART_KEY)
) -> DataFrame:
    """Keys of ``df`` that ``other`` lacks, with how many rows carry each."""
    keys = df.groupBy(*key).agg(F.count("*").alias("rows"))
    return keys.join(other.select(*key), list(key), "left_anti")


def orphaned_staging(staging: DataFrame, mart: DataFrame, threshold: int = 100) -> DataFrame:
    """How many staging rows have no mart row, and whether that is more than some lag."""
    total = F.coalesce(F.sum("rows"), F.lit(0))
    return without_match(staging, mart).agg(
        total.alias("orphans"),
        F.when(total > threshold, "WARNING").otherwise("PASS").alias("status"),
    )


def latest_years(staging: DataFrame) -> DataFrame:
    """(country_code, latest year) of each country."""
    return staging.groupBy("country_code").agg(F.max("year").alias("year"))


def latest_per_country(staging: DataFrame) -> DataFrame:
    """Summary rows of each country's latest year.

    The semi join runs before the aggregation, so only the latest years are aggregated.
    """
    from snapmart.operators.marts import summary_view

    rows = staging.join(latest_years(staging), schemas.MART_KEY, "left_semi")
    return summary_view(rows)
