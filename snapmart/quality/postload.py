"""Checks of loaded tables, and the scheduled checks between layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.operators.lookups import orphaned_staging
from snapmart.quality.checks import (
    WARNING,
    Check,
    Counter,
    Distinct,
    Known,
    Outcome,
    Repeats,
    at_least,
    at_most,
    none_of,
    run_checks,
)


def pq_row_count(table: str, low: int = 1, high: int | None = None) -> Check:
    bounds = (lambda v: v >= low) if high is None else (lambda v: v.between(low, high))
    return Check(table, "row_count", Counter(F.count("*")), bounds, low)


def pq_freshness(table: str, column: str, as_of: Column, max_seconds: int = 86_400) -> Check:
    """Age of the newest load in seconds; an empty table has no age and fails."""
    age = F.timestamp_diff("SECOND", F.max(column), as_of)
    passes = lambda v: F.coalesce(v < max_seconds, F.lit(False))
    return Check(table, f"freshness.{column}", Counter(age), passes, max_seconds)


def pq_missing(table: str, column: str) -> Check:
    """Nulls only; zero and empty text are values here."""
    return Check(table, f"missing.{column}", none_of(F.col(column).isNull()), at_most(0))


def _outside(column: str, low: float | None, high: float | None) -> Column:
    cond = F.lit(False)
    if low is not None:
        cond = cond | (F.col(column) < low)
    if high is not None:
        cond = cond | (F.col(column) > high)
    return cond


def pq_range(table: str, column: str, low: float | None = None, high: float | None = None) -> Check:
    return Check(table, f"range.{column}", none_of(_outside(column, low, high)), at_most(0))


def pq_invalid_percent(
    table: str, column: str, low: float | None, high: float | None, percent: float = 1.0
) -> Check:
    """Share of rows out of range, in percent; zero for an empty table."""
    share = F.count_if(_outside(column, low, high)) * F.lit(100.0)
    metric = Counter(F.coalesce(F.try_divide(share, F.count("*").cast("double")), F.lit(0.0)))
    return Check(table, f"invalid_percent.{column}", metric, lambda v: v < percent, percent)


def pq_valid_values(table: str, column: str, allowed: Sequence[str]) -> Check:
    return Check(table, f"valid.{column}", none_of(~F.col(column).isin(list(allowed))), at_most(0))


def pq_duplicates(table: str, key: Sequence[str]) -> Check:
    metric = Repeats(tuple(key), "groups")
    return Check(table, "duplicates", metric, at_most(0), details=", ".join(key))


def pq_schema(df: DataFrame, table: str, required: Sequence[str]) -> Check:
    """Required columns that do not exist; settled from the schema alone."""
    absent = [c for c in required if c not in df.columns]
    return Check(table, "schema", Known(len(absent)), at_most(0), details=", ".join(absent))


def pq_required_value(table: str, column: str, value: str) -> Check:
    """Whether a value occurs at least once."""
    found = Counter(F.count_if(F.col(column) == value))
    return Check(table, f"present.{column}.{value}", found, at_least(1), 1)


def pq_distinct(table: str, column: str, minimum: int) -> Check:
    return Check(table, f"distinct.{column}", Distinct(column), at_least(minimum), minimum)


def pq_iso_format(table: str, column: str = "iso_alpha2") -> Check:
    """Codes that are not two capital letters."""
    return Check(table, f"format.{column}", none_of(~F.col(column).rlike("^[A-Z]{2}$")), at_most(0))


def pq_row_count_anomaly(log: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Newest run's row count against mean and deviation of the runs before it.

    ``log`` has one row per run: log_timestamp, records_processed.
    """
    newest = log.agg(F.max("log_timestamp").alias("newest")).scalar()
    is_last = F.col("log_timestamp") == newest
    before = F.when(~is_last, F.col("records_processed"))
    count = F.max(F.when(is_last, F.col("records_processed")))
    mean, spread = F.avg(before), F.stddev_pop(before)
    return log.agg(
        count.alias("latest_count"),
        mean.alias("mean_count"),
        spread.alias("stddev_count"),
        F.when(F.abs(count - mean) > spread * sigmas, WARNING).otherwise("PASS").alias("status"),
    )


def standard_checks(
    df: DataFrame, table: str, as_of: Column, category: str | None = None
) -> list[Check]:
    """The whole post-load set. ``category`` names the category column where there is one."""
    required = ["country_code", "country_name", "year", "record_type"]
    columns = required + ([category] if category else [])
    checks = [pq_schema(df, table, [*columns, "value", "_loaded_at"])]
    checks += [pq_row_count(table), pq_freshness(table, "_loaded_at", as_of)]
    checks += [pq_missing(table, c) for c in columns]
    checks += [
        pq_range(table, "year", schemas.YEAR_MIN, schemas.YEAR_MAX),
        pq_range(table, "value", 0),
        pq_valid_values(table, "record_type", schemas.VALID_RECORD_TYPES),
        pq_duplicates(table, schemas.FACT_KEY),
        pq_required_value(table, "record_type", "EFCtot"),
        pq_required_value(table, "record_type", "BioCaptot"),
        pq_distinct(table, "country_code", 150),
        pq_distinct(table, "year", 50),
    ]
    if category:
        checks.append(pq_valid_values(table, category, schemas.VALID_CATEGORIES))
    return checks


def with_category(df: DataFrame, record_types: DataFrame) -> DataFrame:
    """Add the category of each record type."""
    return df.join(record_types.select("record_type", "category"), "record_type", "left")


def sq_null_codes(table: str = "staging") -> Check:
    return Check(
        table, "null_country_codes", none_of(F.col("country_code").isNull()), at_most(0),
        details="rows without a country code",
    )


def sq_duplicates(table: str = "staging", key: Sequence[str] = tuple(schemas.FACT_KEY)) -> Check:
    return Check(
        table, "duplicate_records", Repeats(tuple(key), "groups"), at_most(0), on_breach=WARNING,
        details="keys that occur more than once",
    )


def sq_negative(table: str = "staging", columns: Sequence[str] = ("value", "carbon")) -> Check:
    cond = F.lit(False)
    for name in columns:
        cond = cond | (F.col(name) < 0)
    return Check(
        table, "negative_values", none_of(cond), at_most(0), on_breach=WARNING,
        details="rows with a negative measure",
    )


def sq_years(as_of: Column, table: str = "staging") -> Check:
    year = F.col("year")
    return Check(
        table, "invalid_years", none_of((year < schemas.YEAR_MIN) | (year > F.year(as_of) + 1)),
        at_most(0), details="years before 1960 or after next year",
    )


def sq_names(table: str = "staging") -> Check:
    name = F.col("country_name")
    return Check(
        table, "missing_country_names", none_of(name.isNull() | (F.trim(name) == "")), at_most(0),
        on_breach=WARNING, details="rows without a country name",
    )


def sq_orphans(
    staging: DataFrame, mart: DataFrame, threshold: int = 100, table: str = "staging"
) -> Check:
    found = orphaned_staging(staging, mart, threshold)
    return Check(
        table, "orphaned_staging_records",
        Outcome(found.select(F.col("orphans").alias("metric_value"))),
        at_most(threshold), threshold, WARNING, "staging rows the mart does not have yet",
    )


def sq_metrics(staging: DataFrame, mart: DataFrame, as_of: Column) -> DataFrame:
    """The six scheduled checks as rows for the quality metrics table."""
    checks = [
        sq_null_codes(),
        sq_duplicates(),
        sq_negative(),
        sq_years(as_of),
        sq_names(),
        sq_orphans(staging, mart),
    ]
    return run_checks(staging, checks).withColumn(
        "check_timestamp", as_of.cast("timestamp_ntz")
    )


def run_postload(
    df: DataFrame, table: str, as_of: Column, extra: Mapping[str, Check] | None = None,
    category: str | None = None,
) -> DataFrame:
    checks = standard_checks(df, table, as_of, category)
    return run_checks(df, [*checks, *(extra or {}).values()])
