"""Checks before a load, from a table -> check -> parameters mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.functions import is_missing
from snapmart.quality.checks import (
    FAIL,
    PASS,
    WARNING,
    Check,
    Distinct,
    Repeats,
    Counter,
    at_least,
    at_most,
    none_of,
    run_checks,
)

# What is checked when no definitions are given.
DEFAULT_DEFINITIONS = {
    "footprint_data": {
        "row_count": {"min": 1},
        "required_columns": ["country_code", "country_name", "year", "record_type"],
        "valid_year_range": {"min": schemas.YEAR_MIN, "max": schemas.YEAR_MAX},
        "non_negative_value": True,
        "unique_key": ["country_code", "year", "record_type"],
    },
    "countries": {
        "row_count": {"min": 1},
        "required_columns": ["country_code", "country_name"],
        "unique_key": ["country_code"],
    },
}

STANDARD_DEFINITIONS = {
    "footprint_data": {
        **DEFAULT_DEFINITIONS["footprint_data"],
        "valid_record_types": schemas.VALID_RECORD_TYPES,
    },
    "countries": {**DEFAULT_DEFINITIONS["countries"], "min_country_coverage": 150},
}


def load_definitions(path: str, spark: SparkSession | None = None) -> Mapping[str, Mapping]:
    """Definitions from a YAML file, read by Spark; the defaults where there is no file."""
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading definitions from a file needs the yaml module") from error
    spark = spark or SparkSession.active()
    try:
        return yaml.safe_load(spark.read.text(path, wholetext=True).first()["value"])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return DEFAULT_DEFINITIONS


def dq_row_count(table: str, minimum: int = 1) -> Check:
    return Check(table, "row_count", Counter(F.count("*")), at_least(minimum), minimum)


def dq_required(df: DataFrame, table: str, column: str) -> Check:
    missing = is_missing(df, column) if column in df.columns else F.lit(True)
    return Check(table, f"required.{column}", none_of(missing), at_most(0))


def dq_year_range(df: DataFrame, table: str, low: int, high: int, column: str = "year") -> Check:
    year = F.col(column)
    outside = ~is_missing(df, column) & ((year < low) | (year > high))
    return Check(table, f"range.{column}", none_of(outside), at_most(0), details=f"[{low}, {high}]")


def _unknown(df: DataFrame, allowed: Sequence[str], column: str):
    return ~is_missing(df, column) & ~F.col(column).isin(list(allowed))


def dq_valid_types(
    df: DataFrame, table: str, allowed: Sequence[str], column: str = "record_type"
) -> Check:
    """Number of distinct unknown types; a warning, since new types may appear."""
    metric = Distinct(column, _unknown(df, allowed, column))
    return Check(table, f"valid.{column}", metric, at_most(0), on_breach=WARNING)


def unknown_types(
    df: DataFrame, allowed: Sequence[str] = schemas.VALID_RECORD_TYPES, column: str = "record_type"
) -> DataFrame:
    """Every unknown type with its number of rows."""
    return df.filter(_unknown(df, allowed, column)).groupBy(column).agg(F.count("*").alias("rows"))


def dq_non_negative(table: str, column: str = "value") -> Check:
    return Check(table, f"non_negative.{column}", none_of(F.col(column) < 0), at_most(0))


def dq_unique_key(table: str, key: Sequence[str]) -> Check:
    """Surplus rows over distinct keys; nulls in a key equal each other."""
    return Check(table, "unique_key", Repeats(tuple(key)), at_most(0), details=", ".join(key))


def dq_unique_country(df: DataFrame, table: str, column: str = "country_code") -> Check:
    """Surplus rows over distinct codes, among rows that have a code."""
    metric = Repeats((column,), where=~is_missing(df, column))
    return Check(table, "unique_key", metric, at_most(0), details=column)


def dq_coverage(df: DataFrame, table: str, minimum: int, column: str = "country_code") -> Check:
    """Distinct codes; a warning, since partial data is allowed."""
    metric = Distinct(column, ~is_missing(df, column))
    return Check(table, "coverage", metric, at_least(minimum), minimum, WARNING)


def compile_definition(df: DataFrame, table: str, spec: Mapping) -> list[Check]:
    """Checks of one table. A countries table is unique by its code alone."""
    checks = []
    if "row_count" in spec:
        checks.append(dq_row_count(table, spec["row_count"].get("min", 1)))
    checks += [dq_required(df, table, c) for c in spec.get("required_columns", [])]
    if "valid_year_range" in spec:
        bounds = spec["valid_year_range"]
        low, high = bounds.get("min", schemas.YEAR_MIN), bounds.get("max", schemas.YEAR_MAX)
        checks.append(dq_year_range(df, table, low, high))
    if "valid_record_types" in spec:
        checks.append(dq_valid_types(df, table, spec["valid_record_types"]))
    if spec.get("non_negative_value"):
        checks.append(dq_non_negative(table))
    if "unique_key" in spec:
        by_code = table == "countries"
        checks.append(
            dq_unique_country(df, table) if by_code else dq_unique_key(table, spec["unique_key"])
        )
    if "min_country_coverage" in spec:
        checks.append(dq_coverage(df, table, spec["min_country_coverage"]))
    return checks


def run_definitions(
    tables: Mapping[str, DataFrame], definitions: Mapping[str, Mapping] = STANDARD_DEFINITIONS
) -> DataFrame:
    """Check rows of every defined table; a table that is not given counts as an error."""
    parts = [
        run_checks(tables[name], compile_definition(tables[name], name, spec))
        for name, spec in definitions.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dq_report(results: DataFrame) -> DataFrame:
    """One row: passed unless a check failed; a warned check also counts as passed.

    The lists hold one entry per check, so they are as short as the definitions.
    """
    label = F.concat_ws(
        ".", "table_name", F.concat(F.col("metric_name"), F.lit(": "),
                                    F.col("metric_value").cast("bigint").cast("string"))
    )

    def listed(status: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("status") == status, label)))

    return results.agg(
        (F.count_if(F.col("status") == FAIL) == 0).alias("passed"),
        F.count("*").alias("checks_run"),
        F.count_if(F.col("status").isin(PASS, WARNING)).alias("checks_passed"),
        F.count_if(F.col("status") == FAIL).alias("checks_failed"),
        F.count_if(F.col("status") == WARNING).alias("checks_warned"),
        listed(FAIL).alias("failed_checks"),
        listed(WARNING).alias("warnings"),
    )


def gate(report: DataFrame, raise_on_failure: bool = True, warn_only: bool = False) -> dict:
    """The report as a dict; raises on failure unless told to warn only."""
    row = report.first().asDict()
    if not row["passed"] and raise_on_failure and not warn_only:
        raise ValueError(f"{row['checks_failed']} checks failed: {row['failed_checks']}")
    return row
