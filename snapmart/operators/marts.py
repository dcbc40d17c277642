"""Aggregates that turn the long fact into one row per country and year, and table summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.operators.clean import scale_round


def _of_types(parts: Sequence[str], exact: str | None = None) -> Column:
    """Whether the record type contains all the parts, case minded, or is the exact one."""
    named = F.lit(True)
    for part in parts:
        named = named & F.col("record_type").contains(part)
    return named | (F.col("record_type") == exact) if exact else named


def _metric(name: str) -> Column:
    """A mart metric as an aggregate; the deficit is null if either side is."""
    if name == schemas.DEFICIT:
        footprint, biocapacity = (_metric(n) for n in schemas.DEFICIT_OF)
        return footprint - biocapacity
    if name in schemas.COLUMN_METRICS:
        return F.max(schemas.COLUMN_METRICS[name])
    measure, parts, exact = schemas.TYPE_METRICS[name]
    return F.max(F.when(_of_types(parts, exact), F.col(measure)))


def mart_summary(staging: DataFrame) -> DataFrame:
    """One row per country and year, record types turned into columns."""
    return staging.groupBy(*schemas.MART_KEY).agg(
        F.max("country_name").alias("country_name"),
        F.max("iso_alpha2").alias("iso_alpha2"),
        *[_metric(m).alias(m) for m in schemas.MART_METRICS],
    )


def mart_summary_recent(staging: DataFrame, as_of: Column, hours: int = 2) -> DataFrame:
    """Summary of the rows updated lately only, so metrics of other rows are null."""
    since = as_of - F.make_dt_interval(hours=F.lit(hours))
    return mart_summary(staging.filter(F.col("_updated_at") >= since))


def mart_summary_for(staging: DataFrame, touched: DataFrame) -> DataFrame:
    """Summary of the touched (country, year) keys over all their rows."""
    keys = touched.select(*schemas.MART_KEY).distinct()
    return mart_summary(staging.join(keys, schemas.MART_KEY, "left_semi"))


def summary_view(staging: DataFrame) -> DataFrame:
    """Totals per country, names and year, with the time of the last update."""
    return staging.groupBy("country_code", "country_name", "iso_alpha2", "year").agg(
        *[_metric(m).alias(m) for m in schemas.VIEW_METRICS],
        F.max("_updated_at").alias("last_updated"),
    )


def trends_view(staging: DataFrame, ordered: bool = True) -> DataFrame:
    """Sums per country and year. Carbon is summed over all types, so parts count with totals."""
    footprint = F.when(_of_types(["EFConsTot"]), F.col("value"))
    out = staging.groupBy("country_name", "iso_alpha2", "year").agg(
        F.sum(footprint).alias("total_footprint"),
        F.sum("carbon").alias("carbon_footprint"),
        F.max("carbon_pct_of_total").alias("carbon_percentage"),
    )
    return out.orderBy("country_name", "year", "iso_alpha2") if ordered else out


def legacy_summary(fact: DataFrame, measure: str = "carbon") -> DataFrame:
    return fact.groupBy("country_code", "country_name", "iso_alpha2", "year").agg(
        F.sum(measure).alias("total_carbon_footprint_gha"),
        F.count("*").alias("record_count"),
        F.max("score").alias("latest_score"),
    )


def with_distincts(
    df: DataFrame, key: Sequence[str], distinct: Mapping[str, Column], aggregates: Sequence[Column] = ()
) -> DataFrame:
    """Aggregates and distinct counts (alias -> column) per key, or of the whole for no key.

    Several distinct counts in one aggregate would copy every row once for each of them. Here
    each gets a pass of its own that reads its columns only, and the results, one row per key,
    are put together by a union and a maximum.
    """
    parts = [df.groupBy(*key).agg(*aggregates)] if aggregates else []
    for name, col in distinct.items():
        values = df.select(*key, col.alias("_value")).distinct()
        parts.append(values.groupBy(*key).agg(F.count("_value").alias(name)))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.groupBy(*key).agg(*[F.max(c).alias(c) for c in both.columns if c not in key])


def country_coverage(staging: DataFrame, ordered: bool = True) -> DataFrame:
    key = ["country_code", "country_name", "iso_alpha2"]
    out = with_distincts(
        staging, key,
        {"years_available": F.col("year"), "record_types": F.col("record_type")},
        [F.min("year").alias("first_year"), F.max("year").alias("last_year"),
         F.max("_loaded_at").alias("last_updated")],
    ).select(*key, "years_available", "first_year", "last_year", "record_types", "last_updated")
    return out.orderBy("country_name", "country_code") if ordered else out


def load_summary(raw: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Rows, files and countries per load hour of the last days."""
    since = as_of - F.make_dt_interval(days=F.lit(days))
    hour = F.date_trunc("hour", F.col("_loaded_at")).cast("timestamp_ntz")
    recent = raw.filter(F.col("_loaded_at") >= since).withColumn("load_hour", hour)
    return with_distincts(
        recent, ["load_hour"],
        {"files_loaded": F.col("_source_file"), "countries_loaded": F.col("country_code")},
        [F.count("*").alias("records_loaded"), F.min("year").alias("min_year"),
         F.max("year").alias("max_year")],
    ).orderBy(F.col("load_hour").desc())


def extract_metadata(df: DataFrame) -> DataFrame:
    return with_distincts(
        df, [],
        {"unique_countries": F.col("country_code"),
         "unique_record_types": F.nullif("record_type", F.lit(""))},
        [F.count("*").alias("total_records")],
    )


def table_counts(df: DataFrame) -> DataFrame:
    return with_distincts(
        df, [], {"countries": F.col("country_code")}, [F.count("*").alias("records")]
    )


def table_summary(df: DataFrame) -> DataFrame:
    return with_distincts(
        df, [], {"countries": F.col("country_code"), "years": F.col("year")},
        [F.count("*").alias("records"), F.min("year").alias("min_year"),
         F.max("year").alias("max_year")],
    )


def business_key_dups(df: DataFrame, key: Sequence[str], ordered: bool = True) -> DataFrame:
    """Keys that occur more than once, the most frequent first."""
    counted = df.groupBy(*key).agg(F.count("*").alias("cnt")).filter("cnt > 1")
    return counted.orderBy(F.col("cnt").desc(), *key) if ordered else counted


def top_emitters(
    df: DataFrame, year: int, record_type: str = "EFConsTotGHA", n: int = 10,
    tie_break: Sequence[str] = ("country_code",),
) -> DataFrame:
    """The n largest values of one year and type, in millions."""
    return (
        df.filter((F.col("year") == year) & (F.col("record_type") == record_type))
        .orderBy(F.col("value").desc_nulls_last(), *tie_break)
        .limit(n)
        .select("country_name", "year", scale_round(F.col("value")).alias("value_million"))
    )
