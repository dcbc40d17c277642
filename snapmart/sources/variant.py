"""Semi-structured columns: keep whole documents, project typed columns out of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_DATA = "raw_data"


def land_variant(spark: SparkSession, path: str, column: str = RAW_DATA) -> DataFrame:
    """Each JSON line whole in one VARIANT column, with its file."""
    rows = spark.read.option("singleVariantColumn", column).json(path)
    return rows.select(column, F.col("_metadata.file_path").alias("_source_file"))


def as_variant(df: DataFrame, column: str) -> Column:
    """The column as VARIANT; JSON text that does not parse becomes null."""
    if isinstance(df.schema[column].dataType, T.VariantType):
        return F.col(column)
    return F.try_parse_json(F.col(column))


def variant_project(
    df: DataFrame, mapping: Mapping[str, tuple[str, str]], column: str = RAW_DATA,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed columns by path: ``{name: (path, type)}``. A value that does not fit is null."""
    parsed = as_variant(df, column)
    return df.select(
        *[F.try_variant_get(parsed, path, kind).alias(n) for n, (path, kind) in mapping.items()],
        *keep,
    )


def copy_into_typed(
    df: DataFrame, mapping: Mapping[str, tuple[str, str]], column: str = RAW_DATA
) -> DataFrame:
    """Projection plus the file and row each document came from."""
    keep = [c for c in ("_source_file", "_row_number") if c in df.columns]
    return variant_project(df, mapping, column, keep)


def copy_into_legacy(df: DataFrame, source_file: str | Column, column: str = RAW_DATA) -> DataFrame:
    """Older narrow load of one file; extraction times that do not parse are null."""
    mapping = {
        "country_code": ("$.country_code", "bigint"),
        "country_name": ("$.country_name", "string"),
        "iso_alpha2": ("$.iso_alpha2", "string"),
        "year": ("$.year", "bigint"),
        "carbon_footprint_gha": ("$.carbon_footprint_gha", "double"),
        "total_footprint_gha": ("$.total_footprint_gha", "double"),
        "score": ("$.score", "string"),
        "extracted_at": ("$.extracted_at", "string"),
    }
    source = source_file if isinstance(source_file, Column) else F.lit(source_file)
    rows = variant_project(df.withColumn("_file", source), mapping, column, ["_file"])
    return rows.withColumn(
        "extracted_at", F.try_to_timestamp("extracted_at").cast("timestamp_ntz")
    ).withColumnRenamed("_file", "_source_file")
