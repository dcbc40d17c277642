"""Loading files that have already landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.sources.landed import CORRUPT, SOURCE, flatten_documents, read_documents


def matching_documents(
    spark: SparkSession, path: str, pattern: str = r".*\.json$", layout: str = "lines"
) -> DataFrame:
    """Documents of the files below ``path`` whose path relative to it matches."""
    root = path.rstrip("/")
    docs = read_documents(spark, root, layout, recursive=True)
    relative = F.regexp_replace(F.col(SOURCE), f"^.*{_quoted(root)}/", "")
    return docs.withColumn("file_name", relative).filter(F.col("file_name").rlike(pattern))


def _quoted(text: str) -> str:
    return r"\Q" + text.split("://", 1)[-1].lstrip("/") + r"\E"


def backfill_rows(
    spark: SparkSession, path: str, pattern: str = r".*\.json$", layout: str = "lines"
) -> DataFrame:
    """Records of all matching files, unparsable documents included and marked."""
    docs = matching_documents(spark, path, pattern, layout)
    return flatten_documents(docs, keep=["file_name", "_block", "_seq", SOURCE])


def backfill_report(rows: DataFrame) -> DataFrame:
    """Per file: rows loaded, rows that did not parse, SUCCESS unless nothing parsed."""
    return rows.groupBy("file_name").agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("records_loaded"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("errors"),
        F.when(F.count_if(F.col(CORRUPT).isNull()) > 0, "SUCCESS")
        .otherwise("FAILED")
        .alias("status"),
    )


def pending_files(rows: DataFrame, loaded: DataFrame) -> DataFrame:
    """How many matching files the landing table has no row of."""
    known = loaded.select("file_name").distinct()
    return (
        rows.select("file_name")
        .distinct()
        .join(known, "file_name", "left_anti")
        .agg(F.count("*").alias("pending_files"))
    )
