"""Landing zones: immutable raw copies, staged copies, transformed copies, retention."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schemas
from snapmart.tables.layout import literal
from snapmart.tables.versions import delete_folder, list_folders


def snapshot_name(at: datetime) -> str:
    """Names sort by time; parts of a second are named where there are any."""
    return at.strftime("%Y%m%d_%H%M%S_%f" if at.microsecond else "%Y%m%d_%H%M%S")


def _text_stamps(df: DataFrame) -> DataFrame:
    """Times as ISO text, so JSON keeps their microseconds."""
    stamps = [n for n, kind in df.dtypes if kind in ("timestamp", "timestamp_ntz")]
    return df.withColumns({n: F.col(n).cast("string") for n in stamps}) if stamps else df


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count("*").alias("records")), seen


def write_raw_snapshot(df: DataFrame, root: str, at: datetime) -> dict[str, object]:
    """An immutable raw copy as JSON Lines; writing the same snapshot twice is an error."""
    path = f"{root}/raw/snapshot={snapshot_name(at)}"
    rows, seen = _counted(_text_stamps(df))
    rows.write.mode("errorifexists").json(path)
    return {"path": path, "extracted_at": at.isoformat(), "record_count": seen.get["records"]}


def write_staged(df: DataFrame, root: str, at: datetime) -> dict[str, object]:
    """A validated copy as Parquet, by ingest date, to load or replay from."""
    path = f"{root}/staged"
    rows, seen = _counted(df)
    rows = rows.withColumn("snapshot", F.lit(snapshot_name(at)))
    day = F.lit(at.date())
    rows.withColumn("ingest_date", day).write.mode("append").partitionBy(
        "ingest_date", "snapshot"
    ).parquet(path)
    return {"path": path, "snapshot": snapshot_name(at), "record_count": seen.get["records"]}


def read_staged(
    spark: SparkSession, root: str, snapshot: str, schema: T.StructType | None = None
) -> DataFrame:
    """The rows of one staged snapshot; only its folder is read.

    A snapshot without rows has no folder and needs its ``schema`` named.
    """
    folders = list_folders(spark, f"{root}/staged/ingest_date=*/snapshot={snapshot}")
    if not folders and schema is not None:
        return spark.createDataFrame([], schema)
    rows = spark.read.option("basePath", f"{root}/staged").parquet(*folders)
    return rows.drop("ingest_date", "snapshot")


def transformed_path(source_path: str) -> str:
    """Where the transformed copy of a raw file goes.

    raw/x.json becomes transformed/x_transformed.json, and a raw snapshot folder becomes
    transformed/<same name>_transformed.
    """
    before, found, after = source_path.rpartition("raw/")
    moved = f"{before}transformed/{after}" if found else source_path
    if moved.endswith(".json"):
        return moved[: -len(".json")] + "_transformed.json"
    return moved + "_transformed"


def write_transformed(df: DataFrame, source_path: str, at) -> dict[str, object]:
    """The transformed copy of a raw snapshot, each row carrying where it came from."""
    path = transformed_path(source_path)
    rows = df.withColumns({"_source_key": F.lit(source_path), "_transformed_at": literal(at)})
    rows, seen = _counted(_text_stamps(rows))
    rows.write.mode("errorifexists").json(path)
    return {"path": path, "source": source_path, "record_count": seen.get["records"]}


_DAY_FOLDERS = (
    ("year=*/month=*/day=*", r"year=(\d{4})/month=(\d{1,2})/day=(\d{1,2})$"),
    ("ingest_date=*", r"ingest_date=(\d{4})-(\d{2})-(\d{2})$"),
    ("*=*_*", r"/(?:snapshot|countries|contract)=(\d{4})(\d{2})(\d{2})_[^/]*$"),
)


def _dated_folders(spark: SparkSession, path: str) -> list[tuple[str, date]]:
    """Folders named after a day, a snapshot or an ingest date, with that day."""
    out = []
    for pattern, name in _DAY_FOLDERS:
        for folder in list_folders(spark, f"{path}/{pattern}"):
            found = re.search(name, folder)
            if found:
                out.append((folder, date(*map(int, found.groups()))))
    return sorted(out)


def expired_partitions(
    spark: SparkSession, root: str, zone: str, as_of: date, keep_days: int | None = None
) -> list[str]:
    """Folders of a zone older than its retention."""
    days = schemas.RETENTION_DAYS[zone] if keep_days is None else keep_days
    oldest = as_of - timedelta(days=days)
    return [p for p, day in _dated_folders(spark, f"{root}/{zone}") if day < oldest]


def expire_partitions(
    spark: SparkSession, root: str, zone: str, as_of: date, keep_days: int | None = None
) -> list[str]:
    """Delete the expired folders of one zone below ``root``; returns what went."""
    expired = expired_partitions(spark, root, zone, as_of, keep_days)
    return [p for p in expired if delete_folder(spark, p)]
