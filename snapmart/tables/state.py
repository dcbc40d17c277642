"""Incremental state and the run log: append-only tables, the newest row counts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schemas
from snapmart.tables.versions import list_folders


def _literal(value, field: T.StructField) -> Column:
    if isinstance(value, dict):
        pairs = [F.lit(x) for pair in value.items() for x in pair]
        col = F.create_map(*pairs) if pairs else F.create_map()
    else:
        col = F.lit(value)
    return col.cast(field.dataType).alias(field.name)


def _append(spark: SparkSession, path: str, rows: list[tuple], schema: T.StructType) -> None:
    """A few rows, made of literals, as one small file."""
    cells = [F.struct(*[_literal(v, f) for v, f in zip(row, schema)]) for row in rows]
    one = spark.range(0, 1, 1, 1).select(F.inline(F.array(*cells)))
    one.write.mode("append").parquet(path)


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    if not list_folders(spark, f"{path}/*.parquet"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.STATE)


def write_state(
    spark: SparkSession, path: str, job: str, last_year: int, load_id: str, at: datetime
) -> None:
    _append(spark, path, [(job, at, last_year, load_id)], schemas.STATE)


def current_state(state: DataFrame) -> DataFrame:
    """The newest state of each job."""
    return state.groupBy("job").agg(
        F.max_by("last_year", "recorded_at").alias("last_year"),
        F.max_by("last_load_id", "recorded_at").alias("last_load_id"),
    )


def last_year_of(state: DataFrame, job: str) -> int | None:
    row = current_state(state.filter(F.col("job") == job)).first()
    return row.last_year if row else None


def year_window(
    last_year: int | None, start: int, end: int, force: bool = False
) -> tuple[int, int]:
    """Years to load: the last one is taken again with the one before it, to catch updates.

    The window is empty where it starts past ``end``.
    """
    if force or not last_year or last_year < start:
        return start, end
    return max(last_year - 1, start), end


def incremental_read(
    df: DataFrame, state: DataFrame, job: str, start: int, end: int, force: bool = False
) -> DataFrame:
    """Rows of the window that follows from the state, as literals that prune folders."""
    first, last = year_window(last_year_of(state, job), start, end, force)
    return df.filter(F.col("year").between(first, last))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.RUN_LOG)


def log_row(
    run_id: str,
    stage: str,
    status: str,
    at: datetime,
    records: int | None = None,
    millis: int | None = None,
    source_file: str | None = None,
    error: str | None = None,
    metadata: dict[str, str] | None = None,
) -> tuple:
    """One stage of a run as a row of the run log."""
    return (at, run_id, stage, status, records, millis, source_file, error, metadata or {})


def log_runs(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Append the stages of a run together."""
    if rows:
        _append(spark, path, rows, schemas.RUN_LOG)


def log_rows_of(df: DataFrame, path: str, at: datetime) -> None:
    """Append a frame as run log rows at ``at``; columns it lacks are null."""
    have = set(df.columns)
    kinds = {f.name: f.dataType for f in schemas.RUN_LOG}
    stamped = {
        n: F.lit(at) if n == schemas.RUN_LOG.names[0] else F.col(n) if n in have else F.lit(None)
        for n in kinds
    }
    df.select(*[c.cast(kinds[n]).alias(n) for n, c in stamped.items()]).write.mode("append").parquet(path)


def log_run(spark: SparkSession, path: str, *stage, **facts) -> None:
    """Append one stage, given as for ``log_row``."""
    log_runs(spark, path, [log_row(*stage, **facts)])


def observed_last_year(df: DataFrame, default: int) -> Column | int:
    """Largest year really loaded, for state that should not run ahead of the data."""
    row = df.agg(F.max("year").alias("y")).first()
    return row.y if row and row.y is not None else default
