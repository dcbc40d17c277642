"""How rows are spread over files before a write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.session import shared_dir


def rebalanced(
    df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> DataFrame:
    """Rows grouped by partition value, with hot values split and small ones put together.

    A plain repartition by year would send a hot year to one task. The rebalance hint lets
    adaptive execution cut such a partition into pieces of the advisory size, and adds no
    sampling pass. Sorting within the pieces gives each file narrow min/max statistics.
    """
    spread = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    order = [*partition_by, *[c for c in sort_by if c not in partition_by]]
    return spread.sortWithinPartitions(*order) if order else spread


def cluster_layout(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("year",),
    sort_by: Sequence[str] = ("country_code",), mode: str = "errorifexists",
) -> None:
    """Write partitioned by year, sorted by country inside the files."""
    rebalanced(df, partition_by, sort_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def with_day_parts(df: DataFrame, at: str) -> DataFrame:
    """Partition columns year, month, day of a time column; months and days keep two digits."""
    stamp = F.col(at)
    return df.withColumns(
        {
            "year": F.date_format(stamp, "yyyy"),
            "month": F.date_format(stamp, "MM"),
            "day": F.date_format(stamp, "dd"),
        }
    )


DAY_PARTS = ["year", "month", "day"]


def partitioned_layout(
    df: DataFrame, root: str, zone: str, at: str, mode: str = "append", kind: str = "parquet"
) -> str:
    """Write below ``root/zone`` by year, month and day of ``at``.

    Rows keep their own ``year`` column as ``data_year``, since the folder takes the name.
    """
    path = f"{root}/{zone}"
    rows = df.withColumnRenamed("year", "data_year") if "year" in df.columns else df
    out = rebalanced(with_day_parts(rows, at), DAY_PARTS)
    out.write.mode(mode).partitionBy(*DAY_PARTS).format(kind).save(path)
    return path


def write_zones(flagged: DataFrame, path: str, reasons: str = "_reasons") -> str:
    """Good and failed rows in one pass, as ``zone=good`` and ``zone=failed`` folders."""
    zone = F.when(F.size(reasons) == 0, "good").otherwise("failed")
    flagged.withColumn("zone", zone).write.mode("errorifexists").partitionBy("zone").parquet(path)
    return path


def materialise(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager)


def literal(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp_ntz")
