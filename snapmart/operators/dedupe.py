"""One row per key.

``row_number() = 1`` keeps a hot key harmless: Spark puts a group limit below the shuffle, so
each task sends at most one row per key, however many rows the key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.functions import first_order, is_missing, latest_order


def _keep_one(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def dedupe_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key; ``order`` must be the input order (file, position), made total."""
    return _keep_one(df, key, first_order(*order))


def dedupe_countries(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """First row per code among rows that have one."""
    return dedupe_first(df.filter(~is_missing(df, "country_code")), ["country_code"], order)


def dedupe_latest(
    df: DataFrame,
    key: Sequence[str] = tuple(schemas.FACT_KEY),
    order: Sequence[str] = ("transformed_at", "_loaded_at"),
    tie_break: Sequence[str] = ("_source_file", "_block", "_seq", "_row_number"),
) -> DataFrame:
    """Newest row per key, rows without a time last; tie breaks apply where they exist."""
    names = [*order, *[c for c in tie_break if c in df.columns]]
    return _keep_one(df, key, latest_order(*names))


def dedupe_stats(
    df: DataFrame, required: Sequence[str], key: Sequence[str] = tuple(schemas.FACT_KEY)
) -> DataFrame:
    """Rows in, invalid rows, valid rows, rows kept and duplicates removed, in one shuffle.

    Invalid rows fold into a single group before the shuffle.
    """
    valid = F.lit(True)
    for name in required:
        valid = valid & ~is_missing(df, name)
    flagged = df.select(
        valid.alias("valid"), *[F.when(valid, F.col(k)).alias(f"k{i}") for i, k in enumerate(key)]
    )
    groups = flagged.groupBy("valid", *[f"k{i}" for i in range(len(key))]).agg(
        F.count("*").alias("n")
    )

    def total(value, when):
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0))

    is_valid = F.col("valid")
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        total(F.col("n"), ~is_valid).alias("invalid"),
        total(F.col("n"), is_valid).alias("valid"),
        F.count_if(is_valid).alias("kept"),
        total(F.col("n") - 1, is_valid).alias("duplicates"),
    )
