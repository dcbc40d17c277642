"""Profiles of loads: counts and mergeable sketches per partition, and limits drawn from them.

Each load appends one row per partition: its rows, a HyperLogLog sketch of a key and a quantile
sketch of a value. Later loads are judged by these rows alone, so no data of earlier loads is read
again; sketches of many loads merge into one of fixed size. Limits are the median and the median
absolute deviation of earlier loads of the same season, which a few odd loads cannot move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.tables.versions import list_folders

#: Makes the median absolute deviation of normal counts their standard deviation.
MAD_SCALE = 1.4826


def profile(
    rows: DataFrame, by: Sequence[str], load: Sequence[str], key: str, value: str
) -> DataFrame:
    """One row per load and partition: n_rows, and sketches of ``key`` and ``value``.

    Both combine before the shuffle, so a partition with most rows costs one sketch per task.
    Null keys and values are in ``n_rows`` only.
    """
    return rows.groupBy(*load, *by).agg(
        F.count("*").alias("n_rows"),
        F.hll_sketch_agg(F.col(key).cast("string")).alias("keys"),
        F.kll_sketch_agg_double(F.col(value).cast("double")).alias("quantiles"),
    )


def append_profile(profiles: DataFrame, path: str) -> None:
    profiles.write.mode("append").parquet(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame | None:
    """All profiles below ``path``; none before the first load."""
    return spark.read.parquet(path) if list_folders(spark, f"{path}/*.parquet") else None


def month_end(day: Column, days: int = 2) -> Column:
    """The season 'month end' (its last ``days`` days) or 'other'."""
    return F.when(F.datediff(F.last_day(day), day) < days, "month end").otherwise("other")


def day_of_week(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def _median(values: Column) -> Column:
    """Median of an array, null if it is empty."""
    ordered, n = F.array_sort(values), F.size(values)
    middle = F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, middle / 2)


def _newest(profiles: DataFrame, load: str, season: Column, newest) -> tuple[DataFrame, object]:
    """Profiles of the season of the newest load, up to that load, and the load."""
    known = profiles.withColumns({"_load": F.col(load), "_season": season})
    if newest is not None:
        known = known.filter(F.col("_load") <= F.lit(newest))
    last = known.agg(F.max("_load").alias("load"), F.max_by("_season", "_load").alias("season")).first()
    return known.filter(F.col("_season") == last["season"]), last["load"]


def count_anomalies(
    profiles: DataFrame, by: Sequence[str], load: str, season: Column | None = None,
    deviations: float = 4.0, slack: float = 0.1, least_loads: int = 3, newest=None,
) -> DataFrame:
    """Rows of the newest load per partition against earlier loads of the same season.

    Limits are the median plus and minus the larger of ``deviations`` scaled median absolute
    deviations and ``slack`` times the median. A load that lacks a partition seen before has 0 rows
    of it, the newest too. status: LOW, HIGH, PASS, or NEW with fewer than ``least_loads`` earlier
    loads. ``newest`` names the load to judge; later ones are left out. Several profiles of a
    load and partition, as from several files, are added up.
    """
    known, last = _newest(profiles, load, F.lit("all") if season is None else season, newest)
    counts = known.groupBy(*by, "_load").agg(F.sum("n_rows").alias("n_rows"))
    before = F.col("_load") != F.lit(last)
    # A row per load: numbered here, so that loads without a partition can be counted as 0.
    loads = known.filter(before).select("_load").distinct()
    numbered = loads.withColumn("_number", F.row_number().over(Window.orderBy("_load")))
    n_loads = loads.count()
    found = counts.join(numbered, "_load", "left").groupBy(*by).agg(
        F.max(F.when(~before, F.col("n_rows"))).alias("n_rows"),
        F.collect_list(F.when(before, F.col("n_rows"))).alias("_counts"),
        F.min("_number").alias("_first"),
    )
    since = F.coalesce(F.lit(n_loads + 1) - F.col("_first"), F.lit(0))
    zeros = F.array_repeat(F.lit(0).cast("bigint"), (since - F.size("_counts")).cast("int"))
    found = found.withColumn("_counts", F.concat("_counts", zeros))
    found = found.withColumn("median_rows", _median(F.col("_counts")))
    away = F.transform("_counts", lambda n: F.abs(n - F.col("median_rows")))
    found = found.withColumn("_spread", F.greatest(
        _median(away) * (MAD_SCALE * deviations), F.col("median_rows") * slack
    ))
    n, low, high = F.coalesce("n_rows", F.lit(0)), F.col("low_rows"), F.col("high_rows")
    status = (
        F.when(F.col("n_loads") < least_loads, "NEW")
        .when(n < low, "LOW").when(n > high, "HIGH").otherwise("PASS")
    )
    limits = found.select(
        *by, n.cast("bigint").alias("n_rows"), F.size("_counts").cast("bigint").alias("n_loads"),
        "median_rows",
        F.greatest(F.col("median_rows") - F.col("_spread"), F.lit(0.0)).alias("low_rows"),
        (F.col("median_rows") + F.col("_spread")).alias("high_rows"),
    )
    return limits.withColumn("status", status)


def value_shifts(
    profiles: DataFrame, by: Sequence[str], load: str, season: Column | None = None,
    tail: float = 0.05, newest=None,
) -> DataFrame:
    """Keys and median of the newest load per partition against the merged sketches of earlier ones.

    n_keys and known_keys are estimates of distinct keys, now and ever before; status is SHIFTED
    if the newest median lies outside the ``tail`` and 1 - ``tail`` quantiles of all earlier values,
    NEW or GONE for a partition that one side lacks. Sketches without values give null quantiles.
    """
    known, last = _newest(profiles, load, F.lit("all") if season is None else season, newest)

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*by).agg(
            F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("n_keys"),
            F.kll_merge_agg_double("quantiles").alias("_sketch"),
        )

    def quantile(at: float) -> Column:
        some = F.kll_sketch_get_n_double("_sketch") > 0
        return F.when(some, F.kll_sketch_get_quantile_double("_sketch", F.lit(at)))

    is_last = F.col("_load") == F.lit(last)
    now = merged(known.filter(is_last)).select(
        *by, "n_keys", quantile(0.5).alias("median_value"), F.lit(True).alias("_now")
    )
    past = merged(known.filter(~is_last)).select(
        *by, F.col("n_keys").alias("known_keys"), quantile(tail).alias("low_value"),
        quantile(1 - tail).alias("high_value"), F.lit(True).alias("_past"),
    )
    inside = F.col("median_value").between(F.col("low_value"), F.col("high_value"))
    status = (
        F.when(F.col("_past").isNull(), "NEW").when(F.col("_now").isNull(), "GONE")
        .when(~inside, "SHIFTED").otherwise("PASS")
    )
    both = now.join(past, list(by), "full_outer").withColumn("status", status)
    return both.drop("_now", "_past")
