"""The given tables in the shapes the operators read: facts, countries, returns, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.catalog.registry import AS_OF
from snapmart.operators.dedupe import dedupe_latest
from snapmart.operators.marts import mart_summary
from snapmart.session import scratch_path
from snapmart.sources.landed import calendar_flags
from snapmart.tables.layout import cluster_layout
from snapmart.tables.store import shaped

# Event types as record types.
RECORD_TYPE_OF = {
    "view": "EFConsTotGHA",
    "click": "BiocapTotGHA",
    "purchase": "EFConsPerCap",
    "signup": "BiocapPerCap",
}
OTHER_TYPE = "EFConsCarbonGHA"


def as_of(text: str = AS_OF) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _record_type() -> Column:
    col = None
    for event, name in RECORD_TYPE_OF.items():
        hit = F.col("event_type") == event
        col = F.when(hit, name) if col is None else col.when(hit, name)
    return col.otherwise(OTHER_TYPE)


def _letter(number: Column) -> Column:
    return F.char(F.lit(65) + number % 26)


def year_of(ts: Column) -> Column:
    return (F.lit(2000) + F.day(ts)).cast("bigint")


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Events as fact rows: user as country, day as year, event type as record type."""
    return facts_of(table(spark, sf, "events"))


def facts_of(events: DataFrame, *keep: str) -> DataFrame:
    events = events.withColumn("k", F.get_json_object("props", "$.k").try_cast("double"))
    user, value, k, ts = F.col("user_id"), F.col("value"), F.col("k"), F.col("ts")
    later = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=k.cast("int"))
    return events.select(
        "event_id",
        user.alias("country_code"),
        F.concat(F.lit("C"), user.cast("string")).alias("country_name"),
        F.concat(F.lit("c"), user.cast("string")).alias("short_name"),
        F.concat(_letter(user), _letter(F.floor(user / 26))).alias("iso_alpha2"),
        year_of(ts).alias("year"),
        _record_type().alias("record_type"),
        (value * 0.25).alias("crop_land"),
        (value * 0.125).alias("grazing_land"),
        (value * 0.5).alias("forest_land"),
        (value * 0.0625).alias("fishing_ground"),
        (k * 0.03125).alias("builtup_land"),
        k.alias("carbon"),
        "value",
        F.when(k >= 50, "3A").otherwise("2B").alias("score"),
        F.when(value > 0, F.round(k / value * 100, 2)).alias("carbon_pct_of_total"),
        F.date_trunc("day", ts).cast("timestamp_ntz").alias("extracted_at"),
        F.when(k >= 5, later).alias("transformed_at"),
        ts.alias("_loaded_at"),
        F.concat(F.lit("load_"), F.date_format(ts, "yyyyMMdd"), F.lit(".json")).alias(
            "_source_file"
        ),
        F.col("event_id").alias("_row_number"),
        *keep,
    )


def _staged(rows: DataFrame) -> DataFrame:
    latest = dedupe_latest(rows, tie_break=["_row_number"])
    return latest.withColumn("_updated_at", F.col("_loaded_at"))


def staging(spark: SparkSession, sf: str) -> DataFrame:
    return _staged(facts(spark, sf))


def stored(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Rows written once by year and read back, for queries that read them more than once."""
    path = scratch_path(spark, label)
    cluster_layout(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


def stored_staging(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, staging(spark, sf), "staging")


def morning(spark: SparkSession, sf: str) -> DataFrame:
    """What was loaded before noon, deduplicated: the target of the merge queries."""
    return _staged(facts(spark, sf).filter(F.hour("_loaded_at") < 12))


def afternoon(spark: SparkSession, sf: str) -> DataFrame:
    """What was loaded after noon, deduplicated: the source of the merge queries."""
    return _staged(facts(spark, sf).filter(F.hour("_loaded_at") >= 12))


def staging_columns(df: DataFrame) -> DataFrame:
    return shaped(df, schemas.STAGING)


def lagging_mart(staged: DataFrame) -> DataFrame:
    """A mart that has not seen the last days."""
    return mart_summary(staged.filter(F.col("_loaded_at") < "2024-01-20"))


def countries(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as countries; those in debt have an empty name."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.select(
        F.col("c_custkey").alias("country_code"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name")).alias("country_name"),
        F.col("n_name").alias("short_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def landed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as landed records, under the field names of the source; times are text."""
    rows = facts(spark, sf)
    fields = [F.col(c).alias(f) for c, f in schemas.RECORD_FIELDS.items()]
    times = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
        for c in ("extracted_at", "transformed_at")
    ]
    return rows.select(*fields, "carbon_pct_of_total", *times, "event_id", "_loaded_at")


def landed_lines(spark: SparkSession, sf: str) -> str:
    """The landed records as JSON Lines below the shared folder."""
    path = scratch_path(spark, "landed")
    landed_records(spark, sf).drop("event_id", "_loaded_at").write.json(path)
    return path


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as job runs of ten seconds per unit of k; error events are failed runs."""
    k = F.get_json_object("props", "$.k")
    failed = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.upper("event_type").alias("stage"),
        F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.col("ts").alias("scheduled_time"),
        (F.col("ts") + F.make_dt_interval(secs=k.try_cast("int") * 10)).alias("completed_time"),
        F.when(failed, F.concat(F.lit("E"), k)).alias("error_code"),
    )


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(
        F.concat(F.lit("F"), F.col("l_linenumber").cast("string")).alias("fund_code"),
        F.col("l_shipdate").cast("date").alias("market_date"),
        F.col("l_returnflag").alias("return_type"),
    )


def perf(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as daily returns of a fund per line number; some are unknown."""
    unknown = (F.max("l_quantity") > 48) & (F.min("l_quantity") > 47)
    value = F.when(~unknown, F.max("l_discount") - F.lit(0.05))
    return _daily(spark, sf).agg(value.alias("daily_return"))


def odd_perf(spark: SparkSession, sf: str) -> DataFrame:
    """Daily returns of which some are below -1."""
    value = F.max("l_discount") - F.lit(0.05)
    low = F.min("l_quantity") < 2
    return _daily(spark, sf).agg(F.when(low, value - 1).otherwise(value).alias("daily_return"))


def calendar_feed(spark: SparkSession, sf: str) -> DataFrame:
    """One calendar row per order: the same date many times."""
    return table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """The dates orders were placed on, with flags."""
    days = calendar_feed(spark, sf).distinct()
    holiday = F.date_format("date", "MM-dd").isin("01-01", "05-01", "12-25")
    iso_day = F.weekday("date") + 1
    working = (iso_day <= 5) | ((iso_day == 6) & (F.day("date") == 15))
    return calendar_flags(days, holiday, working)
