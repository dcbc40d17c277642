"""Projections, filters, derived columns, contracts, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.catalog import inputs as I
from snapmart.catalog.registry import query, sql
from snapmart.operators import clean
from snapmart.tables.zones import transformed_path


@query(
    "require_fields",
    sql(
        """SELECT event_id, country_code, year, carbon FROM fp
        WHERE country_code <> 0 AND year <> 0 AND carbon <> 0""",
        "fp",
    ),
)
def require_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.require_fields(I.facts(spark, sf), ["country_code", "year", "carbon"])
    return rows.select("event_id", "country_code", "year", "carbon")


@query(
    "require_country_fields",
    sql(
        """SELECT country_code, country_name FROM countries
        WHERE country_code <> 0 AND country_name <> ''""",
        "countries",
    ),
)
def require_country_fields(spark: SparkSession, sf: str) -> DataFrame:
    return clean.require_country_fields(I.countries(spark, sf)).select(
        "country_code", "country_name"
    )


@query(
    "default_record_type",
    sql(
        """SELECT event_id, CASE WHEN record_type = 'EFConsCarbonGHA' THEN 'unknown'
        ELSE record_type END AS record_type FROM fp""",
        "fp",
    ),
)
def default_record_type(spark: SparkSession, sf: str) -> DataFrame:
    known = F.nullif("record_type", F.lit("EFConsCarbonGHA"))
    rows = I.facts(spark, sf).select("event_id", known.alias("record_type"))
    return clean.default_record_type(rows)


@query(
    "stamp_transformed",
    sql("SELECT event_id, TIMESTAMP '2024-01-31' AS transformed_at FROM fp", "fp"),
)
def stamp_transformed(spark: SparkSession, sf: str) -> DataFrame:
    return clean.stamp_transformed(I.facts(spark, sf), I.as_of()).select(
        "event_id", "transformed_at"
    )


@query("carbon_pct", sql("SELECT event_id, carbon_pct_of_total FROM fp", "fp"))
def carbon_pct(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.facts(spark, sf).drop("carbon_pct_of_total")
    return clean.carbon_pct(rows).select("event_id", "carbon_pct_of_total")


@query(
    "scale_round",
    "SELECT o_orderkey, round(o_totalprice / 1e6, 2) AS value_million FROM orders",
)
def scale_round(spark: SparkSession, sf: str) -> DataFrame:
    scaled = clean.scale_round(F.col("o_totalprice")).alias("value_million")
    return I.table(spark, sf, "orders").select("o_orderkey", scaled)


@query(
    "schema_evolve",
    sql(
        """SELECT event_id, year, value, CAST(NULL AS VARCHAR) AS score FROM fp
        WHERE hour(_loaded_at) < 12
        UNION ALL SELECT event_id, year, NULL AS value, score FROM fp
        WHERE hour(_loaded_at) >= 12""",
        "fp",
    ),
)
def schema_evolve(spark: SparkSession, sf: str) -> DataFrame:
    """The later load has a new column, lacks one, and carries years as text."""
    rows = I.facts(spark, sf)
    old = rows.filter(F.hour("_loaded_at") < 12).select("event_id", "year", "value")
    new = rows.filter(F.hour("_loaded_at") >= 12).select(
        "event_id", F.col("year").cast("string").alias("year"), "score"
    )
    return clean.schema_evolve(old, new)


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Countries whose code is text, sometimes no number, and whose name may be null."""
    code = F.col("country_code").cast("string")
    return I.countries(spark, sf).select(
        F.col("country_code").alias("id"),
        F.when(F.col("segment") == "MACHINERY", "all").otherwise(code).alias("country_code"),
        F.nullif("country_name", F.lit("")).alias("country_name"),
    )


@query(
    "contract_enforce",
    sql(
        """SELECT side, reasons, count(*) AS n FROM (
        SELECT concat_ws(', ',
          CASE WHEN segment = 'MACHINERY' THEN 'country_code: not bigint' END,
          CASE WHEN country_name = '' THEN 'country_name: null' END) AS reasons,
          CASE WHEN segment = 'MACHINERY' OR country_name = '' THEN 'bad' ELSE 'good' END AS side
        FROM countries) AS x GROUP BY side, reasons""",
        "countries",
    ),
)
def contract_enforce(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = clean.contract_enforce(_mixed(spark, sf), schemas.COUNTRIES)
    sides = good.select(F.lit("good").alias("side"), F.lit("").alias("reasons")).unionByName(
        bad.select(F.lit("bad").alias("side"), F.array_join("_reasons", ", ").alias("reasons"))
    )
    return sides.groupBy("side", "reasons").agg(F.count("*").alias("n"))


def rules() -> dict:
    """What sends an event to quarantine."""
    return {
        "no country": F.col("country_code") == 0,
        "no carbon": F.col("carbon") == 0,
        "small value": F.col("value") < 1,
    }


@query(
    "quarantine_split",
    sql(
        """SELECT event_id, reasons <> '' AS quarantined, reasons FROM (
        SELECT event_id, concat_ws(', ', CASE WHEN country_code = 0 THEN 'no country' END,
          CASE WHEN carbon = 0 THEN 'no carbon' END,
          CASE WHEN value < 1 THEN 'small value' END) AS reasons FROM fp) AS x""",
        "fp",
    ),
)
def quarantine_split(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = clean.quarantine_split(I.facts(spark, sf), rules())
    kept = good.select("event_id", F.lit(False).alias("quarantined"), F.lit("").alias("reasons"))
    return kept.unionByName(
        bad.select(
            "event_id",
            F.lit(True).alias("quarantined"),
            F.array_join("_reasons", ", ").alias("reasons"),
        )
    )


@query(
    "scalar_pack",
    """SELECT event_id, trim('  ' || event_type || ' ') AS trimmed,
    regexp_matches(event_type, '^(view|click)$') AS matched,
    event_type || '/' || user_id AS joined,
    regexp_replace(event_type || '.json', '[.]json$', '_transformed.json') AS renamed,
    event_type LIKE '%ro%' AS contains_ro,
    suffix(event_type, 'r') AS ends_in_r,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start,
    nullif(event_type, 'view') AS not_view,
    TRY_CAST(event_type AS BIGINT) AS no_number,
    value BETWEEN 10 AND 20 AS mid_value,
    date_diff('minute', ts, TIMESTAMP '2024-01-31') AS minutes_to
    FROM events""",
)
def scalar_pack(spark: SparkSession, sf: str) -> DataFrame:
    """The scalar functions no other query uses."""
    from snapmart.functions import boundary_diff, safe_long

    kind = F.col("event_type")
    return I.table(spark, sf, "events").select(
        "event_id",
        F.trim(F.concat(F.lit("  "), kind, F.lit(" "))).alias("trimmed"),
        kind.rlike("^(view|click)$").alias("matched"),
        F.concat(kind, F.lit("/"), F.col("user_id").cast("string")).alias("joined"),
        F.regexp_replace(
            F.concat(kind, F.lit(".json")), "[.]json$", transformed_path(".json")
        ).alias("renamed"),
        kind.like("%ro%").alias("contains_ro"),
        kind.endswith("r").alias("ends_in_r"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"),
        F.nullif(kind, F.lit("view")).alias("not_view"),
        safe_long(kind).alias("no_number"),
        F.col("value").between(10, 20).alias("mid_value"),
        boundary_diff("minute", F.col("ts"), I.as_of()).alias("minutes_to"),
    )
