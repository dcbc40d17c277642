"""Readers: what the given tables look like after landing them as files and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.catalog import inputs as I
from snapmart.catalog.registry import query, sql
from snapmart.operators import clean
from snapmart.session import scratch_path
from snapmart.sources import drift, landed, variant
from snapmart.tables.layout import cluster_layout

FACT_COLUMNS = [
    "country_code", "country_name", "iso_alpha2", "year", "record_type", "crop_land", "carbon",
    "value", "score",
]
FACT_LIST = ", ".join(FACT_COLUMNS)


@query(
    "read_envelope",
    sql(
        f"""SELECT {FACT_LIST}, row_number() OVER (PARTITION BY event_id // 5 ORDER BY event_id)
        AS _row_number FROM fp""",
        "fp",
    ),
)
def read_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Up to five events in a document, which is an envelope or a bare array, flattened again."""
    records = I.landed_records(spark, sf)
    fields = list(schemas.RECORD_FIELDS.values())
    group = F.floor(F.col("event_id") / 5).alias("group")
    docs = records.groupBy(group).agg(
        F.array_sort(F.collect_list(F.struct("event_id", F.struct(*fields).alias("r")))).alias("rs")
    )
    several = F.transform("rs", lambda x: x["r"])
    envelope = F.struct(
        several.alias("footprint_data"), F.array(F.struct(F.lit(1).alias("countryCode"))).alias("countries")
    )
    text = F.when(F.col("group") % 2 == 0, F.to_json(envelope)).otherwise(F.to_json(several))
    path = scratch_path(spark, "envelopes")
    docs.select(text.alias("value")).write.text(path)
    rows = landed.read_envelope(spark, path)
    typed = clean.normalise_records(rows, I.as_of(), keep=["_row_number"])
    return typed.select(*FACT_COLUMNS, "_row_number")


@query(
    "read_split_documents",
    sql(
        f"""SELECT {FACT_LIST}, day, row_number() OVER (PARTITION BY day ORDER BY event_id) AS _row_number
        FROM (SELECT *, day(_loaded_at) AS day FROM fp)""",
        "fp",
    ),
)
def read_split_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One document per day of the month, an envelope or a bare array, read by byte ranges.

    Names and notes hold braces, brackets and the section's own key.
    """
    records = I.landed_records(spark, sf).withColumn("day", F.dayofmonth("_loaded_at"))
    by_day = Window.partitionBy("day").orderBy("event_id")
    first = F.lag("event_id").over(by_day).isNull()
    last = F.lead("event_id").over(by_day).isNull()
    fields = F.to_json(F.struct(*schemas.RECORD_FIELDS.values(), F.lit('}], "footprint_data": [{').alias("remark")))
    even = F.col("day") % 2 == 0
    head = '{"metadata": {"note": "]}{[ \\" }"}, "countries": [{"countryCode": 1}], "footprint_data": ['
    line = F.concat(
        F.when(~first, ",").when(even, head).otherwise("["),
        fields,
        F.when(~last, "").when(even, '], "sources": [[{"year": 1}]]}').otherwise("]"),
    )
    path = scratch_path(spark, "documents")
    lines = records.select("day", "event_id", line.alias("value")).sortWithinPartitions("day", "event_id")
    lines.drop("event_id").write.partitionBy("day").text(path)
    rows = landed.read_envelope(spark, path, layout="split")
    day = F.regexp_extract("_source_file", r"day=(\d+)", 1).cast("bigint")
    typed = clean.normalise_records(rows.withColumn("day", day), I.as_of(), keep=["_row_number", "day"])
    return typed.select(*FACT_COLUMNS, "day", "_row_number")


@query(
    "normalise_records",
    sql(f"SELECT {FACT_LIST}, TIMESTAMP '2024-01-31' AS extracted_at FROM fp", "fp"),
)
def normalise_records(spark: SparkSession, sf: str) -> DataFrame:
    """A code of text '0' is a code; only an absent one is not."""
    records = I.landed_records(spark, sf).withColumns(
        {f: F.col(f).cast("string") for f in schemas.RECORD_FIELDS.values()}
    )
    rows = clean.normalise_records(records, I.as_of())
    return rows.select(*FACT_COLUMNS, "extracted_at")


@query(
    "normalise_records_loose",
    sql(f"SELECT {FACT_LIST} FROM fp WHERE country_code <> 0", "fp"),
)
def normalise_records_loose(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric codes, of which 0 counts as missing."""
    records = I.landed_records(spark, sf)
    return clean.normalise_records(records, I.as_of(), parse_code=False).select(*FACT_COLUMNS)


def _landed_countries(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("country_code").cast("string")
    return I.countries(spark, sf).select(
        F.when(F.col("segment") == "MACHINERY", "all").otherwise(code).alias("countryCode"),
        F.col("country_name").alias("countryName"),
        F.col("short_name").alias("shortName"),
        F.lit(None).cast("string").alias("isoa2"),
        F.lit("v1").alias("version"),
        F.col("segment").alias("score"),
    )


@query(
    "normalise_countries",
    sql(
        """SELECT country_code, country_name, short_name, 'v1' AS version, segment AS score
        FROM countries WHERE segment <> 'MACHINERY' AND country_name <> ''""",
        "countries",
    ),
)
def normalise_countries(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.normalise_countries(_landed_countries(spark, sf), I.as_of())
    return rows.select("country_code", "country_name", "short_name", "version", "score")


@query(
    "normalise_countries_any_code",
    sql(
        """SELECT CASE WHEN segment = 'MACHINERY' THEN 'all' ELSE CAST(country_code AS VARCHAR) END
        AS country_code, country_name, short_name FROM countries""",
        "countries",
    ),
)
def normalise_countries_any_code(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.normalise_countries(_landed_countries(spark, sf), I.as_of(), numeric_only=False)
    return rows.select("country_code", "country_name", "short_name")


@query(
    "extract_years",
    sql(f"SELECT event_id, {FACT_LIST} FROM fp WHERE year BETWEEN 2005 AND 2012", "fp"),
)
def extract_years(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "years")
    rows = I.facts(spark, sf).select("event_id", *FACT_COLUMNS)
    cluster_layout(rows, path)
    return landed.read_years(spark, path, 2005, 2012, rows.schema)


@query(
    "extract_filtered",
    sql(
        """SELECT event_id, record_type, value FROM fp
        WHERE record_type IN ('EFConsTotGHA', 'BiocapTotGHA')""",
        "fp",
    ),
)
def extract_filtered(spark: SparkSession, sf: str) -> DataFrame:
    rows = landed.filter_types(I.facts(spark, sf), ["EFConsTotGHA", "BiocapTotGHA"])
    return rows.select("event_id", "record_type", "value")


@query(
    "extract_filtered_by_table",
    sql(
        """SELECT event_id, record_type, value FROM fp WHERE record_type IN
        (SELECT record_type FROM fp GROUP BY record_type HAVING max(value) > 100)""",
        "fp",
    ),
)
def extract_filtered_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """The wanted types come from a query, so they are semi-joined."""
    rows = I.facts(spark, sf)
    wanted = rows.groupBy("record_type").agg(F.max("value").alias("top")).filter("top > 100")
    return landed.filter_types(rows, wanted).select("event_id", "record_type", "value")


@query("read_csv_typed", sql("SELECT * FROM perf", "perf"))
def read_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "perf-csv")
    feed = I.perf(spark, sf).withColumnRenamed("return_type", "retunr_type")
    feed.write.option("header", True).csv(path)
    return landed.read_perf_daily(spark, path)


@query("calendar_source", sql("SELECT date, day_of_week, is_holiday, is_working_day FROM cal", "cal"))
def calendar_source(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "calendar-csv")
    I.calendar(spark, sf).write.option("header", True).csv(path)
    rows = landed.read_calendar(spark, path)
    return rows.select("date", "day_of_week", "is_holiday", "is_working_day")


@query(
    "copy_into_typed",
    sql(
        f"SELECT {FACT_LIST}, transformed_at, TRUE AS has_source FROM fp",
        "fp",
    ),
)
def copy_into_typed(spark: SparkSession, sf: str) -> DataFrame:
    docs = variant.land_variant(spark, I.landed_lines(spark, sf))
    kinds = {f.name: f.dataType.simpleString() for f in schemas.RAW}
    mapping = {
        c: (f"$.{schemas.RECORD_FIELDS.get(c, c)}", kinds[c])
        for c in [*FACT_COLUMNS, "transformed_at"]
    }
    rows = variant.copy_into_typed(docs, mapping)
    return rows.withColumn("has_source", F.col("_source_file").isNotNull()).drop("_source_file")


@query(
    "variant_project",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def variant_project(spark: SparkSession, sf: str) -> DataFrame:
    events = I.table(spark, sf, "events")
    return variant.variant_project(events, {"k": ("$.k", "bigint")}, "props", ["event_id"])


@query(
    "copy_into_legacy",
    sql(
        """SELECT country_code, country_name, iso_alpha2, year, carbon AS carbon_footprint_gha,
        value AS total_footprint_gha, score,
        CASE WHEN record_type <> 'EFConsCarbonGHA' THEN _loaded_at END AS extracted_at,
        _source_file FROM fp""",
        "fp",
    ),
)
def copy_into_legacy(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction times of one type are text that is no time."""
    loaded = F.date_format("_loaded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    at = F.when(F.col("record_type") == "EFConsCarbonGHA", "soon").otherwise(loaded)
    document = F.to_json(
        F.struct(
            "country_code", "country_name", "iso_alpha2", "year", "score",
            F.col("carbon").alias("carbon_footprint_gha"),
            F.col("value").alias("total_footprint_gha"),
            at.alias("extracted_at"),
        )
    )
    docs = I.facts(spark, sf).select(document.alias("raw_data"), "_source_file")
    return variant.copy_into_legacy(docs, F.col("_source_file"))


@query(
    "land_variant",
    sql("SELECT country_code, year, value, TRUE AS has_source FROM fp", "fp"),
)
def land_variant(spark: SparkSession, sf: str) -> DataFrame:
    docs = variant.land_variant(spark, I.landed_lines(spark, sf))
    mapping = {
        "country_code": ("$.countryCode", "bigint"),
        "year": ("$.year", "bigint"),
        "value": ("$.value", "double"),
    }
    rows = variant.variant_project(docs, mapping, keep=["_source_file"])
    return rows.withColumn("has_source", F.col("_source_file").isNotNull()).drop("_source_file")


@query(
    "coalesce_aliases",
    sql("SELECT event_id, record_type, crop_land, forest_land FROM fp", "fp"),
)
def coalesce_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Morning loads use new field names, afternoon loads the old ones."""
    rows = I.facts(spark, sf).select(
        "event_id", "_loaded_at", "record_type", "crop_land", "forest_land"
    )
    new = rows.filter(F.hour("_loaded_at") < 12)
    old = rows.filter(F.hour("_loaded_at") >= 12).withColumnsRenamed(
        {"record_type": "record", "crop_land": "cropLand", "forest_land": "forestLand"}
    )
    both = new.unionByName(old, allowMissingColumns=True).drop("_loaded_at")
    aliases = {
        "record_type": ["record_type", "record"],
        "crop_land": ["crop_land", "cropLand"],
        "forest_land": ["forest_land", "forestLand"],
    }
    return clean.coalesce_aliases(both, aliases)


@query(
    "read_latest_snapshot",
    sql(
        f"""SELECT event_id, {FACT_LIST} FROM fp
        WHERE strftime(_loaded_at, '%Y%m%d') = (SELECT max(strftime(_loaded_at, '%Y%m%d')) FROM fp)""",
        "fp",
    ),
)
def read_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "snapshots")
    name = F.date_format("_loaded_at", "yyyyMMdd")
    rows = I.facts(spark, sf).select("event_id", *FACT_COLUMNS, name.alias("snapshot"))
    rows.write.partitionBy("snapshot").parquet(path)
    return landed.read_latest_snapshot(spark, path).drop("snapshot")


_DRIFTED = "CASE WHEN hour(ts) < 12 THEN 'BIGINT' ELSE 'STRING' END"


def _drifting(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON records whose field k is a number in the morning and a text in the afternoon."""
    events = I.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").try_cast("long")
    early = F.hour("ts") < 12
    old = F.to_json(F.struct("event_id", k.alias("k"), F.lit(None).cast("string").alias("note")))
    new = F.to_json(F.struct("event_id", F.concat(F.lit("k"), k.cast("string")).alias("k"), F.col("event_type").alias("note")))
    path = scratch_path(spark, "drift")
    events.select(F.when(early, old).otherwise(new).alias("value")).write.text(path)
    return variant.land_variant(spark, path)


@query(
    "type_drift",
    f"""SELECT 'k' AS field, {_DRIFTED} AS kind, CAST(count(*) AS BIGINT) AS rows, 'bigint' AS declared,
    TRUE AS drifted FROM events GROUP BY ALL
    UNION ALL SELECT 'event_id', 'BIGINT', CAST(count(*) AS BIGINT), 'bigint', FALSE FROM events
    UNION ALL SELECT 'note', 'STRING', CAST(count(*) AS BIGINT), NULL, FALSE FROM events WHERE hour(ts) >= 12""",
)
def type_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The types fields really have; one has turned from number to text."""
    return drift.drift_report(_drifting(spark, sf), {"k": "bigint", "event_id": "bigint"})


@query(
    "type_misfits",
    """SELECT event_id, 'k: not bigint' AS reasons FROM events WHERE hour(ts) >= 12""",
)
def type_misfits(spark: SparkSession, sf: str) -> DataFrame:
    """Records put aside because the declared type does not hold their value."""
    bad = drift.split_misfits(_drifting(spark, sf), {"k": "bigint", "event_id": "bigint"})[1]
    id_ = F.try_variant_get("raw_data", "$.event_id", "bigint")
    return bad.select(id_.alias("event_id"), F.array_join("_reasons", ", ").alias("reasons"))
