"""Deduplication and merges: the morning load is the target, the afternoon load the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.catalog import inputs as I
from snapmart.catalog.registry import AS_OF, mart_sql, query, sql
from snapmart.operators import dedupe
from snapmart.operators import merge as M
from snapmart.operators.marts import mart_summary
from snapmart.session import scratch_path
from snapmart.tables import backfill, store

KEY = "country_code, year, record_type"
CHANGED = ["country_name", "iso_alpha2", "carbon", "value", "score", "transformed_at"]
NEWER = "(a.transformed_at > m.transformed_at OR m.transformed_at IS NULL)"


def merge_sql(update_when: str, keep_load_time: bool = True) -> str:
    """The merge as a full join over the two loads."""
    action = f"""CASE WHEN m.event_id IS NULL THEN 'insert'
      WHEN a.event_id IS NOT NULL AND {update_when} THEN 'update' ELSE 'keep' END"""
    keys = ", ".join(f"coalesce(m.{k}, a.{k}) AS {k}" for k in schemas.FACT_KEY)
    values = ", ".join(
        f"CASE WHEN act = 'keep' THEN m_{c} ELSE a_{c} END AS {c}" for c in CHANGED
    )
    both = ", ".join(f"m.{c} AS m_{c}, a.{c} AS a_{c}" for c in [*CHANGED, "_loaded_at"])
    source_time = "act = 'insert'" if keep_load_time else "act <> 'keep'"
    return f"""SELECT {KEY}, {values},
      CASE WHEN {source_time} THEN a__loaded_at ELSE m__loaded_at END AS _loaded_at,
      CASE WHEN act = 'keep' THEN m_updated ELSE TIMESTAMP '{AS_OF}' END AS _updated_at,
      act AS _action
    FROM (SELECT {keys}, {both}, m._updated_at AS m_updated, {action} AS act
      FROM morning AS m FULL JOIN afternoon AS a ON m.country_code = a.country_code
        AND m.year = a.year AND m.record_type = a.record_type) AS j"""


OUTPUT = [*schemas.FACT_KEY, *CHANGED, "_loaded_at", "_updated_at", "_action"]


def _loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return I.staging_columns(I.morning(spark, sf)), I.staging_columns(I.afternoon(spark, sf))


@query(
    "dedupe_first",
    sql(
        f"""SELECT event_id, {KEY}, value FROM (SELECT *, row_number() OVER
        (PARTITION BY {KEY} ORDER BY _source_file, _row_number) AS rn FROM fp) AS x WHERE rn = 1""",
        "fp",
    ),
)
def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    order = ["_source_file", "_row_number"]
    rows = dedupe.dedupe_first(I.facts(spark, sf), schemas.FACT_KEY, order)
    return rows.select("event_id", *schemas.FACT_KEY, "value")


@query(
    "dedupe_countries",
    sql(
        """SELECT event_id, country_code, country_name FROM (SELECT *, row_number() OVER
        (PARTITION BY country_code ORDER BY _row_number) AS rn FROM fp WHERE country_code <> 0)
        AS x WHERE rn = 1""",
        "fp",
    ),
)
def dedupe_countries(spark: SparkSession, sf: str) -> DataFrame:
    rows = dedupe.dedupe_countries(I.facts(spark, sf), ["_row_number"])
    return rows.select("event_id", "country_code", "country_name")


@query(
    "dedupe_latest",
    sql(f"SELECT event_id, {KEY}, value, transformed_at, _loaded_at FROM stg", "stg"),
)
def dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = dedupe.dedupe_latest(I.facts(spark, sf), tie_break=["_row_number"])
    return rows.select("event_id", *schemas.FACT_KEY, "value", "transformed_at", "_loaded_at")


@query(
    "dedupe_stats",
    sql(
        f"""SELECT CAST(count(*) AS BIGINT) AS rows_in,
        CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS invalid,
        CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS valid,
        (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT {KEY} FROM fp
          WHERE country_code <> 0 AND carbon <> 0) AS d) AS kept,
        CAST(count(*) FILTER (WHERE ok) AS BIGINT) - (SELECT count(*) FROM (SELECT DISTINCT {KEY}
          FROM fp WHERE country_code <> 0 AND carbon <> 0) AS d) AS duplicates
        FROM (SELECT *, country_code <> 0 AND carbon <> 0 AS ok FROM fp) AS x""",
        "fp",
    ),
)
def dedupe_stats(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.dedupe_stats(I.facts(spark, sf), ["country_code", "carbon"])


@query("merge_newer_wins", sql(merge_sql(NEWER), "morning", "afternoon"))
def merge_newer_wins(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _loads(spark, sf)
    return M.merge_newer_wins(target, source, as_of=I.as_of()).select(*OUTPUT)


@query("merge_newer_wins_small_source", sql(merge_sql(NEWER), "morning", "afternoon"))
def merge_newer_wins_small_source(spark: SparkSession, sf: str) -> DataFrame:
    """The way taken for a source that has been counted, measured and found small."""
    target, source = _loads(spark, sf)
    table = store.fact_table(scratch_path(spark, "merged"))
    store.load_replace(target, table)
    staged = store.stage(source, table)
    merged = M.merge_newer_wins(
        store.read_table(spark, table), staged.rows, as_of=I.as_of(), small_source=staged.small
    )
    return merged.select(*OUTPUT)


@query("merge_upsert", sql(merge_sql("TRUE", keep_load_time=False), "morning", "afternoon"))
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _loads(spark, sf)
    return M.merge_upsert(target, source, schemas.FACT_KEY, I.as_of()).select(*OUTPUT)


@query(
    "merge_counts",
    sql(
        f"""SELECT CAST(count(*) FILTER (WHERE _action = 'insert') AS BIGINT) AS inserted,
        CAST(count(*) FILTER (WHERE _action = 'update') AS BIGINT) AS updated,
        CAST(count(*) FILTER (WHERE _action = 'keep') AS BIGINT) AS unchanged
        FROM ({merge_sql(NEWER)}) AS merged""",
        "morning",
        "afternoon",
    ),
)
def merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _loads(spark, sf)
    return M.merge_counts(M.merge_newer_wins(target, source, as_of=I.as_of()))


MART_NAMES = ["country_name", "iso_alpha2", *schemas.MART_METRICS]


@query(
    "merge_mart",
    sql(
        f"""SELECT coalesce(o.country_code, n.country_code) AS country_code,
        coalesce(o.year, n.year) AS year,
        {", ".join(f"CASE WHEN n.year IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in MART_NAMES)},
        CASE WHEN n.year IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '2024-01-20' END
          AS _updated_at
        FROM mart AS o FULL JOIN ({mart_sql("(SELECT * FROM stg WHERE _loaded_at >= TIMESTAMP '2024-01-10')")})
          AS n ON o.country_code = n.country_code AND o.year = n.year""",
        "mart",
    ),
)
def merge_mart(spark: SparkSession, sf: str) -> DataFrame:
    staging = I.stored_staging(spark, sf)
    mart = I.lagging_mart(staging).withColumn("_updated_at", I.as_of("2024-01-20"))
    recent = mart_summary(staging.filter(F.col("_loaded_at") >= "2024-01-10"))
    merged = M.merge_mart(mart, recent.withColumn("_updated_at", I.as_of()), I.as_of())
    return merged.drop(M.ACTION)


def _values_sql() -> str:
    rows = ", ".join(
        f"('{t}', '{d}', '{c}', {str(p).upper()}, '{u}')"
        for t, d, c, p, u in schemas.RECORD_TYPE_ROWS
    )
    return f"(VALUES {rows}) AS v(record_type, description, category, is_per_capita, unit)"


@query(
    "merge_reference",
    sql(
        f"""SELECT coalesce(t.record_type, v.record_type) AS record_type,
        CASE WHEN v.record_type IS NULL THEN t.description ELSE v.description END AS description,
        v.category, v.is_per_capita, v.unit
        FROM (SELECT record_type || '-' || score AS record_type, max(country_name) AS description
          FROM fp GROUP BY 1 UNION ALL SELECT record_type, max(country_name) AS description
          FROM fp GROUP BY 1) AS t
        FULL JOIN {_values_sql()} ON t.record_type = v.record_type""",
        "fp",
    ),
)
def merge_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Types seen in the data, plain and by score, with the fixed rows merged in."""
    rows = I.facts(spark, sf)
    plain = rows.select("record_type", "country_name")
    scored = rows.select(F.concat_ws("-", "record_type", "score").alias("record_type"), "country_name")
    target = (
        plain.unionByName(scored)
        .groupBy("record_type")
        .agg(F.max("country_name").alias("description"))
        .withColumns(
            {
                "category": F.lit(None).cast("string"),
                "is_per_capita": F.lit(None).cast("boolean"),
                "unit": F.lit(None).cast("string"),
            }
        )
    )
    return M.merge_reference(target).drop(M.ACTION)


EVENT_UPDATES = ["carbon_footprint_gha", "score", "extracted_at", "transformed_at"]
EVENT_KEPT = ["country_code", "country_name", "year", "record_type"]


def _keyed(df: DataFrame) -> DataFrame:
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in schemas.FACT_KEY])
    return df.select(
        key.alias("unique_key"), *EVENT_KEPT, F.col("carbon").alias("carbon_footprint_gha"),
        "score", "extracted_at", "transformed_at", "_updated_at", "_row_number",
    )


_KEYED_SQL = f"""SELECT concat_ws('-', {KEY}) AS unique_key, {", ".join(EVENT_KEPT)},
  carbon AS carbon_footprint_gha, score, extracted_at, transformed_at, _row_number"""


@query(
    "merge_insert_events",
    sql(
        f"""SELECT coalesce(t.unique_key, s.unique_key) AS unique_key,
        {", ".join(f"CASE WHEN t.unique_key IS NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in EVENT_KEPT)},
        {", ".join(f"CASE WHEN s.unique_key IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in EVENT_UPDATES)},
        CASE WHEN s.unique_key IS NULL THEN t._updated_at ELSE TIMESTAMP '{AS_OF}' END AS _updated_at
        FROM ({_KEYED_SQL}, _updated_at FROM morning) AS t
        FULL JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY
            transformed_at DESC NULLS LAST, _row_number DESC) AS rn
          FROM ({_KEYED_SQL} FROM fp WHERE hour(_loaded_at) >= 12
            AND record_type <> 'EFConsCarbonGHA') AS k) AS r WHERE rn = 1) AS s
        ON t.unique_key = s.unique_key""",
        "fp",
        "morning",
    ),
)
def merge_insert_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every afternoon row is a change; those of one type are deletes and are ignored."""
    target = _keyed(I.morning(spark, sf)).drop("_row_number")
    later = I.facts(spark, sf).filter(F.hour("_loaded_at") >= 12)
    deleted = F.col("record_type") == "EFConsCarbonGHA"
    changes = _keyed(later.withColumn("_updated_at", F.col("_loaded_at"))).withColumn(
        "change_action", F.when(deleted, "DELETE").otherwise("INSERT")
    )
    merged = M.merge_insert_events(target, changes, as_of=I.as_of())
    return merged.drop(M.ACTION)


@query(
    "rebuild_staging",
    sql(
        f"""SELECT s.country_code, s.year, s.record_type, s.value, s.transformed_at,
        coalesce(m._loaded_at, s._loaded_at) AS _loaded_at, TIMESTAMP '{AS_OF}' AS _updated_at
        FROM stg AS s LEFT JOIN morning AS m ON m.country_code = s.country_code
          AND m.year = s.year AND m.record_type = s.record_type""",
        "stg",
        "morning",
    ),
)
def rebuild_staging(spark: SparkSession, sf: str) -> DataFrame:
    target = I.staging_columns(I.morning(spark, sf))
    raw = I.facts(spark, sf).withColumn("_updated_at", F.lit(None).cast("timestamp_ntz"))
    merged = M.rebuild_staging(raw, target, I.as_of())
    return merged.select(*schemas.FACT_KEY, "value", "transformed_at", "_loaded_at", "_updated_at")


@query(
    "backfill_files",
    """SELECT strftime(ts, '%Y%m%d') AS file_name,
    CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS records_loaded,
    CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS errors,
    CASE WHEN count(*) FILTER (WHERE event_type <> 'error') > 0 THEN 'SUCCESS' ELSE 'FAILED' END
      AS status
    FROM events WHERE strftime(ts, '%Y%m%d') >= '20240110' GROUP BY 1""",
)
def backfill_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files by load day, error events as broken lines; the pattern takes days from the tenth."""
    path = scratch_path(spark, "backfill")
    rows = I.landed_records(spark, sf)
    document = F.to_json(F.struct(*schemas.RECORD_FIELDS.values()))
    broken = F.col("record") == "EFConsCarbonGHA"
    rows.select(
        F.when(broken, F.concat(F.lit('{"cut": '), F.col("countryName"))).otherwise(document).alias("value"),
        F.date_format("_loaded_at", "yyyyMMdd").alias("load"),
    ).write.partitionBy("load").text(path)
    found = backfill.backfill_rows(spark, path, r"load=202401[123]\d/part-.*")
    day = F.regexp_extract("file_name", r"load=(\d+)/", 1)
    return backfill.backfill_report(found.withColumn("file_name", day))


