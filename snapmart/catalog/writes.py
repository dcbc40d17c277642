"""Table writes, read back: each query lands the given tables and returns what a reader sees."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schemas
from snapmart.catalog import inputs as I
from snapmart.catalog.merges import KEY, NEWER, OUTPUT, merge_sql
from snapmart.catalog.registry import SQL, mart_sql, query, sql
from snapmart.operators import clean
from snapmart.operators import merge as M
from snapmart.operators.marts import mart_summary
from snapmart.session import scratch_path
from snapmart.tables import changes, compact, layout, ledger, sets, state, store, zones

AT = datetime(2024, 1, 31)
ROW = "event_id, country_code, year, record_type, value"
COLUMNS = ROW.split(", ")
ALL_FACTS = sql(f"SELECT {ROW} FROM fp", "fp")


@query("write_raw_snapshot", sql("SELECT country_code, year, value, _loaded_at FROM fp", "fp"))
def write_raw_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.facts(spark, sf).select("country_code", "year", "value", "_loaded_at")
    done = zones.write_raw_snapshot(rows, scratch_path(spark, "zones"), AT)
    return spark.read.schema(rows.schema).json(done["path"])


@query("write_staged", ALL_FACTS)
def write_staged(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "zones")
    done = zones.write_staged(I.facts(spark, sf).select(*COLUMNS), root, AT)
    return zones.read_staged(spark, root, done["snapshot"])


@query("write_transformed", sql(f"SELECT {ROW}, TRUE AS has_lineage FROM fp", "fp"))
def write_transformed(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.facts(spark, sf).select(*COLUMNS)
    source = f"{scratch_path(spark, 'zones')}/raw/facts.json"
    done = zones.write_transformed(rows, source, AT)
    back = spark.read.schema(rows.schema.add("_source_key", "string")).json(done["path"])
    return back.withColumn("has_lineage", F.col("_source_key") == source).drop("_source_key")


@query(
    "partitioned_layout",
    sql(f"SELECT {ROW.replace('year', 'year AS data_year')}, strftime(_loaded_at, '%Y-%m-%d') AS folder FROM fp", "fp"),
)
def partitioned_layout(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.facts(spark, sf).select(*COLUMNS, "_loaded_at")
    path = layout.partitioned_layout(rows, scratch_path(spark, "zones"), "raw", "_loaded_at")
    back = spark.read.parquet(path)
    parts = [F.lpad(F.col(p).cast("string"), n, "0") for p, n in zip(layout.DAY_PARTS, (4, 2, 2))]
    return back.withColumn("folder", F.concat_ws("-", *parts)).drop("_loaded_at", *layout.DAY_PARTS)


@query(
    "expire_partitions",
    sql(
        f"""SELECT {ROW.replace('year', 'year AS data_year')} FROM fp
        WHERE CAST(_loaded_at AS DATE) >= DATE '2024-01-31' - INTERVAL 30 DAY + INTERVAL 15 DAY""",
        "fp",
    ),
)
def expire_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Thirty days are kept, seen from fifteen days later."""
    root = scratch_path(spark, "zones")
    rows = I.facts(spark, sf).select(*COLUMNS, "_loaded_at")
    path = layout.partitioned_layout(rows, root, "processed", "_loaded_at")
    zones.expire_partitions(spark, root, "processed", date(2024, 2, 15))
    return spark.read.parquet(path).drop("_loaded_at", *layout.DAY_PARTS)


@query(
    "write_zones",
    sql(
        f"""SELECT {ROW}, CASE WHEN country_code = 0 OR carbon = 0 OR value < 1 THEN 'failed'
        ELSE 'good' END AS zone FROM fp""",
        "fp",
    ),
)
def write_zones(spark: SparkSession, sf: str) -> DataFrame:
    from snapmart.catalog.cleaning import rules

    flagged = clean.flag_reasons(I.facts(spark, sf), rules()).select(*COLUMNS, "_reasons")
    path = layout.write_zones(flagged, scratch_path(spark, "zones"))
    return spark.read.parquet(path).drop("_reasons")


@query("cluster_layout", ALL_FACTS)
def cluster_layout(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "clustered")
    rows = I.facts(spark, sf).select(*COLUMNS)
    layout.cluster_layout(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


def _raw_table(spark: SparkSession, rows: DataFrame) -> store.Table:
    schema = rows.withColumn("_loaded_at", I.as_of()).schema
    return store.Table(scratch_path(spark, "raw"), schema, schemas.FACT_KEY, "year", ["country_code"])


@query(
    "load_append",
    sql(
        f"""SELECT {ROW}, CASE WHEN hour(_loaded_at) < 12 THEN TIMESTAMP '2024-01-30'
        ELSE TIMESTAMP '2024-01-31' END AS _loaded_at FROM fp""",
        "fp",
    ),
)
def load_append(spark: SparkSession, sf: str) -> DataFrame:
    """The morning rows, then the afternoon rows."""
    rows = I.facts(spark, sf)
    early = F.hour("_loaded_at") < 12
    table = _raw_table(spark, rows.select(*COLUMNS))
    store.load_append(rows.filter(early).select(*COLUMNS), table, datetime(2024, 1, 30))
    store.load_append(rows.filter(~early).select(*COLUMNS), table, datetime(2024, 1, 31))
    return store.read_table(spark, table)


@query("load_replace", sql(f"SELECT {ROW} FROM fp WHERE hour(_loaded_at) >= 12", "fp"))
def load_replace(spark: SparkSession, sf: str) -> DataFrame:
    """The second load takes the place of the first."""
    rows = I.facts(spark, sf)
    early = F.hour("_loaded_at") < 12
    schema = rows.select(*COLUMNS).schema
    table = store.Table(scratch_path(spark, "replaced"), schema, ["event_id", "year"], "year")
    store.load_replace(rows.filter(early).select(*COLUMNS), table)
    store.load_replace(rows.filter(~early).select(*COLUMNS), table)
    return store.read_table(spark, table)


_PART = "CASE WHEN k < 5 THEN NULL ELSE record_type || '/' || hour(_loaded_at) || ':%' END"


@query(
    "load_replace_text_partitions",
    sql(
        f"""SELECT event_id, {_PART} AS part, value FROM
        (SELECT *, carbon AS k FROM fp WHERE event_id % 3 > 0) AS x""",
        "fp",
    ),
)
def load_replace_text_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Partition names that need escaping, and none: replaced twice, no partition is lost."""
    part = F.concat("record_type", F.lit("/"), F.hour("_loaded_at").cast("string"), F.lit(":%"))
    rows = I.facts(spark, sf).select(
        "event_id", F.when(F.col("carbon") >= 5, part).alias("part"), "value"
    )
    table = store.Table(scratch_path(spark, "parts"), rows.schema, ["event_id", "part"], "part")
    store.load_replace(rows, table)
    store.load_replace(rows.filter("event_id % 3 > 0"), table)
    return store.read_table(spark, table)


@query("load_merge_repeated_keys", sql(f"SELECT {KEY}, value, carbon, transformed_at FROM stg", "stg"))
def load_merge_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Every landed row of every key in one source, twice: one row per key is stored."""
    rows = I.staging_columns(I.facts(spark, sf).withColumn("_updated_at", I.as_of()))
    table = store.fact_table(scratch_path(spark, "merged"))
    for _ in range(2):
        store.load_merge(rows, table, order=["transformed_at", "_loaded_at"])
    return store.read_table(spark, table).select(*schemas.FACT_KEY, "value", "carbon", "transformed_at")


@query(
    "load_replace_reference",
    sql(
        """SELECT country_code, country_name, short_name FROM countries
        WHERE segment = 'BUILDING'""",
        "countries",
    ),
)
def load_replace_reference(spark: SparkSession, sf: str) -> DataFrame:
    """An unpartitioned table gets a new version; readers see only the newest."""
    rows = I.countries(spark, sf)
    names = ["country_code", "country_name", "short_name"]
    table = store.Table(scratch_path(spark, "countries"), rows.select(*names).schema, names[:1])
    store.load_replace(rows.select(*names), table)
    store.load_replace(rows.filter("segment = 'BUILDING'").select(*names), table)
    return store.read_table(spark, table)


def _loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return I.staging_columns(I.morning(spark, sf)), I.staging_columns(I.afternoon(spark, sf))


_STORED = [c for c in OUTPUT if c != "_action"]


@query(
    "load_merge",
    sql(
        f"""SELECT {", ".join(_STORED)}
        FROM ({merge_sql("TRUE", keep_load_time=False)}) AS merged""",
        "morning",
        "afternoon",
    ),
)
def load_merge(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _loads(spark, sf)
    table = store.fact_table(scratch_path(spark, "merged"))
    store.load_replace(target, table)
    store.load_merge(source, table, I.as_of())
    return store.read_table(spark, table).select(*_STORED)


@query("concurrent_merges", SQL["load_merge"])
def concurrent_merges(spark: SparkSession, sf: str) -> DataFrame:
    """Three writers at a time merge a share of the source each, into the same years: none is lost."""
    target, source = _loads(spark, sf)
    table = store.fact_table(scratch_path(spark, "merged"))
    store.load_replace(target, table)
    shares = [source.filter(F.pmod(F.xxhash64(*schemas.FACT_KEY), F.lit(3)) == i) for i in range(3)]
    with ThreadPoolExecutor(3) as writers:
        list(writers.map(lambda share: store.load_merge(share, table, I.as_of()), shares))
    return store.read_table(spark, table).select(*_STORED)


@query(
    "table_changes",
    sql(
        f"""SELECT {KEY}, value, carbon, _action AS _change, CAST(2 AS BIGINT) AS _version
        FROM ({merge_sql(NEWER)}) AS merged WHERE _action <> 'keep'""",
        "morning",
        "afternoon",
    ),
)
def table_changes(spark: SparkSession, sf: str) -> DataFrame:
    """What a newer-wins merge inserted and updated, told from the folders of two versions."""
    target, source = _loads(spark, sf)
    table = store.fact_table(scratch_path(spark, "merged"))
    store.load_replace(target, table)
    store.apply_merge(spark, table, source, M.merge_newer_wins, as_of=I.as_of())
    found = changes.changes(spark, table, since=1)
    return found.select(*schemas.FACT_KEY, "value", "carbon", "_change", "_version")


@query("compact_table", sql(f"SELECT {ROW} FROM fp", "fp"))
def compact_table(spark: SparkSession, sf: str) -> DataFrame:
    """Rows appended in eight loads, compacted, and read again country by country in two ranges."""
    table = _grown(spark, sf)
    done = compact.compact(spark, table)
    if done["files_after"] >= done["files_before"]:
        raise RuntimeError(str(done))
    low, high = compact.read_range(spark, table, 0, 499), compact.read_range(spark, table, 500, 2**62)
    return low.unionByName(high).select(*COLUMNS)


def _grown(spark: SparkSession, sf: str) -> store.Table:
    rows = I.facts(spark, sf).select(*COLUMNS)
    table = _raw_table(spark, rows)
    for i in range(8):
        store.load_append(rows.filter(F.pmod("event_id", F.lit(8)) == i), table, datetime(2024, 1, 31))
    return table


@query(
    "table_set",
    sql(
        f"""SELECT 'facts' AS name, CAST(count(*) AS BIGINT) AS n FROM morning
        UNION ALL SELECT 'mart', CAST(count(*) AS BIGINT) FROM ({mart_sql("morning")}) AS m""",
        "morning",
    ),
)
def table_set(spark: SparkSession, sf: str) -> DataFrame:
    """Facts and their mart written together; a second writer stops after the facts, and readers of the
    set see the tables of the first."""
    target, source = _loads(spark, sf)
    root = scratch_path(spark, "set")
    pair = sets.TableSet(f"{root}/_set", {"facts": store.fact_table(f"{root}/f"), "mart": store.mart_table(f"{root}/m")})
    with sets.together(spark, pair):
        store.load_replace(target, pair.tables["facts"])
        stored = store.read_table(spark, pair.tables["facts"])
        summary = mart_summary(stored).withColumn("_updated_at", I.as_of())
        store.apply_merge(spark, pair.tables["mart"], summary, M.merge_mart, as_of=I.as_of())
    try:
        with sets.together(spark, pair):
            store.load_merge(source, pair.tables["facts"], I.as_of())
            raise InterruptedError("before the mart")
    except InterruptedError:
        pass
    at = sets.current_set(spark, pair)
    counts = [
        sets.read_from(spark, pair, name, at).agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name in pair.tables
    ]
    return counts[0].union(counts[1])


@query(
    "load_new_files",
    sql(
        f"""SELECT strftime(_loaded_at, '%Y%m%d') AS day, CAST(count(*) AS BIGINT) AS n,
        CAST(1 AS BIGINT) AS loads FROM fp GROUP BY ALL""",
        "fp",
    ),
)
def load_new_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a day each, loaded, then landed again under other names and loaded again: once each."""
    path, raw = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in ("day", "countryCode")],
                           T.StructField("_loaded_at", T.TimestampNTZType())])
    target, book = store.Table(raw, schema, ["day"]), ledger.ledger_table(scratch_path(spark, "ledger"))
    rows = I.landed_records(spark, sf).withColumn("day", F.date_format("_loaded_at", "yyyyMMdd"))
    lines = rows.select("day", F.to_json(F.struct(*schemas.RECORD_FIELDS.values(), "event_id")).alias("value"))
    ordered = lines.repartition("day").sortWithinPartitions("day", "value")

    def shaped(records: DataFrame) -> DataFrame:
        day = F.regexp_extract("file_name", r"day=(\d+)/", 1)
        return records.select(day.alias("day"), "countryCode")

    for name, stamp in (("first", datetime(2024, 1, 30)), ("again", datetime(2024, 1, 31))):
        ordered.write.partitionBy("day").text(f"{path}/{name}")
        ledger.load_new_files(spark, path, target, book, stamp, r".*part-.*", rows_of=shaped)
    found = store.read_table(spark, target).groupBy("day")
    return found.agg(F.count("*").alias("n"), F.count_distinct("_loaded_at").alias("loads"))


@query(
    "load_merge_evolved",
    sql(
        """SELECT coalesce(a.country_code, m.country_code) AS country_code,
        coalesce(a.year, m.year) AS year, coalesce(a.record_type, m.record_type) AS record_type,
        CASE WHEN a.event_id IS NULL THEN m.value ELSE a.value END AS value, a.score AS origin
        FROM morning AS m FULL JOIN afternoon AS a ON m.country_code = a.country_code
          AND m.year = a.year AND m.record_type = a.record_type""",
        "morning",
        "afternoon",
    ),
)
def load_merge_evolved(spark: SparkSession, sf: str) -> DataFrame:
    """A column that only the second load has: rows of the first have none."""
    target, source = I.morning(spark, sf), I.afternoon(spark, sf)
    names = [*schemas.FACT_KEY, "value"]
    table = store.fact_table(scratch_path(spark, "evolved"), target.select(*names).schema)
    store.load_replace(target.select(*names), table)
    store.load_merge(source.select(*names, F.col("score").alias("origin")), table, evolve=True)
    return store.read_table(spark, table, evolved=True)


@query(
    "merge_into_table",
    sql(f"SELECT {', '.join(_STORED)} FROM ({merge_sql(NEWER)}) AS merged", "morning", "afternoon"),
)
def merge_into_table(spark: SparkSession, sf: str) -> DataFrame:
    """Newer-wins merge written to the table, twice: the second time changes no row."""
    target, source = _loads(spark, sf)
    table = store.fact_table(scratch_path(spark, "merged"))
    store.load_replace(target, table)
    for _ in range(2):
        store.apply_merge(spark, table, source, M.merge_newer_wins, as_of=I.as_of())
    return store.read_table(spark, table).select(*_STORED)


@query(
    "insert_or_replace",
    sql(
        f"""SELECT {KEY}, value, carbon, transformed_at FROM
        ({merge_sql("TRUE", keep_load_time=False)}) AS merged""",
        "morning",
        "afternoon",
    ),
)
def insert_or_replace(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _loads(spark, sf)
    path = scratch_path(spark, "facts")
    store.insert_or_replace(target, path)
    store.insert_or_replace(source, path)
    rows = store.read_table(spark, store.fact_table(path))
    return rows.select(*schemas.FACT_KEY, "value", "carbon", "transformed_at")


@query(
    "multi_target",
    sql(
        f"""SELECT 'first' AS target, {ROW} FROM fp UNION ALL SELECT 'second' AS target, {ROW}
        FROM fp""",
        "fp",
    ),
)
def multi_target(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.facts(spark, sf).select(*COLUMNS)
    root = scratch_path(spark, "targets")
    store.multi_target(
        rows, {t: lambda df, t=t: layout.cluster_layout(df, f"{root}/target={t}") for t in ("first", "second")}
    )
    return spark.read.schema(rows.schema.add("target", "string")).parquet(root)


@query(
    "incremental_read",
    sql(f"SELECT {ROW} FROM fp WHERE year BETWEEN 2019 AND 2028", "fp"),
)
def incremental_read(spark: SparkSession, sf: str) -> DataFrame:
    """The state says 2020, from the years loaded so far; 2019 is taken again."""
    rows = I.facts(spark, sf).select(*COLUMNS)
    path, done = scratch_path(spark, "years"), scratch_path(spark, "state")
    layout.cluster_layout(rows, path)
    loaded = rows.filter("year <= 2020")
    state.write_state(spark, done, "facts", 2010, "first", datetime(2024, 1, 10))
    last = state.observed_last_year(loaded, 2010)
    state.write_state(spark, done, "facts", last, "second", datetime(2024, 1, 20))
    stored = spark.read.schema(rows.schema).parquet(path)
    return state.incremental_read(stored, state.read_state(spark, done), "facts", 2005, 2028)


@query(
    "run_log",
    """SELECT upper(event_type) AS stage, 'SUCCESS' AS status, CAST(1 AS BIGINT) AS runs,
    CAST(count(*) AS BIGINT) AS records FROM events GROUP BY event_type""",
)
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """A log row per event type, with how many events it had."""
    from snapmart.plans.monitor import status_counts

    path = scratch_path(spark, "runs")
    stage = F.upper("event_type").alias("stage")
    counts = I.table(spark, sf, "events").groupBy(stage).agg(F.count("*").alias("records_processed"))
    rows = counts.withColumns({"run_id": F.lit("run"), "status": F.lit("SUCCESS")})
    state.log_rows_of(rows, path, AT)
    return status_counts(state.read_run_log(spark, path))
