"""Streams over landed files, run until everything available is taken in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.catalog import inputs as I
from snapmart.catalog.registry import AS_OF, mart_sql, query, sql
from snapmart.operators import clean
from snapmart.plans.monitor import one_row
from snapmart.session import scratch_path
from snapmart.streaming import ingest
from snapmart.tables import store, versions
from snapmart.tables.state import read_run_log

VALUES = "country_code, country_name, iso_alpha2, year, record_type, carbon, value, score"
COLUMNS = VALUES.split(", ")
KEY = ", ".join(schemas.FACT_KEY)


def _newest(where: str = "TRUE") -> str:
    """Newest row per key, by load time."""
    return f"""(SELECT * REPLACE (_loaded_at AS transformed_at) FROM (SELECT *, row_number() OVER
      (PARTITION BY {KEY} ORDER BY _loaded_at DESC) AS rn FROM fp WHERE {where}) AS x
      WHERE rn = 1)"""


def _land_twice(spark: SparkSession, sf: str) -> str:
    """Morning and afternoon rows as two deliveries, transformed when they were loaded."""
    path = scratch_path(spark, "landing")
    at = F.date_format("_loaded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    rows = I.landed_records(spark, sf).withColumn("transformed_at", at)
    early = F.hour("_loaded_at") < 12
    for part in (rows.filter(early), rows.filter(~early)):
        part.drop("_loaded_at").write.mode("append").json(path)
    return path


def _layers(spark: SparkSession) -> ingest.Layers:
    root = scratch_path(spark, "layers")
    return ingest.Layers(store.fact_table(f"{root}/staging"), store.mart_table(f"{root}/mart"))


@query(
    "auto_ingest",
    sql(
        f"""SELECT {VALUES}, _loaded_at AS transformed_at, TIMESTAMP '{AS_OF}' AS _loaded_at
        FROM fp""",
        "fp",
    ),
)
def auto_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Taken in twice; the second time there is nothing new."""
    path, raw, marks = _land_twice(spark, sf), scratch_path(spark, "raw"), scratch_path(spark, "ck")
    for _ in range(2):
        ingest.auto_ingest(spark, path, raw, marks, loaded_at=I.as_of()).awaitTermination()
    return ingest.read_raw(spark, raw).select(*COLUMNS, "transformed_at", "_loaded_at")


def _merged(spark: SparkSession, sf: str) -> ingest.Layers:
    """Files to staging and mart in several small batches."""
    path, raw, marks = _land_twice(spark, sf), scratch_path(spark, "raw"), scratch_path(spark, "ck")
    layers = _layers(spark)
    ingest.auto_ingest(
        spark, path, raw, f"{marks}/ingest", loaded_at=I.as_of(), max_files=4
    ).awaitTermination()
    ingest.stream_merge(
        ingest.raw_stream(spark, raw, max_files=8), layers, f"{marks}/merge", as_of=I.as_of()
    ).awaitTermination()
    return layers


@query("stream_merge", sql(f"SELECT {VALUES}, transformed_at FROM {_newest()} AS s", "fp"))
def stream_merge(spark: SparkSession, sf: str) -> DataFrame:
    layers = _merged(spark, sf)
    return store.read_table(spark, layers.staging).select(*COLUMNS, "transformed_at")


@query("stream_mart", sql(mart_sql(_newest() + " AS s"), "fp"))
def stream_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Mart rows kept up batch by batch."""
    layers = _merged(spark, sf)
    return store.read_table(spark, layers.mart).drop("_updated_at")


@query(
    "stream_insert_only",
    sql(
        f"SELECT {VALUES}, transformed_at FROM {_newest("record_type <> 'EFConsCarbonGHA'")} AS s",
        "fp",
    ),
)
def stream_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """A change feed in which the rows of one type are deletes."""
    path = scratch_path(spark, "changes")
    deleted = F.col("record_type") == "EFConsCarbonGHA"
    rows = I.facts(spark, sf).drop("event_id").withColumns(
        {
            "change_action": F.when(deleted, "DELETE").otherwise("INSERT"),
            "transformed_at": F.col("_loaded_at"),
        }
    )
    rows.write.parquet(path)
    layers = ingest.Layers(store.fact_table(f"{scratch_path(spark, 'layers')}/staging"))
    changes = spark.readStream.schema(rows.schema).parquet(path)
    ingest.stream_merge(
        changes, layers, scratch_path(spark, "ck"), as_of=I.as_of()
    ).awaitTermination()
    return store.read_table(spark, layers.staging).select(*COLUMNS, "transformed_at")


@query(
    "stream_replay",
    sql(
        f"""SELECT CAST(count(*) AS BIGINT) AS staging_rows,
        (SELECT CAST(count(*) AS BIGINT) FROM ({mart_sql("fp")}) AS m) AS mart_rows,
        CAST(0 AS BIGINT) AS changed_again FROM {_newest()} AS s""",
        "fp",
    ),
)
def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The same batch delivered twice: the second delivery inserts and updates nothing.

    Rows without a time are given one, since a row never stamped is always replaced.
    """
    rows = clean.stamp_transformed(I.facts(spark, sf).drop("event_id"), I.as_of())
    layers = _layers(spark)
    ingest.merge_batch(rows, layers, I.as_of())
    again = ingest.merge_batch(rows, layers, I.as_of())["staging"]
    changed = again["inserted"] + again["updated"]
    return one_row(
        [
            store.read_table(spark, layers.staging).agg(F.count("*").alias("staging_rows")),
            store.read_table(spark, layers.mart).agg(F.count("*").alias("mart_rows")),
            spark.range(1).select(F.lit(changed).cast("bigint").alias("changed_again")),
        ]
    )


@query(
    "stream_redelivery",
    sql(
        f"""SELECT CAST(count(*) AS BIGINT) AS staging_rows,
        (SELECT CAST(count(*) AS BIGINT) FROM ({mart_sql("fp")}) AS m) AS mart_rows,
        CAST(count(*) AS BIGINT) AS inserted, CAST(1 AS BIGINT) AS staging_commits,
        CAST(1 AS BIGINT) AS mart_commits, CAST(1 AS BIGINT) AS logged FROM {_newest()} AS s""",
        "fp",
    ),
)
def stream_redelivery(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that stopped after staging, delivered twice more: each table takes it in once, and the
    run log has it once with the counts of the first delivery."""
    rows = I.facts(spark, sf).drop("event_id")
    layers, mark = _layers(spark), versions.Batch("stream", 0)
    layers = ingest.Layers(layers.staging, layers.mart, scratch_path(spark, "runs"))
    ingest.merge_batch(rows, ingest.Layers(layers.staging), I.as_of(), mark)  # then it stopped
    for _ in range(2):
        done = ingest.merge_batch(rows, layers, I.as_of(), mark)
    commits = [versions.current(spark, t.path).number for t in (layers.staging, layers.mart)]
    log = read_run_log(spark, layers.log_path)
    return one_row(
        [
            store.read_table(spark, layers.staging).agg(F.count("*").alias("staging_rows")),
            store.read_table(spark, layers.mart).agg(F.count("*").alias("mart_rows")),
            spark.range(1).select(*[
                F.lit(v).cast("bigint").alias(n)
                for n, v in (("inserted", done["staging"]["inserted"]), ("staging_commits", commits[0]), ("mart_commits", commits[1]))
            ]),
            log.agg(F.count("*").alias("logged")),
        ]
    )


@query("stream_table_changes", sql(f"SELECT {VALUES}, transformed_at FROM {_newest()} AS s", "fp"))
def stream_table_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A landing table under a manifest, appended to twice, feeds staging by its changes."""
    schema = store.T.StructType([f for f in schemas.RAW if f.name != "_loaded_at"])
    rows = I.facts(spark, sf).withColumn("transformed_at", F.col("_loaded_at"))
    landed = store.T.StructType([*schema.fields, store.T.StructField("_loaded_at", schemas.STAMP)])
    table, layers = store.Table(scratch_path(spark, "raw"), landed, schemas.FACT_KEY, "year"), _layers(spark)
    marks, early = scratch_path(spark, "ck"), F.hour("_loaded_at") < 12
    for part, at in ((rows.filter(early), "2024-01-30"), (rows.filter(~early), "2024-01-31")):
        store.load_append(store.shaped(part, schema), table, I.as_of(at))
        ingest.merge_changes(spark, table, layers, marks, as_of=I.as_of()).awaitTermination()
    return store.read_table(spark, layers.staging).select(*COLUMNS, "transformed_at")
