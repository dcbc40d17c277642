"""Files to landing table, landing table to staging, staging to mart.

Every sink writes per micro-batch so that a batch delivered again has no further effect: the
landing table overwrites the folder named after the batch, and a merge commits under the name of its
stream and the number of its batch. A table that holds the batch already is left alone, so a stream
that stopped between the commits of staging and mart goes on with the mart, and the counts and the row
of the run log stay those of the first delivery. Spark skips batches without data.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from snapmart import schemas
from snapmart.operators import merge as M
from snapmart.operators.dedupe import dedupe_latest
from snapmart.operators.marts import mart_summary_for
from snapmart.sources.landed import BLOCK, CORRUPT, SEQ, SOURCE, flatten_documents
from snapmart.tables import changes, store, versions
from snapmart.tables.ledger import new_of_batch
from snapmart.tables.state import log_run, read_run_log
from snapmart.tables.versions import Batch

EVERY_FIVE_MINUTES = {"processingTime": "5 minutes"}
ALL_AVAILABLE = {"availableNow": True}
INGEST = "ingest"


def document_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """New JSON Lines files as documents."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    texts = reader.text(path).filter(F.trim("value") != "")
    return texts.select(
        F.col("value").alias("document"),
        F.col("_metadata.file_path").alias(SOURCE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def raw_rows(records: DataFrame, loaded_at: Column) -> DataFrame:
    """Landed records, under old or new field names, as rows of the landing table."""
    out, columns = {"_loaded_at": loaded_at.cast("timestamp_ntz")}, set(records.columns)
    for field in schemas.RAW:
        if field.name in out:
            continue
        names = [field.name, schemas.RECORD_FIELDS.get(field.name, field.name)]
        present = [F.col(n) for n in dict.fromkeys(names) if n in columns]
        value = F.coalesce(*present) if present else F.lit(None)
        if field.dataType == schemas.STAMP and present:
            out[field.name] = F.try_to_timestamp(value).cast("timestamp_ntz")
        else:
            out[field.name] = value.try_cast(field.dataType)
    return records.select(*[out[f.name].alias(f.name) for f in schemas.RAW], BLOCK, SEQ, CORRUPT)


def auto_ingest(
    spark: SparkSession,
    path: str,
    raw_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    loaded_at: Column | None = None,
    max_files: int | None = None,
    ledger: store.Table | None = None,
) -> StreamingQuery:
    """Append each new file of ``path`` to the landing table exactly once.

    Rows that do not parse are kept in the same table, marked by their text. With a ``ledger`` files
    whose content was loaded before, under any name, in a stream or a batch, are left out.
    """
    at = F.current_timestamp() if loaded_at is None else loaded_at

    def append(batch: DataFrame, batch_id: int) -> None:
        docs, fresh = batch.withColumn(SEQ, F.monotonically_increasing_id()), None
        mark = ledger and Batch(stream_name(spark, checkpoint), batch_id)
        if ledger is not None:
            if versions.current(spark, ledger.path).holds(mark):
                return  # delivered again after both were written
            docs, fresh = new_of_batch(spark, docs, ledger)
        rows = raw_rows(flatten_documents(docs), at)
        rows.write.mode("overwrite").parquet(f"{raw_path}/{INGEST}={batch_id:012d}")
        if ledger is not None:
            store.load_append(fresh, ledger, at, mark)

    return _start(document_stream(spark, path, max_files), append, checkpoint, trigger)


def read_raw(spark: SparkSession, raw_path: str, corrupt: bool = False) -> DataFrame:
    """The landing table; rows that did not parse only if asked for."""
    rows = spark.read.schema(RAW_FILES).parquet(raw_path)
    bad = F.col(CORRUPT).isNotNull()
    return rows.filter(bad if corrupt else ~bad)


RAW_FILES = T.StructType(
    [
        *schemas.RAW.fields,
        T.StructField(BLOCK, T.LongType()),
        T.StructField(SEQ, T.LongType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)


def _start(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ALL_AVAILABLE))
        .start()
    )


def raw_stream(spark: SparkSession, raw_path: str, max_files: int | None = None) -> DataFrame:
    """Rows newly appended to the landing table."""
    reader = spark.readStream.schema(RAW_FILES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(raw_path).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def insert_only(changes: DataFrame, action_col: str = "change_action") -> DataFrame:
    """Change rows that insert; an append-only source without the column has no others."""
    if action_col not in changes.columns:
        return changes
    return changes.filter(F.col(action_col) == "INSERT").drop(action_col)


@dataclass(frozen=True)
class Layers:
    """The tables a merge stream keeps up to date, and the run log its batches are noted in."""

    staging: store.Table
    mart: store.Table | None = None
    log_path: str | None = None


def merge_batch(
    batch: DataFrame, layers: Layers, as_of: Column | None = None, mark: Batch | None = None
) -> dict[str, dict[str, int]]:
    """One batch into staging, newest row per key winning, then the mart of the touched keys.

    Rows without a whole key stay in the landing table. With a ``mark``, the stream and number of the
    batch, each table takes it in once, however often it is delivered.
    """
    spark = batch.sparkSession
    known = _held(spark, layers, mark)
    if known is not None:
        _note(spark, layers, mark, known)
        return known
    now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of
    rows = dedupe_latest(batch.dropna(subset=schemas.FACT_KEY))
    # The batch is written once; what follows reads the stored rows.
    staged = store.stage(rows, layers.staging, ["transformed_at", "_loaded_at"])
    try:
        if not staged.count:
            return {}
        done = {
            "staging": store.merge_staged(
                spark, layers.staging, staged, M.merge_newer_wins, batch=mark, as_of=now
            )
        }
        if layers.mart is not None:
            done["mart"] = refresh_mart(spark, layers, staged, now, mark)
        _note(spark, layers, mark, done)
        return done
    finally:
        store.delete_folder(spark, staged.path)


def _held(spark: SparkSession, layers: Layers, mark: Batch | None) -> dict[str, dict[str, int]] | None:
    """The counts of a batch that every table holds already."""
    if mark is None:
        return None
    found = {}
    for name, table in (("staging", layers.staging), ("mart", layers.mart)):
        if table is not None:
            version = versions.current(spark, table.path)
            if not version.holds(mark):
                return None
            found[name] = dict(version.batches[mark.stream].counts)
    return found


def _note(spark: SparkSession, layers: Layers, mark: Batch | None, done: dict[str, dict[str, int]]) -> None:
    """A row of the run log for the batch, unless there is one."""
    if mark is None or layers.log_path is None:
        return
    run = f"{mark.stream}/{mark.id}"
    if not read_run_log(spark, layers.log_path).where(F.col("run_id") == run).isEmpty():
        return
    facts = {f"{name}_{k}": str(v) for name, counts in done.items() for k, v in counts.items()}
    at = datetime.now(timezone.utc).replace(tzinfo=None)
    records = sum(done["staging"].values()) if "staging" in done else 0
    log_run(spark, layers.log_path, run, "MERGE", "SUCCESS", at, records=records, metadata=facts)


def refresh_mart(
    spark: SparkSession, layers: Layers, staged: store.Staged, as_of: Column, mark: Batch | None = None
) -> dict[str, int]:
    """Mart rows of the touched (country, year) keys from all their staging rows."""
    keys = staged.rows.select(*schemas.MART_KEY).distinct()
    staging = store.read_table(spark, layers.staging, partitions=staged.partitions)
    summary = mart_summary_for(staging, keys).withColumn("_updated_at", as_of)
    return store.apply_merge(spark, layers.mart, summary, M.merge_mart, batch=mark, as_of=as_of)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream of a checkpoint; a new checkpoint is a new stream."""
    return json.loads(versions.text_of(spark, f"{checkpoint}/metadata"))["id"]


def stream_merge(
    stream: DataFrame,
    layers: Layers,
    checkpoint: str,
    trigger: dict | None = None,
    as_of: Column | None = None,
    on_done: Callable[[int, dict], None] | None = None,
) -> StreamingQuery:
    """Merge each batch of a row stream into the layers, once."""
    spark = stream.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        mark = Batch(stream_name(spark, checkpoint), batch_id)
        done = merge_batch(insert_only(batch), layers, as_of, mark)
        if on_done is not None:
            on_done(batch_id, done)

    return _start(stream, sink, checkpoint, trigger)


def merge_changes(
    spark: SparkSession, source: store.Table, layers: Layers, checkpoint: str,
    trigger: dict | None = None, as_of: Column | None = None,
) -> StreamingQuery:
    """Merge what was inserted into or updated in a table, version by version, into the layers, once."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        newest = rows.where(F.col(changes.CHANGE) != changes.DELETE).drop(changes.CHANGE, changes.VERSION)
        merge_batch(newest, layers, as_of, Batch(stream_name(spark, checkpoint), batch_id))

    return changes.change_stream(spark, source, sink, checkpoint, trigger)


def ingest_and_merge(
    spark: SparkSession,
    path: str,
    raw_path: str,
    layers: Layers,
    checkpoints: str,
    loaded_at: Column | None = None,
    as_of: Column | None = None,
) -> None:
    """Take in everything that has landed: files to landing table, then to staging and mart."""
    auto_ingest(spark, path, raw_path, f"{checkpoints}/ingest", loaded_at=loaded_at).awaitTermination()
    stream_merge(
        raw_stream(spark, raw_path), layers, f"{checkpoints}/merge", as_of=as_of
    ).awaitTermination()

