"""Which landed files have been loaded, by what is in them.

A file is known by its path, its size and a hash of its content, and loaded once by its content: the
same bytes under another name are not loaded again, and a file that was written anew under its old name
is. Batch loads and streams share one ledger. The hash of a file is made of the hashes of its documents,
so that a large file is hashed by many tasks; the same documents in another order are the same content.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.session import scratch_path
from snapmart.sources.landed import BLOCK, SEQ, SOURCE, flatten_documents
from snapmart.tables import store
from snapmart.tables.backfill import matching_documents
from snapmart.tables.layout import literal

LEDGER = T.StructType([
    T.StructField("file_name", T.StringType()), T.StructField("documents", T.LongType()),
    T.StructField("bytes", T.LongType()), T.StructField("content", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("_loaded_at", T.TimestampNTZType()),
])
LOADED, SAME, KNOWN = "LOADED", "SAME_CONTENT", "KNOWN"


def ledger_table(path: str) -> store.Table:
    return store.Table(path, LEDGER, ["content"])


def file_contents(docs: DataFrame) -> DataFrame:
    """file_name, documents, bytes and content of every file of ``docs``.

    The content is told from two sums of 64-bit hashes over the documents, which do not depend on where
    Spark cuts a file. They are combined before the shuffle, and no text is shuffled.
    """
    sums = [F.sum(F.xxhash64(F.lit(salt), "document").cast("decimal(20,0)")).cast("string") for salt in (0, 1)]
    files = docs.groupBy("file_name").agg(
        F.count("*").alias("documents"), F.sum(F.octet_length("document").cast("long")).alias("bytes"),
        F.concat_ws(":", *sums).alias("sums"),
    )
    return files.select("file_name", "documents", "bytes", F.concat_ws(":", "documents", "bytes", "sums").alias("content"))


def judged(files: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """``files`` with a status: to be LOADED, of the SAME_CONTENT as one beside it, or KNOWN.

    Of files with one content the one of the smallest name is loaded. ``force`` takes no file as known.
    """
    least = files.groupBy("content").agg(F.min("file_name").alias("_least"))
    marked = files.join(least, "content")
    if force:
        known = F.lit(False)
    else:
        seen = ledger.where(F.col("status") == LOADED).select("content").distinct()
        marked = marked.join(seen.withColumn("_seen", F.lit(True)), "content", "left")
        known = F.coalesce("_seen", F.lit(False))
    status = F.when(known, KNOWN).when(F.col("file_name") == F.col("_least"), LOADED).otherwise(SAME)
    return marked.select("file_name", "documents", "bytes", "content", status.alias("status"))


def load_new_files(
    spark: SparkSession, path: str, target: store.Table, ledger: store.Table, at: datetime,
    pattern: str = r".*\.json$", layout: str = "lines", force: bool = False, rows_of=None,
) -> DataFrame:
    """Append the records of files not loaded before to ``target``; returns a row per matching file.

    ``rows_of`` shapes the landed records for the table. The ledger is written after the rows: a load
    that stops between the two is repeated by the next one, so let what reads the target tell rows by
    their key. Files are judged and loaded from one listing; empty files have no documents and no row.
    """
    docs = matching_documents(spark, path, pattern, layout)
    files = judged(file_contents(docs), store.read_table(spark, ledger), force)
    stored = scratch_path(spark, "ledger-files")
    files.write.parquet(stored)
    files = spark.read.schema(files.schema).parquet(stored)
    fresh = files.where(F.col("status") == LOADED).select("file_name")
    if not fresh.isEmpty():
        records = flatten_documents(docs.join(fresh, "file_name", "left_semi"), keep=["file_name", BLOCK, SEQ, SOURCE])
        store.load_append(records if rows_of is None else rows_of(records), target, literal(at))
        store.load_append(files.where(F.col("status") == LOADED), ledger, literal(at))
    return files


def new_of_batch(spark: SparkSession, batch: DataFrame, ledger: store.Table) -> tuple[DataFrame, DataFrame]:
    """For the sink of a document stream: the documents of new files, and their rows for the ledger.

    A file is in one batch with all its blocks. Write the documents first, then append the rows.
    """
    named = batch.withColumn("file_name", F.col(SOURCE))
    files = judged(file_contents(named), store.read_table(spark, ledger))
    path = scratch_path(spark, "ledger-batch")
    files.write.parquet(path)
    fresh = spark.read.schema(files.schema).parquet(path).where(F.col("status") == LOADED)
    return named.join(fresh.select("file_name"), "file_name", "left_semi").drop("file_name"), fresh
