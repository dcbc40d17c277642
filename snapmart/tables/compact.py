"""Compaction: many small files of a partition become few, clustered by the table's sort columns.

Every append leaves a folder per partition. ``compact`` packs the folders whose files are small, writes
their rows again in ranges of the sort columns, one file per range of about the target size, and commits
under the same manifest rules as any other writer. The least and greatest value of the first sort column
in each file are kept beside the table; ``read_range`` reads the files whose range meets what is asked.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.tables import store, versions
from snapmart.tables.store import Table
from snapmart.tables.versions import COMPACT, Conflict, Version, delete_folder, statuses

TARGET_BYTES = 128 * 1024 * 1024
SMALL_SHARE = 0.75  # a file below this share of the target is small
STATISTICS = "_files"
ATTEMPTS = 5


@dataclass(frozen=True)
class Folder:
    """A folder of a table: its partition, files and bytes."""

    name: str
    partition: str
    files: int
    bytes: int


def folders_of(spark: SparkSession, table: Table, version: Version | None = None) -> list[Folder]:
    """What the folders of a version hold; a listing, no file is opened."""
    at = versions.current(spark, table.path) if version is None else version
    out = []
    for name in at.folders:
        sizes = [s.getLen() for s in statuses(spark, f"{table.path}/{name}") if s.getPath().getName().startswith("part-")]
        out.append(Folder(name, name.split("/")[-1] if table.partition_by else "", len(sizes), sum(sizes)))
    return out


def chosen(folders: Sequence[Folder], target_bytes: int, all_of: bool = False) -> dict[str, list[Folder]]:
    """By partition, the folders worth writing again: those with small files, if they become fewer files.

    With ``all_of`` every folder of a partition that has any, so that the whole of it is clustered.
    """
    by: dict[str, list[Folder]] = {}
    for f in folders:
        by.setdefault(f.partition, []).append(f)
    out = {}
    for partition, own in by.items():
        small = [f for f in own if f.files and f.bytes < SMALL_SHARE * target_bytes * f.files]
        picked = own if all_of and small else small
        if sum(f.files for f in picked) > pieces(picked, target_bytes):
            out[partition] = picked
    return out


def pieces(folders: Sequence[Folder], target_bytes: int) -> int:
    return max(1, -(-sum(f.bytes for f in folders) // target_bytes))


def _file_statistics(spark: SparkSession, table: Table, rows: DataFrame) -> DataFrame:
    """file, rows, and the least and greatest value of the first sort column in it."""
    column = table.sort_by[0]
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.min(column).alias("low"), F.max(column).alias("high"),
        F.count_if(F.col(column).isNull()).alias("nulls"),
    )


def compact(
    spark: SparkSession, table: Table, target_bytes: int = TARGET_BYTES, whole_partitions: bool = True
) -> dict[str, int]:
    """Write folders of small files again as few files; returns the files before and after.

    Rows stay the same, columns added by later loads too. Partitions are compacted one commit each, so
    a writer that meets one only delays that one; it is tried again on the newest version. Running it
    again changes nothing.
    """
    done = {"partitions": 0, "files_before": 0, "files_after": 0}
    for partition in chosen(folders_of(spark, table), target_bytes, whole_partitions):
        for attempt in range(ATTEMPTS):
            base = versions.current(spark, table.path)
            own = folders_of(spark, table, _only(base, table, partition))
            picked = chosen(own, target_bytes, whole_partitions).get(partition)
            if not picked:
                break  # another writer has seen to it
            try:
                after = _rewrite(spark, table, base, partition, picked, target_bytes)
            except Conflict:
                if attempt + 1 == ATTEMPTS:
                    raise
                continue
            done["partitions"] += 1
            done["files_before"] += sum(f.files for f in picked)
            done["files_after"] += after
            break
    return done


def _only(version: Version, table: Table, partition: str) -> Version:
    names = version.of([partition] if table.partition_by else None)
    return Version(version.number, tuple(f for f in version.folders if f in names))


def _rewrite(
    spark: SparkSession, table: Table, base: Version, partition: str, picked: Sequence[Folder], target_bytes: int
) -> int:
    """One partition's folders as one, a file per range; returns its files."""
    names = {f.name for f in picked}
    old = Version(base.number, tuple(f for f in base.folders if f in names))
    rows = store.read_table(spark, table, evolved=True, version=old)
    n, order = pieces(picked, target_bytes), list(table.sort_by)
    if order and n > 1:
        # Ranges are cut on a sample; equal values may fall on both sides of a cut, so a hot value is
        # spread over files as well.
        rows = rows.repartitionByRange(n, *order, F.xxhash64(*table.key))
    else:
        rows = rows.coalesce(1) if n == 1 else rows.repartition(n)
    rows = rows.sortWithinPartitions(*order) if order else rows
    below = store.generation(spark, table)
    written = store.write(rows, table, below)
    if order and written:
        kinds = {f.name: f.dataType for f in table.schema}
        schema = T.StructType([T.StructField(order[0], kinds[order[0]])])
        stored = spark.read.schema(schema).parquet(*[f"{table.path}/{w}" for w in written])
        _file_statistics(spark, table, stored).write.parquet(f"{table.path}/{STATISTICS}/{below}")
    try:
        versions.commit(
            spark, table.path, written, COMPACT, base, [partition] if table.partition_by else None, removed=sorted(names)
        )
    except Conflict:
        delete_folder(spark, f"{table.path}/{below}")
        delete_folder(spark, f"{table.path}/{STATISTICS}/{below}")
        raise
    return sum(f.files for f in folders_of(spark, table, Version(0, tuple(written))))


def files_in_range(
    spark: SparkSession, table: Table, low: object, high: object, version: Version | None = None
) -> list[str]:
    """Files and folders of a version that may hold values from ``low`` to ``high``.

    Compacted folders give single files, by their statistics; others are given whole.
    """
    at = versions.current(spark, table.path) if version is None else version
    known = {n for n in versions.children(spark, f"{table.path}/{STATISTICS}")}
    with_files = [f for f in at.folders if f.split("/")[0] in known]
    out = [f"{table.path}/{f}" for f in at.folders if f.split("/")[0] not in known]
    if with_files:
        below = sorted({f.split("/")[0] for f in with_files})
        found = spark.read.parquet(*[f"{table.path}/{STATISTICS}/{b}" for b in below])
        hit = found.where((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)))
        out += sorted(r["file"] for r in hit.select("file").collect())  # only those that are read
    return out


def read_range(
    spark: SparkSession, table: Table, low: object, high: object, version: Version | None = None
) -> DataFrame:
    """Rows whose first sort column lies from ``low`` to ``high``; other files are not opened."""
    paths = files_in_range(spark, table, low, high, version)
    if not paths:
        return store.read_folders(spark, table, [])
    rows = store.read_paths(spark, table, paths)
    return rows.where(F.col(table.sort_by[0]).between(low, high))


def expire_statistics(spark: SparkSession, table: Table) -> list[str]:
    """Delete the statistics of folders that are gone."""
    there = set(versions.children(spark, table.path))
    gone = [n for n in versions.children(spark, f"{table.path}/{STATISTICS}") if n not in there]
    return [n for n in gone if delete_folder(spark, f"{table.path}/{STATISTICS}/{n}")]
