"""The rows that changed between versions of a table, and a stream of them.

A version differs from the one before in some folders. Where it only added folders, their rows are
inserts. Where it replaced folders, the rows of the old and the new ones are joined by key: only the
partitions that a writer touched are read, and rows it wrote back unchanged are no changes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snapmart.tables import store, versions
from snapmart.tables.store import Table
from snapmart.tables.versions import COMPACT, MANIFESTS, Version

INSERT, UPDATE, DELETE = "insert", "update", "delete"
CHANGE, VERSION = "_change", "_version"


def _read(spark: SparkSession, table: Table, steps: Sequence[tuple[int, Sequence[str]]]) -> DataFrame:
    """The rows of the folders of each step, with its version."""
    out = None
    for number, folders in steps:
        rows = store.read_folders(spark, table, folders).withColumn(VERSION, F.lit(number).cast("long"))
        out = rows if out is None else out.union(rows)
    if out is None:
        out = store.read_folders(spark, table, []).withColumn(VERSION, F.lit(0).cast("long"))
    return out


def _difference(table: Table, old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` that ``old`` has not, or has otherwise, and of ``old`` that are gone."""
    on = [VERSION, *table.key]
    values = [c for c in new.columns if c not in on]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*on, F.struct(F.lit(1).alias("there"), *values).alias(name))

    a, b = side(old, "old").alias("a"), side(new, "new").alias("b")
    same_key = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on]
    joined = a.join(b, same_key, "full")
    change = (
        F.when(F.col("old").isNull(), INSERT).when(F.col("new").isNull(), DELETE)
        .when(~F.col("old").eqNullSafe(F.col("new")), UPDATE)
    )
    row = F.coalesce("new", "old")
    out = joined.select(
        # The key of the side that is there: of a null key both sides are null, which is the same.
        *[F.when(F.col("new").isNull(), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in on],
        row.alias("_row"), change.alias(CHANGE),
    ).where(F.col(CHANGE).isNotNull())
    return out.select(
        *[(F.col(c) if c in on else F.col(f"_row.{c}")).alias(c) for c in new.columns], CHANGE
    )


def changes_of(spark: SparkSession, table: Table, steps: Sequence[tuple[Version, Version]]) -> DataFrame:
    """The changes of each step from one version to the next."""
    added, replaced_old, replaced_new = [], [], []
    for before, after in steps:
        if after.kind == COMPACT:
            continue  # the same rows in other files
        old, new = set(before.folders), set(after.folders)
        gone = [f for f in before.folders if f not in new]
        fresh = [f for f in after.folders if f not in old]
        if gone:
            replaced_old.append((after.number, gone))
            replaced_new.append((after.number, fresh))
        else:
            added.append((after.number, fresh))
    inserts = _read(spark, table, added).withColumn(CHANGE, F.lit(INSERT))
    if not replaced_old:
        return inserts
    rest = _difference(table, _read(spark, table, replaced_old), _read(spark, table, replaced_new))
    return inserts.unionByName(rest)


def _steps(spark: SparkSession, table: Table, wanted: Callable[[int], bool]) -> list[tuple[Version, Version]]:
    """The wanted versions, each with the one before; ``LookupError`` where that was deleted."""
    known = list(versions.numbers(spark, table.path))
    out, after = [], None
    for number in known:
        if after is None and not wanted(number):
            continue
        found = versions.read_version(spark, table.path, number)
        if found is None:
            continue
        if after is not None:
            out.append((found, after))
        after = found if wanted(number) else None
    if after is not None:
        # The oldest manifest there is: the table began with it, or what came before is gone.
        if after.number > 1:
            raise LookupError(f"{table.path}: the version before {after.number} is gone")
        out.append((Version(), after))
    return out[::-1]


def changes(spark: SparkSession, table: Table, since: int = 0, until: int | None = None) -> DataFrame:
    """The rows changed by the versions after ``since`` up to ``until`` (default: the newest).

    The columns of the table with ``_change`` (insert, update or delete) and ``_version``; a deleted row
    has its old values, an updated one its new ones. A row that several versions changed is there for
    each. Rows are told apart by the key, which must be unique where versions replace folders; nulls in
    it are equal. Versions that only compact files change nothing. Columns never declared are left out.
    """
    last = until if until is not None else versions.current(spark, table.path).number
    return changes_of(spark, table, _steps(spark, table, lambda n: since < n <= last))


def change_stream(
    spark: SparkSession, table: Table, sink: Callable[[DataFrame, int], None], checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand the changes of new versions to ``sink`` with the number of the batch, each version once.

    The stream reads the manifests as they are published; its checkpoint remembers which. A batch that
    is delivered again has the same versions, so a sink that commits under the batch's number takes it
    in once. Versions must be kept until they were read.
    """
    manifests = spark.readStream.option("wholetext", True).text(f"{table.path}/{MANIFESTS}")
    names = manifests.select(F.col("_metadata.file_name").alias("name"))

    def hand_over(batch: DataFrame, batch_id: int) -> None:
        # One row per commit since the last batch.
        wanted = {int(r["name"]) for r in batch.distinct().collect() if r["name"].isdigit()}
        sink(changes_of(spark, table, _steps(spark, table, wanted.__contains__)), batch_id)

    return (
        names.writeStream.foreachBatch(hand_over).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
