"""Tables as Parquet folders under a manifest: append, replace, merge.

Every write goes to a folder of its own, ``g=<number>-<id>``, with the table's partition folders
below it. Then a manifest is written that names the folders which make up the table; readers follow
the newest complete one. A write that stops at any point, on an executor or on the driver, leaves
the old table whole, and nothing a reader may hold is moved or deleted before ``expire_versions``.

Partitions are told apart by the folder names that Spark itself chose, never by values turned into
text here. Merges rewrite the partitions the source touches: the source is written once, partitioned
like the table, and its folders say which ones these are.

Several writers may work on a table. An append is carried over whatever else was committed, a replace
takes the place of it. A merge that finds its partitions changed since it read them runs again on the
newest version; its source is stored by then, so only the target is read anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schemas
from snapmart.operators import merge as M
from snapmart.operators.dedupe import dedupe_latest
from snapmart.tables import versions
from snapmart.tables.layout import literal, rebalanced
from snapmart.tables.versions import (
    MANIFESTS,
    STAGE,
    Batch,
    Conflict,
    Version,
    children,
    commit,
    delete_folder,
    handle_of,
    list_folders,
)

#: A source within both is broadcast in a merge, on its rows counted and its files measured. Both
#: ways give the same rows.
SMALL_SOURCE_ROWS = 200_000
SMALL_SOURCE_BYTES = 16 * 1024 * 1024
MERGE_ATTEMPTS = 5
__all__ = ["MANIFESTS", "delete_folder", "list_folders"]


@dataclass(frozen=True)
class Table:
    """Where a table lives and how it is keyed and laid out.

    The partition column belongs to the key: a row that moved to another partition could not be
    found by its key otherwise.
    """

    path: str
    schema: T.StructType
    key: Sequence[str]
    partition_by: str | None = None
    sort_by: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self):
        if self.partition_by is not None and self.partition_by not in self.key:
            raise ValueError(f"the key must hold the partition column {self.partition_by}")


def fact_table(path: str, schema: T.StructType = schemas.STAGING) -> Table:
    return Table(path, schema, schemas.FACT_KEY, "year", ["country_code", "record_type"])


def mart_table(path: str) -> Table:
    return Table(path, schemas.MART, schemas.MART_KEY, "year", ["country_code"])


def expire_versions(
    spark: SparkSession, table: Table, keep: int = 2, grace_hours: float = 24, pinned: Sequence[int] = ()
) -> list[str]:
    """Delete what only older versions than the ``keep`` newest use; see ``versions.expire``."""
    return versions.expire(spark, table.path, keep, grace_hours, pinned)


# Reading and writing. -------------------------------------------------------------------------


def shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, cast; those ``df`` lacks are null.

    A value that the type of the schema does not hold fails the job when it is reached.
    """
    present = set(df.columns)
    return M.conformed(
        df.select(
            *[
                F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schema
            ]
        ),
        schema,
    )


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, as a plan that joins and unions with it fold away."""
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).where(F.lit(False)).select(*none)


def _read(spark: SparkSession, table: Table, folders: Sequence[str], evolved: bool) -> DataFrame:
    if not folders:
        return empty(spark, table.schema)
    paths = [f"{table.path}/{f}" for f in folders]
    if not evolved:
        return read_paths(spark, table, paths)
    reader = spark.read.option("basePath", table.path).option("mergeSchema", True)
    found = {f.name: f.dataType for f in reader.parquet(*paths).schema if f.name != "g"}
    # Read by schema, so that folder names are not taken for numbers where they are text.
    kinds = {f.name: f.dataType for f in table.schema}
    schema = T.StructType([T.StructField(n, k) for n, k in {**kinds, **found, **kinds}.items()])
    rows = spark.read.schema(schema).option("basePath", table.path).parquet(*paths)
    return rows.select(*schema.names)


def read_paths(spark: SparkSession, table: Table, paths: Sequence[str]) -> DataFrame:
    """The declared columns of files and folders below the table."""
    reader = spark.read.schema(_nullable(table.schema)).option("basePath", table.path)
    return reader.parquet(*paths).select(*[f.name for f in table.schema])


def read_folders(spark: SparkSession, table: Table, folders: Sequence[str]) -> DataFrame:
    """The rows of some of a table's folders, whether or not its newest version has them."""
    return _read(spark, table, folders, False)


def read_table(
    spark: SparkSession, table: Table, evolved: bool = False,
    partitions: Sequence[str] | None = None, version: Version | int | None = None,
) -> DataFrame:
    """The table as stored, or an empty frame of its schema.

    ``evolved`` also returns columns added by later loads, at the cost of reading footers.
    ``partitions`` names the partition folders to read; no other is listed. ``version`` is an older
    state of the table, as long as it is kept.
    """
    if isinstance(version, int):
        version = versions.read_version(spark, table.path, version) if version else Version()
    at = versions.current(spark, table.path) if version is None else version
    wanted = at.of(partitions if table.partition_by is not None else None)
    return _read(spark, table, [f for f in at.folders if f in wanted], evolved)


def write(df: DataFrame, table: Table, below: str) -> list[str]:
    """Write below the table's path; returns the folders that hold rows, as Spark named them."""
    writer = df.write.mode("errorifexists")
    if table.partition_by is None:
        writer.parquet(f"{table.path}/{below}")
        return [below]
    writer.partitionBy(table.partition_by).parquet(f"{table.path}/{below}")
    found = children(df.sparkSession, f"{table.path}/{below}")
    return [f"{below}/{n}" for n in found if n.startswith(f"{table.partition_by}=")]


def generation(spark: SparkSession, table: Table) -> str:
    """A folder for what one writer adds; the number only says what was there when it began."""
    return f"g={max(versions.numbers(spark, table.path), default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"


def _spread(df: DataFrame, table: Table) -> DataFrame:
    return rebalanced(df, [table.partition_by] if table.partition_by else [], table.sort_by)


def _sorted(df: DataFrame, table: Table) -> DataFrame:
    return df.sortWithinPartitions(table.partition_by, *table.sort_by)


def load_append(df: DataFrame, table: Table, loaded_at, batch: Batch | None = None) -> Version:
    """Add rows to a landing table, stamped with the load time; a ``batch`` is added once."""
    spark = df.sparkSession
    newest = versions.current(spark, table.path)
    if newest.holds(batch):
        return newest
    rows = df.withColumn("_loaded_at", literal(loaded_at))
    added = write(_spread(rows, table), table, generation(spark, table))
    return commit(spark, table.path, added, versions.APPEND, batch=batch)


def load_replace(df: DataFrame, table: Table, base: Version | None = None) -> Version:
    """Put ``df`` in place of the whole table; the old rows stay readable until the commit.

    With ``base``, the version ``df`` was made from, a table that has changed since is left alone.
    """
    spark = df.sparkSession
    added = write(_spread(df, table), table, generation(spark, table))
    return commit(spark, table.path, added, versions.REPLACE, base, partitions=None)


@dataclass(frozen=True)
class Staged:
    """A merge source, written once: its rows, the partitions they lie in, and its size."""

    rows: DataFrame
    path: str
    partitions: list[str] | None
    count: int
    file_bytes: int

    @property
    def small(self) -> bool:
        return self.count <= SMALL_SOURCE_ROWS and self.file_bytes <= SMALL_SOURCE_BYTES


def _places(df: DataFrame) -> dict[str, Column]:
    """Columns that tell the order of the input.

    Spark deals files to tasks by size, so over several files the number of a row in its task is no
    order; with the file and the block, of which one task reads all, it is.
    """
    number = {"_at_row": F.monotonically_increasing_id()}
    file = {"_at_file": F.col("_metadata.file_path"), "_at_block": F.col("_metadata.file_block_start")}
    hidden = df._jdf.queryExecution().analyzed().metadataOutput()
    known = any(hidden.apply(i).name() == "_metadata" for i in range(hidden.size()))
    # Without: not read from files, or joined or grouped since.
    return {**file, **number} if known else number


def stage(df: DataFrame, table: Table, order: Sequence[str] = (), conform: bool = True) -> Staged:
    """Write a source partitioned like the table, one row per key.

    Of repeated keys the row that is last by ``order`` stays; ``order`` empty means the order of
    the input, in which the later row wins: by file name, place of the block in the file and row for
    rows read from files, else by the order of Spark's partitions.
    """
    spark = df.sparkSession
    kinds = {f.name: f for f in table.schema}
    known = T.StructType([kinds[c] for c in df.columns if c in kinds])
    place = {} if order else _places(df)
    rows = df.withColumns(place) if place else df
    rows = M.conformed(rows, known) if conform else rows
    rows = dedupe_latest(rows, table.key, order or list(place)).drop(*place)
    below, seen = f"{STAGE}/{uuid.uuid4().hex}", Observation()
    schema = _nullable(rows.schema)
    folders = write(rows.observe(seen, F.count("*").alias("rows")), table, below)
    path = f"{table.path}/{below}"
    fs, handle = handle_of(spark, path)
    stored = spark.read.schema(schema).parquet(path) if folders else empty(spark, schema)
    return Staged(
        stored.select(*schema.names), path,
        [f.split("/")[-1] for f in folders] if table.partition_by else None,
        seen.get.get("rows", 0), fs.getContentSummary(handle).getLength(),
    )


def merge_staged(
    spark: SparkSession, table: Table, staged: Staged, how: Callable[..., DataFrame],
    evolve: bool = False, batch: Batch | None = None, **options,
) -> dict[str, int]:
    """Merge a staged source into the table and return the row counts, taken from the write.

    Runs again if another writer has changed the same partitions meanwhile. A ``batch`` that the table
    holds already is left alone, and its counts are returned.

    A small source leaves the target rows in the partitions they were read in, so they are sorted
    and written back without a shuffle. With ``evolve`` the table keeps columns it was never
    declared with: those of earlier loads and the new ones of this source.
    """
    for attempt in range(MERGE_ATTEMPTS):
        base = versions.current(spark, table.path)
        if base.holds(batch):
            return dict(base.batches[batch.stream].counts)
        target = read_table(spark, table, evolve, staged.partitions, base)
        if evolve:
            new = {f.name: f.dataType for f in staged.rows.schema if f.name not in target.columns}
            target = target.withColumns({n: F.lit(None).cast(k) for n, k in new.items()})
        merged = how(target, staged.rows, small_source=staged.small, **options)
        seen = Observation()
        in_place = staged.small and table.partition_by is not None
        spread = _sorted(merged, table) if in_place else _spread(merged, table)
        rows = spread.observe(
            seen,
            *[
                F.count_if(F.col(M.ACTION) == action).alias(name)
                for action, name in ((M.INSERT, "inserted"), (M.UPDATE, "updated"), (M.KEEP, "unchanged"))
            ],
        )
        below = generation(spark, table)
        written = write(rows.drop(M.ACTION), table, below)
        counts = {"inserted": 0, "updated": 0, "unchanged": 0, **seen.get}
        note = batch and Batch(batch.stream, batch.id, counts)
        try:
            commit(spark, table.path, written, versions.MERGE, base, staged.partitions, batch=note)
            return counts
        except Conflict:
            delete_folder(spark, f"{table.path}/{below}")
            if attempt + 1 == MERGE_ATTEMPTS:
                raise
    raise AssertionError("unreachable")


def apply_merge(
    spark: SparkSession,
    table: Table,
    source: DataFrame,
    how: Callable[..., DataFrame],
    order: Sequence[str] = (),
    evolve: bool = False,
    batch: Batch | None = None,
    **options,
) -> dict[str, int]:
    """Merge ``source``, one row per key by ``order``, into the table with a merge operator."""
    staged = stage(source, table, order)
    try:
        return merge_staged(spark, table, staged, how, evolve, batch, **options)
    finally:
        delete_folder(spark, staged.path)


def load_merge(
    df: DataFrame, table: Table, as_of: Column | None = None, order: Sequence[str] = (),
    evolve: bool = False,
) -> dict[str, int]:
    """Upsert by the table's key, rows replaced whole; of repeated source keys the later wins."""
    return apply_merge(
        df.sparkSession, table, df, M.merge_upsert, order, evolve, key=table.key, as_of=as_of
    )


FACT_COLUMNS = [
    "country_code", "country_name", "short_name", "iso_alpha2", "year", "record_type",
    *schemas.MEASURES, "score", "carbon_pct_of_total", "extracted_at", "transformed_at",
]


def insert_or_replace(df: DataFrame, path: str) -> dict[str, int]:
    """Upsert the 17 fact columns; missing ones are null."""
    kinds = {f.name: f.dataType for f in schemas.STAGING}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in FACT_COLUMNS])
    return load_merge(shaped(df, schema), fact_table(path, schema))


def multi_target(
    df: DataFrame, targets: Mapping[str, Callable[[DataFrame], object]]
) -> list[dict[str, object]]:
    """Hand one stored set to several loaders; a failing one does not stop the others."""
    results = []
    for name, load in targets.items():
        try:
            results.append({"target": name, "status": "success", "result": load(df)})
        except Exception as error:  # the status of each target is the result
            results.append({"target": name, "status": "failed", "result": str(error)})
    return results
