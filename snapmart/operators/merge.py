"""Upserts as joins; writing the result is the business of ``tables``.

Keys must be unique on both sides (dedupe the source first; ``tables.store`` does), so no key can be
hot in the join. A row without a key fails the job when it is reached, and so does a source value
that the target's type does not hold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schemas
from snapmart.operators.dedupe import dedupe_latest

ACTION = "_action"
INSERT, UPDATE, KEEP = "insert", "update", "keep"

Matched = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def _target(name: str) -> Column:
    return F.col(f"t.{name}")


def _source(name: str) -> Column:
    return F.col(f"s.{name}")


def _fits(name: str, have: T.DataType, want: T.DataType) -> Column:
    """The column in the wanted type; a value that changes on the way fails the job."""
    col = F.col(name)
    cast = col.cast(want)
    exact = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if not isinstance(have, exact) or not isinstance(want, exact):
        return cast.alias(name)
    lost = F.raise_error(F.concat(F.lit(f"{name} does not hold "), col.cast("string")))
    same = cast.cast(have).eqNullSafe(col)
    return F.when(same, cast).otherwise(lost.cast(want)).alias(name)


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of the schema in its types; other columns stay as they are."""
    kinds = {f.name: f.dataType for f in schema}
    return df.select(
        *[
            _fits(f.name, f.dataType, kinds[f.name])
            if f.name in kinds and f.dataType != kinds[f.name]
            else F.col(f.name)
            for f in df.schema
        ]
    )


def newer(ts: str = "transformed_at") -> Matched:
    """Source strictly newer, or target never stamped; equal times do not update."""
    return lambda t, s: (s(ts) > t(ts)) | t(ts).isNull()


def merge(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    when_matched: Matched | None = None,
    update: Sequence[str] | None = None,
    stamp: tuple[str, Column] | None = None,
    insert_unmatched: bool = True,
    small_source: bool = False,
) -> DataFrame:
    """Target after the merge, with an ``_action`` column telling what happened to each row.

    ``update`` names the columns a match replaces (default: all but the key). ``stamp`` sets a
    column on inserted and updated rows. With ``small_source`` (the caller has counted the
    source) the target is not shuffled: it is left-joined to a broadcast of the source, and the
    inserts come from an anti join against the matched keys, which are no more than the source.
    Target rows then stay in the partitions they were read in.
    """
    on, columns = list(key), target.columns
    source = conformed(source, target.schema)
    given, kinds = set(source.columns), {f.name: f.dataType for f in target.schema}
    no_key = F.raise_error(F.lit("merge key is null"))
    replaced = {c for c in columns if c not in on} if update is None else set(update)

    def pick(name: str) -> Column:
        if stamp and name == stamp[0]:
            fresh = stamp[1].cast(kinds[name])
            return F.when(F.col(ACTION) == KEEP, _target(name)).otherwise(fresh).alias(name)
        src = _source(name) if name in given else F.lit(None)
        if name in on:
            return F.coalesce(_target(name), _source(name), no_key).alias(name)
        fresh = F.col(ACTION).isin(INSERT, UPDATE) if name in replaced else F.col(ACTION) == INSERT
        return F.when(fresh, src).otherwise(_target(name)).alias(name)

    t = target.withColumn("_in", F.lit(True)).alias("t")
    s = source.withColumn("_in", F.lit(True)).alias("s")
    same = [_target(k) == _source(k) for k in on]
    matched = _target("_in").isNotNull() & _source("_in").isNotNull()
    changes = when_matched(_target, _source) if when_matched else F.lit(True)
    action = (
        F.when(_target("_in").isNull(), INSERT)
        .when(matched & changes, UPDATE)
        .otherwise(KEEP)
    )

    def result(joined: DataFrame) -> DataFrame:
        return joined.withColumn(ACTION, action).select(*[pick(c) for c in columns], ACTION)

    if not small_source:
        how = "full_outer" if insert_unmatched else "left_outer"
        return result(t.join(s, same, how))

    kept = result(t.join(F.broadcast(s), same, "left_outer"))
    if not insert_unmatched:
        return kept
    seen = target.select(*on).join(F.broadcast(source.select(*on)), on, "left_semi")
    fresh = source.join(F.broadcast(seen), on, "left_anti")

    def new_value(name: str) -> Column:
        if stamp and name == stamp[0]:
            return stamp[1].cast(kinds[name]).alias(name)
        col = F.col(name) if name in given else F.lit(None)
        col = F.coalesce(col, no_key) if name in on else col
        return col.cast(kinds[name]).alias(name)

    inserted = fresh.select(*[new_value(c) for c in columns], F.lit(INSERT).alias(ACTION))
    return kept.unionByName(inserted.hint("rebalance"))


def merge_newer_wins(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str] = tuple(schemas.FACT_KEY),
    ts: str = "transformed_at",
    as_of: Column | None = None,
    small_source: bool = False,
) -> DataFrame:
    """Insert new keys; replace a row only by one stamped later. The load time of a row stays."""
    kept = {*key, "_loaded_at"}
    return merge(
        target,
        source,
        key,
        when_matched=newer(ts),
        update=[c for c in target.columns if c not in kept],
        stamp=("_updated_at", as_of) if as_of is not None else None,
        small_source=small_source,
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    as_of: Column | None = None,
    small_source: bool = False,
) -> DataFrame:
    """Insert new keys, replace matched rows whole: nulls of the source win too."""
    return merge(
        target,
        source,
        key,
        stamp=("_updated_at", as_of) if as_of is not None else None,
        small_source=small_source,
    )


def merge_refresh(
    target: DataFrame, source: DataFrame, key: Sequence[str], as_of: Column
) -> DataFrame:
    """Full refresh rule: matched rows are always replaced, but keep their load time."""
    kept = {*key, "_loaded_at"}
    return merge(
        target,
        source,
        key,
        update=[c for c in target.columns if c not in kept],
        stamp=("_updated_at", as_of),
    )


def merge_mart(
    mart: DataFrame, summary: DataFrame, as_of: Column, small_source: bool = False
) -> DataFrame:
    return merge_upsert(mart, summary, schemas.MART_KEY, as_of, small_source)


def merge_reference(target: DataFrame, rows: Sequence[tuple] | None = None) -> DataFrame:
    """Upsert the fixed record type rows; they are few, so the target is not shuffled."""
    spark = target.sparkSession
    names = ["record_type", "description", "category", "is_per_capita", "unit"]
    fixed = spark.createDataFrame(list(rows or schemas.RECORD_TYPE_ROWS), schemas.RECORD_TYPES)
    # Only the fixed rows are known to be few.
    return merge(target, fixed, ["record_type"], update=names[1:], small_source=rows is None)


def merge_insert_events(
    target: DataFrame,
    changes: DataFrame,
    key: str = "unique_key",
    update: Sequence[str] = ("carbon_footprint_gha", "score", "extracted_at", "transformed_at"),
    action_col: str = "change_action",
    order: Sequence[str] = ("transformed_at",),
    as_of: Column | None = None,
) -> DataFrame:
    """Upsert the change rows whose action is INSERT; a match replaces only ``update``."""
    inserts = changes.filter(F.col(action_col) == "INSERT").drop(action_col)
    source = dedupe_latest(inserts, [key], order)
    return merge(
        target,
        source,
        [key],
        update=update,
        stamp=("_updated_at", as_of) if as_of is not None else None,
    )


def merge_counts(merged: DataFrame) -> DataFrame:
    """inserted, updated and unchanged rows of a merge result."""
    return merged.agg(
        F.count_if(F.col(ACTION) == INSERT).alias("inserted"),
        F.count_if(F.col(ACTION) == UPDATE).alias("updated"),
        F.count_if(F.col(ACTION) == KEEP).alias("unchanged"),
    )


def rebuild_staging(raw: DataFrame, staging: DataFrame, as_of: Column) -> DataFrame:
    """Staging recomputed from every landed row."""
    return merge_refresh(staging, dedupe_latest(raw), schemas.FACT_KEY, as_of)
