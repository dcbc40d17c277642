"""Judging rows put aside once more, by corrected values or rules, and merging those that pass.

What lies below ``failed`` is never changed. A table beside it notes for every row that was judged again
how often, and whether it was resolved; resolved rows are not judged any more. Rows are told apart by the
snapshot they were put aside from and their place in the input. They are merged first and noted after, and
the merge never replaces a row, so a redrive that stops in between is repeated without harm.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schemas
from snapmart.operators import clean, dedupe
from snapmart.operators.merge import merge
from snapmart.plans import batch
from snapmart.session import scratch_path
from snapmart.sources.landed import CORRUPT, INPUT_ORDER, landed_schema
from snapmart.tables import sets, store
from snapmart.tables.layout import literal

RESOLVED, BAD = "resolved", "bad"
NOTES = T.StructType([
    T.StructField("row_id", T.StringType()), T.StructField("attempt", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("reasons", T.ArrayType(T.StringType())),
    T.StructField("_judged_at", T.TimestampNTZType()),
])
REASONS, SNAPSHOT = "_reasons", "snapshot"


def notes_table(cfg: batch.RunConfig) -> store.Table:
    """One row per row that was judged again, with its last verdict."""
    return store.Table(f"{cfg.root}/_redrive", NOTES, ["row_id"])


def put_aside(spark: SparkSession, cfg: batch.RunConfig) -> DataFrame:
    """All fact rows below ``failed`` with their reasons, and a ``row_id``; rows landed in several
    runs are several rows."""
    schema = T.StructType([*landed_schema(), T.StructField(REASONS, T.ArrayType(T.StringType())),
                           T.StructField(SNAPSHOT, T.StringType())])
    root = f"{cfg.root}/failed"
    if not store.list_folders(spark, f"{root}/snapshot=*"):
        return store.empty(spark, schema.add("row_id", "string"))
    rows = spark.read.schema(schema).option("basePath", root).parquet(f"{root}/snapshot=*")
    place = F.to_json(F.struct(SNAPSHOT, *INPUT_ORDER))
    return rows.withColumn("row_id", F.sha2(place, 256))


def pending(spark: SparkSession, cfg: batch.RunConfig) -> DataFrame:
    """Rows put aside and not resolved, with the number of times they were judged again."""
    notes = store.read_table(spark, notes_table(cfg)).select("row_id", "attempt", "status")
    known = put_aside(spark, cfg).join(notes, "row_id", "left")
    open_ = known.where(F.col("status").isNull() | (F.col("status") != RESOLVED)).drop("status")
    return open_.withColumn("attempt", F.coalesce("attempt", F.lit(0).cast("long")))


def _insert_only(target: DataFrame, source: DataFrame, **options) -> DataFrame:
    options.pop("as_of", None)
    return merge(target, source, schemas.FACT_KEY, lambda t, s: F.lit(False), **options)


def redrive(
    spark: SparkSession, cfg: batch.RunConfig, correct: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    rules: Callable[[DataFrame], Mapping[str, Column]] = batch._landed_rules, target: str = "main",
) -> dict[str, int]:
    """Correct the pending rows, judge them by ``rules`` and merge those that pass into the facts.

    ``correct`` maps rows to rows and keeps ``row_id``; text that did not parse can be parsed there, with
    the corrupt column set to null. A row passes if no rule rejects it and it has a whole fact key after
    normalising; of rows with one key, and where the table has the key, the first stays, and the others
    are resolved as well. Returns how many rows were judged, resolved, still bad, and inserted.
    """
    at, table = cfg.now(), cfg.fact(target)
    judged = clean.flag_reasons(correct(pending(spark, cfg)).drop(REASONS), rules(put_aside(spark, cfg)))
    # Judged once and stored, so that what is merged and what is noted agree.
    path = scratch_path(spark, "redrive")
    judged.write.parquet(path)
    judged = spark.read.schema(judged.schema).parquet(path)
    passed = judged.where(F.size(REASONS) == 0)
    facts = clean.normalise_records(passed, at, keep=[*INPUT_ORDER, "row_id"])
    whole = clean.require_fields(facts)
    resolved = whole.select("row_id", F.lit(True).alias("ok"))
    verdicts = judged.select("row_id", "attempt", REASONS).join(resolved, "row_id", "left")
    ok = F.coalesce("ok", F.lit(False))
    why = F.when(~ok & (F.size(REASONS) == 0), F.array(F.lit("no whole key"))).otherwise(F.col(REASONS))
    notes = verdicts.select(
        "row_id", (F.col("attempt") + 1).alias("attempt"), F.when(ok, RESOLVED).otherwise(BAD).alias("status"),
        why.alias("reasons"), literal(at).alias("_judged_at"),
    )
    first = dedupe.dedupe_first(whole, schemas.FACT_KEY, INPUT_ORDER).drop(*INPUT_ORDER, "row_id")
    rows = batch.staging_rows(batch._described(first, None), at)
    with sets.together(spark, cfg.tables(target)):
        counts = store.apply_merge(spark, table, rows, _insert_only, order=["transformed_at"])
    # Counted as they are written, so that the verdicts are not joined a second time.
    seen = Observation()
    counted = [F.count_if(F.col("status") == status).alias(status) for status in (RESOLVED, BAD)]
    store.load_merge(notes.observe(seen, *counted), notes_table(cfg))
    by = {RESOLVED: 0, BAD: 0, **seen.get}
    return {"judged": sum(by.values()), **by, "inserted": counts["inserted"]}


def redrive_report(spark: SparkSession, cfg: batch.RunConfig) -> DataFrame:
    """status (new, bad, resolved), attempt and rows of everything put aside."""
    notes = store.read_table(spark, notes_table(cfg)).select("row_id", "attempt", "status")
    known = put_aside(spark, cfg).select("row_id").join(notes, "row_id", "left")
    return known.groupBy(
        F.coalesce("status", F.lit("new")).alias("status"), F.coalesce("attempt", F.lit(0).cast("long")).alias("attempt")
    ).agg(F.count("*").alias("rows"))
