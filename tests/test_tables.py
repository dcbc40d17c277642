import glob
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.operators import clean
from snapmart.operators import merge as M
from snapmart.session import scratch_path, shared_dir
from snapmart.tables import layout, state, store, zones
from tests.conftest import plan_of, rows

AT = datetime(2024, 1, 31, 6)
LONGS = schemas.T.StructType().add("id", "long").add("year", "long").add("value", "double")


def table(path, partition="year"):
    return store.Table(f"{path}/t", LONGS, ["id", "year"], partition, ["id"])


def frame(spark, *data):
    return spark.createDataFrame(list(data), LONGS)


def test_merge_touches_only_the_years_of_the_source(spark, path):
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0), (2, 2020, 2.0), (1, 2021, 3.0)), t)
    counts = store.load_merge(frame(spark, (1, 2020, 9.0), (5, 2022, 5.0)), t)
    assert counts == {"inserted": 1, "updated": 1, "unchanged": 1}
    assert len(glob.glob(f"{path}/t/g=*/year=2020")) == 2
    assert len(glob.glob(f"{path}/t/g=*/year=2021")) == 1
    assert rows(store.read_table(spark, t), "id", "year", "value") == [
        (1, 2020, 9.0), (1, 2021, 3.0), (2, 2020, 2.0), (5, 2022, 5.0),
    ]


@pytest.mark.parametrize("small", [True, False])
def test_merging_twice_equals_once(spark, path, small, monkeypatch):
    if not small:
        monkeypatch.setattr(store, "SMALL_SOURCE_ROWS", -1)
    t = table(path)
    store.load_merge(frame(spark, (1, 2020, 1.0)), t)
    for _ in range(2):
        counts = store.load_merge(frame(spark, (1, 2020, 2.0), (2, 2020, 3.0)), t)
    assert counts == {"inserted": 0, "updated": 2, "unchanged": 0}
    assert rows(store.read_table(spark, t), "id", "value") == [(1, 2.0), (2, 3.0)]


def test_unpartitioned_tables_keep_versions(spark, path):
    t = table(path, None)
    assert store.read_table(spark, t).count() == 0
    store.load_replace(frame(spark, (1, 2020, 1.0)), t)
    store.load_merge(frame(spark, (1, 2020, 2.0), (2, 2020, 3.0)), t)
    assert rows(store.read_table(spark, t), "id", "value") == [(1, 2.0), (2, 3.0)]
    os.makedirs(f"{path}/t/g=00000009-x")  # a write that was never committed
    assert store.read_table(spark, t).count() == 2
    store.expire_versions(spark, t, keep=1, grace_hours=0)
    assert len(glob.glob(f"{path}/t/g=*")) == 1 and store.read_table(spark, t).count() == 2


KEYED_BY_TEXT = schemas.T.StructType().add("id", "long").add("part", "string")


def test_replace_keeps_every_partition_whatever_its_name(spark, path):
    names = ["x", "a/b", "c:d", "", None, "é %", "=", "[1]", "01"]
    t = store.Table(f"{path}/t", KEYED_BY_TEXT, ["id", "part"], "part")
    df = spark.createDataFrame(list(enumerate(names)), KEYED_BY_TEXT)
    for _ in range(2):
        store.load_replace(df, t)
    # Spark writes empty text and null into the same folder, so empty text is read as null.
    assert rows(store.read_table(spark, t), "id", "part") == [(i, n or None) for i, n in enumerate(names)]
    store.load_merge(df.filter("id IN (1, 2)"), t)
    assert store.read_table(spark, t).count() == len(names)
    assert rows(store.read_table(spark, t, evolved=True), "part")[0] == ("01",)


def test_replace_keeps_timestamp_partitions(spark, path):
    schema = schemas.T.StructType().add("id", "long").add("at", "timestamp_ntz")
    t = store.Table(f"{path}/t", schema, ["id", "at"], "at")
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 5, 30)), (2, datetime(2024, 1, 1))], schema)
    store.load_replace(df, t)
    store.load_replace(df, t)
    assert rows(store.read_table(spark, t)) == rows(df)


def test_the_later_of_repeated_source_keys_is_stored(spark, path):
    t = table(path)
    for _ in range(2):
        store.load_merge(frame(spark, (1, 2020, 1.0), (2, 2020, 5.0), (1, 2020, 2.0)).coalesce(1), t)
    assert rows(store.read_table(spark, t), "id", "value") == [(1, 2.0), (2, 5.0)]
    store.load_merge(frame(spark, (1, 2020, 9.0), (1, 2020, 3.0)), t, order=["value"])
    assert rows(store.read_table(spark, t), "id", "value") == [(1, 9.0), (2, 5.0)]


def test_the_partition_column_belongs_to_the_key(path):
    with pytest.raises(ValueError, match="partition column year"):
        store.Table(path, LONGS, ["id"], "year")


def test_a_write_that_stops_leaves_the_old_table(spark, path, monkeypatch):
    """Stopped after the new folders are there, and halfway through the manifest."""
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0), (1, 2021, 2.0), (1, 2022, 3.0)), t)
    before = rows(store.read_table(spark, t))

    def stop(*args, **options):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(store, "commit", stop)
        for load in (store.load_merge, store.load_replace):
            with pytest.raises(RuntimeError, match="stopped"):
                load(frame(spark, (1, 2020, 9.0), (1, 2021, 9.0)), t)
    with open(f"{path}/t/{store.MANIFESTS}/00000002", "w") as half:
        half.write("g=00000002-x/year=2020\n")
    assert rows(store.read_table(spark, t)) == before
    store.load_merge(frame(spark, (1, 2021, 9.0)), t)
    assert rows(store.read_table(spark, t), "year", "value") == [(2020, 1.0), (2021, 9.0), (2022, 3.0)]


@pytest.mark.parametrize("small", [True, False])
def test_both_ways_to_merge_give_the_same(spark, path, small, monkeypatch):
    """Narrower and wider source types take the target's; a value that does not fit fails."""
    if not small:
        monkeypatch.setattr(store, "SMALL_SOURCE_ROWS", -1)
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0), (2, 2021, 2.0)), t)
    source = spark.createDataFrame([(1, 2020, 7), (3, 2021, 8)], "id int, year short, value int")
    store.load_merge(source, t)
    got = store.read_table(spark, t)
    assert got.schema == LONGS
    assert rows(got) == [(1, 2020, 7.0), (2, 2021, 2.0), (3, 2021, 8.0)]
    lossy = spark.createDataFrame([(1.5, 2020, 7.0)], "id double, year long, value double")
    with pytest.raises(Exception, match="id does not hold 1.5"):
        store.load_merge(lossy, t)
    target, wide = frame(spark, (1, 2020, 1.0)), source.withColumn("id", F.col("id") + F.lit(0.5))
    with pytest.raises(Exception, match="does not hold"):
        M.merge_upsert(target, wide, ["id", "year"], small_source=small).collect()


def test_new_columns_are_kept_where_asked(spark, path):
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0), (1, 2021, 2.0)), t)
    more = frame(spark, (1, 2021, 5.0)).withColumn("score", F.lit("3A"))
    store.load_merge(more, t, evolve=True)
    store.load_merge(frame(spark, (2, 2021, 6.0)), t, evolve=True)
    found = store.read_table(spark, t, evolved=True)
    assert rows(found, "id", "year", "value", "score") == [
        (1, 2020, 1.0, None), (1, 2021, 5.0, "3A"), (2, 2021, 6.0, None),
    ]


def test_replace_drops_partitions_that_are_gone(spark, path):
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0), (1, 2021, 1.0)), t)
    store.load_replace(frame(spark, (2, 2021, 2.0)), t)
    assert rows(store.read_table(spark, t), "id", "year") == [(2, 2021)]


def test_replace_with_nothing_and_with_null_partitions(spark, path):
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0), (2, None, 2.0)), t)
    store.load_replace(frame(spark, (3, None, 3.0)), t)
    assert rows(store.read_table(spark, t), "id") == [(3,)]
    store.load_replace(frame(spark), t)
    assert store.read_table(spark, t).count() == 0


def test_append_adds(spark, path):
    schema = schemas.T.StructType([*LONGS.fields]).add("_loaded_at", "timestamp_ntz")
    t = store.Table(f"{path}/raw", schema, ["id", "year"], "year")
    store.load_append(frame(spark, (1, 2020, 1.0)), t, AT)
    store.load_append(frame(spark, (1, 2020, 1.0)), t, AT)
    assert rows(store.read_table(spark, t), "id", "_loaded_at") == [(1, AT), (1, AT)]


def test_evolved_columns_are_readable(spark, path):
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0)), t)
    store.load_append(frame(spark, (2, 2021, 1.0)).withColumn("score", F.lit("3A")), t, AT)
    assert "score" not in store.read_table(spark, t).columns
    assert rows(store.read_table(spark, t, evolved=True), "id", "score") == [(1, None), (2, "3A")]


def test_a_key_is_replaced_whole(spark, path):
    """A missing column is null, and the second row wins, nulls included."""
    row = {"country_code": 7, "country_name": "Aland", "year": 2019, "record_type": "BiocapPerCap",
           "value": 3.5, "carbon": 1.25}
    shape = "country_code long, country_name string, year long, record_type string, value double, carbon double"
    store.insert_or_replace(spark.createDataFrame([row], shape), path)
    again = {**row, "country_name": "Aland Islands", "value": 4.5, "carbon": None}
    assert store.insert_or_replace(spark.createDataFrame([again], shape), path)["updated"] == 1
    kinds = {f.name: f for f in schemas.STAGING}
    stored = schemas.T.StructType([kinds[c] for c in store.FACT_COLUMNS])
    back = store.read_table(spark, store.fact_table(path, stored))
    assert rows(back, "country_name", "value", "carbon") == [("Aland Islands", 4.5, None)]
    assert len(back.columns) == 17


def test_counts_of_newer_wins(spark, path):
    kinds = {f.name: f.dataType for f in schemas.STAGING}

    def rows_at(day, *codes):
        df = spark.createDataFrame([(c, 2024, "EF", datetime(2024, 1, day)) for c in codes],
                                   "country_code long, year long, record_type string, transformed_at timestamp_ntz")
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])

    t = store.fact_table(path)
    as_of = F.lit(AT).cast("timestamp_ntz")
    store.apply_merge(spark, t, rows_at(5, 1, 2), M.merge_newer_wins, as_of=as_of)
    counts = store.apply_merge(spark, t, rows_at(6, 2, 3), M.merge_newer_wins, as_of=as_of)
    assert counts == {"inserted": 1, "updated": 1, "unchanged": 1}
    late = store.apply_merge(spark, t, rows_at(4, 1, 2, 3), M.merge_newer_wins, as_of=as_of)
    assert late == {"inserted": 0, "updated": 0, "unchanged": 3}


def test_targets_fail_on_their_own(spark):
    def broken(df):
        raise RuntimeError("no such place")

    done = store.multi_target(spark.range(3), {"a": broken, "b": lambda df: df.count()})
    assert [(r["target"], r["status"], r["result"]) for r in done] == [
        ("a", "failed", "no such place"), ("b", "success", 3),
    ]


def test_a_hot_year_is_written_by_many_tasks(spark, path):
    """A third of the rows in one year must not end in one file."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        df = spark.range(0, 400_000, 1, 16).select(
            F.col("id").alias("country_code"),
            F.when(F.col("id") % 3 == 0, 2010).otherwise(2000 + F.col("id") % 20).alias("year"),
            F.rand(7).alias("value"),
        )
        layout.cluster_layout(df, f"{path}/facts")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = glob.glob(f"{path}/facts/year=2010/*.parquet")
    cold = glob.glob(f"{path}/facts/year=2005/*.parquet")
    assert len(hot) >= 2 * len(cold)
    assert spark.read.parquet(f"{path}/facts").count() == 400_000


def test_only_named_partitions_are_read(spark, path):
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0), (1, 2021, 1.0)), t)
    some = store.read_table(spark, t, partitions=["year=2021"])
    assert all("year=2021" in f for f in some.inputFiles()) and some.count() == 1
    plan = plan_of(store.read_table(spark, t).filter("year = 2021"))
    assert "PartitionFilters: []" not in plan and "2021" in plan


def test_small_is_told_from_rows_and_files(spark, path):
    staged = store.stage(frame(spark, (1, 2020, 1.0), (1, 2021, 1.0)), table(path))
    assert staged.count == 2 and staged.partitions == ["year=2020", "year=2021"] and staged.small
    assert not store.Staged(staged.rows, "", [], store.SMALL_SOURCE_ROWS + 1, 1).small
    assert not store.Staged(staged.rows, "", [], 1, store.SMALL_SOURCE_BYTES + 1).small


def test_raw_snapshots_are_immutable(spark, path):
    done = zones.write_raw_snapshot(frame(spark, (1, 2020, 1.0)), path, AT)
    assert done["record_count"] == 1 and done["path"].endswith("raw/snapshot=20240131_060000")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        zones.write_raw_snapshot(frame(spark, (1, 2020, 1.0)), path, AT)


def test_transformed_paths():
    assert zones.transformed_path("lake/raw/facts_20240130.json") == (
        "lake/transformed/facts_20240130_transformed.json"
    )
    assert zones.transformed_path("raw/snapshot=1") == "transformed/snapshot=1_transformed"


def test_retention(spark, path):
    days = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 3, 1)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, at date")
    for zone in ("processed", "failed"):
        layout.partitioned_layout(df, path, zone, "at")
    gone = zones.expire_partitions(spark, path, "processed", date(2024, 2, 1))
    assert [g[-24:] for g in gone] == ["year=2024/month=01/day=01"[-24:]]
    assert rows(spark.read.parquet(f"{path}/processed"), "id") == [(1,), (2,)]
    assert spark.read.parquet(f"{path}/failed").count() == 3


def test_zones_in_one_pass(spark, path):
    df = frame(spark, (1, 2020, 1.0), (2, 1800, -1.0))
    flagged = clean.flag_reasons(df, {"year": F.col("year") < 1960, "value": F.col("value") < 0})
    layout.write_zones(flagged, f"{path}/z")
    assert rows(spark.read.parquet(f"{path}/z/zone=failed"), "id", "_reasons") == [(2, ["year", "value"])]
    assert rows(spark.read.parquet(f"{path}/z/zone=good"), "id") == [(1,)]


@pytest.mark.parametrize(
    "last, force, window",
    [(None, False, (2010, 2024)), (2005, False, (2010, 2024)), (2010, False, (2010, 2024)),
     (2015, False, (2014, 2024)), (2030, False, (2029, 2024)), (2015, True, (2010, 2024))],
)
def test_year_window(last, force, window):
    assert state.year_window(last, 2010, 2024, force) == window


def test_newest_state_counts(spark, path):
    assert state.last_year_of(state.read_state(spark, path), "facts") is None
    state.write_state(spark, path, "facts", 2020, "b", datetime(2024, 1, 2))
    state.write_state(spark, path, "facts", 2018, "a", datetime(2024, 1, 1))
    state.write_state(spark, path, "other", 1999, "c", datetime(2024, 1, 3))
    assert state.last_year_of(state.read_state(spark, path), "facts") == 2020


def test_run_log(spark, path):
    state.log_run(spark, path, "r1", "LOAD", "SUCCESS", AT, 5, 1200, metadata={"target": "main"})
    state.log_run(spark, path, "r1", "RUN", "FAILED", AT, error="boom")
    found = state.read_run_log(spark, path).orderBy("stage").collect()
    assert [(r.stage, r.status, r.records_processed, r.metadata) for r in found] == [
        ("LOAD", "SUCCESS", 5, {"target": "main"}), ("RUN", "FAILED", None, {}),
    ]


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == shared_dir(spark)


def test_checkpoint_cuts_lineage(spark):
    df = layout.materialise(spark.range(10).withColumn("r", F.rand()))
    assert "Rand" not in plan_of(df) and df.count() == 10
