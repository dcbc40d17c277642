from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.operators import dedupe
from snapmart.operators import merge as M
from tests.conftest import plan_of, rows

OLD, NEW, LATER = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 2, 1)
KEY = ["country_code", "year", "record_type"]
FACT = "country_code long, year long, record_type string, value double, pos long"
SMALL = "id long, value double, name string, transformed_at timestamp_ntz, _loaded_at timestamp_ntz, _updated_at timestamp_ntz"


def test_first_row_wins(spark):
    df = spark.createDataFrame(
        [(1, 2024, "EF", 200.0, 2), (1, 2024, "EF", 100.0, 1), (1, 2023, "EF", 150.0, 3)], FACT
    )
    found = dedupe.dedupe_first(df, KEY, ["pos"])
    assert rows(found, "year", "value") == [(2023, 150.0), (2024, 100.0)]


def test_latest_row_wins_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, None, NEW, 1.0), (1, OLD, OLD, 2.0), (2, NEW, OLD, 3.0), (2, NEW, NEW, 4.0),
         (3, None, OLD, 5.0), (3, None, NEW, 6.0)],
        "id long, transformed_at timestamp_ntz, _loaded_at timestamp_ntz, value double",
    )
    found = dedupe.dedupe_latest(df, ["id"])
    assert rows(found, "id", "value") == [(1, 2.0), (2, 4.0), (3, 6.0)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") < 20_000, 1).otherwise(F.col("id")).alias("k"), "id"
    )
    plan = plan_of(dedupe.dedupe_first(df, ["k"], ["id"]))
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and plan.index("Exchange hashpartitioning") < partial


def test_stats(spark):
    df = spark.createDataFrame(
        [(1, 2024, "EF", 1.0, 1), (1, 2024, "EF", 2.0, 2), (0, 2024, "EF", 1.0, 3),
         (None, 2024, "EF", 1.0, 4), (2, 2024, None, 1.0, 5), (2, 2024, None, 1.0, 6)], FACT,
    )
    found = dedupe.dedupe_stats(df, ["country_code", "year"]).first().asDict()
    assert found == {"rows_in": 6, "invalid": 2, "valid": 4, "kept": 2, "duplicates": 2}


def test_stats_of_nothing(spark):
    found = dedupe.dedupe_stats(spark.createDataFrame([], FACT), ["year"]).first().asDict()
    assert set(found.values()) == {0}


def loads(spark, target, source):
    return spark.createDataFrame(target, SMALL), spark.createDataFrame(source, SMALL)


@pytest.mark.parametrize("small", [False, True])
def test_newer_wins(spark, small):
    """Newer, older, equal and unknown times on either side; new and untouched keys."""
    target, source = loads(
        spark,
        [(k, 1.0, "t", at, OLD, OLD) for k, at in
         [(1, OLD), (2, NEW), (3, OLD), (4, None), (5, OLD), (6, OLD), (8, None)]],
        [(k, 2.0, None, at, NEW, NEW) for k, at in
         [(1, NEW), (2, OLD), (3, OLD), (4, OLD), (5, None), (7, None), (8, None)]],
    )
    found = M.merge_newer_wins(target, source, ["id"], as_of=F.lit(LATER), small_source=small)
    assert rows(found, "id", "value", "name", "_loaded_at", "_updated_at", "_action") == sorted(
        [
            (1, 2.0, None, OLD, LATER, "update"), (2, 1.0, "t", OLD, OLD, "keep"),
            (3, 1.0, "t", OLD, OLD, "keep"), (4, 2.0, None, OLD, LATER, "update"),
            (5, 1.0, "t", OLD, OLD, "keep"), (6, 1.0, "t", OLD, OLD, "keep"),
            (7, 2.0, None, NEW, LATER, "insert"), (8, 2.0, None, OLD, LATER, "update"),
        ],
        key=repr,
    )
    counts = M.merge_counts(found).first()
    assert tuple(counts) == (1, 3, 4)


@pytest.mark.parametrize("small", [False, True])
def test_upsert_replaces_the_row_whole(spark, small):
    target, source = loads(
        spark, [(1, 100.0, "Original", OLD, OLD, OLD)], [(1, 200.0, None, None, NEW, NEW)]
    )
    found = M.merge_upsert(target, source, ["id"], small_source=small)
    assert rows(found, "id", "value", "name", "transformed_at", "_loaded_at") == [
        (1, 200.0, None, None, NEW)
    ]


@pytest.mark.parametrize("small", [False, True])
def test_a_row_without_key_fails_the_job(spark, small):
    target, source = loads(
        spark, [(1, 1.0, "t", OLD, OLD, OLD)], [(None, 1.0, "s", OLD, OLD, OLD)]
    )
    with pytest.raises(SparkRuntimeException, match="merge key is null"):
        M.merge_upsert(target, source, ["id"], small_source=small).collect()


def test_small_source_does_not_shuffle_the_target(spark):
    target = spark.range(1000).select("id", F.col("id").cast("double").alias("value"))
    source = spark.range(900, 1100).select("id", F.lit(-1.0).alias("value"))
    merged = M.merge_upsert(target, source, ["id"], small_source=True)
    plan = plan_of(merged)
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert tuple(M.merge_counts(merged).first()) == (100, 100, 900)


def test_reference_rows(spark):
    target = spark.createDataFrame(
        [("EFConsTotGHA", "old", "x", None, None), ("Own", "mine", "y", True, "z")],
        schemas.RECORD_TYPES,
    )
    found = M.merge_reference(target)
    assert found.count() == len(schemas.RECORD_TYPE_ROWS) + 1
    kept = found.filter("record_type = 'Own'").first()
    assert (kept.description, kept._action) == ("mine", "keep")
    new = found.filter("record_type = 'EFConsTotGHA'").first()
    assert new.description == "Total Ecological Footprint of Consumption"


def test_insert_events_update_only_their_columns(spark):
    shape = "unique_key string, country_name string, carbon_footprint_gha double, score string, extracted_at timestamp_ntz, transformed_at timestamp_ntz"
    target = spark.createDataFrame([("a", "A", 1.0, "x", OLD, OLD)], shape)
    changes = spark.createDataFrame(
        [("a", "B", 2.0, "y", NEW, OLD, "INSERT"), ("a", "C", 3.0, "z", NEW, NEW, "INSERT"),
         ("b", "D", 4.0, "w", NEW, NEW, "INSERT"), ("c", "E", 5.0, "v", NEW, NEW, "DELETE")],
        shape + ", change_action string",
    )
    found = M.merge_insert_events(target, changes)
    assert rows(found, "unique_key", "country_name", "carbon_footprint_gha") == [
        ("a", "A", 3.0), ("b", "D", 4.0),
    ]


stamps = st.one_of(st.none(), st.integers(0, 3).map(lambda d: datetime(2024, 1, 1 + d)))
loaded = st.lists(st.tuples(st.integers(0, 5), stamps, st.integers(0, 9)), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(before=loaded, after=loaded)
def test_merging_twice_equals_merging_once(spark, before, after):
    """Against brute force, for rows whose times are all known; and keys stay unique."""
    shape = "id long, transformed_at timestamp_ntz, value long, pos long"

    def frame(data, shift):
        data = [(k, at or datetime(2023, 1, 1), v, i + shift) for i, (k, at, v) in enumerate(data)]
        df = spark.createDataFrame(data, shape)
        return data, dedupe.dedupe_latest(df, ["id"], ["transformed_at"], ["pos"])

    target_rows, target = frame(before, 0)
    source_rows, source = frame(after, 100)
    once = M.merge_newer_wins(target, source, ["id"]).drop("_action")
    twice = M.merge_newer_wins(once, source, ["id"]).drop("_action")

    def best(data):
        out = {}
        for row in data:
            if row[0] not in out or (row[1], row[3]) > (out[row[0]][1], out[row[0]][3]):
                out[row[0]] = row
        return out

    expected = best(target_rows)
    for k, row in best(source_rows).items():
        if k not in expected or row[1] > expected[k][1]:
            expected[k] = row
    assert rows(once) == sorted(expected.values(), key=repr)
    assert rows(twice) == rows(once)
