import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.operators.marts import mart_summary
from snapmart.streaming import ingest
from snapmart.tables import store, versions
from snapmart.tables.state import read_run_log
from tests.conftest import rows

AT = datetime(2024, 2, 1)


def as_of():
    return F.lit(AT).cast("timestamp_ntz")


def put(path, name, *records):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as out:
        out.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def record(code, value, day, kind="EFConsTotGHA", **more):
    at = f"2024-01-{day:02d} 00:00:00"
    return {"country_code": code, "country_name": f"C{code}", "year": 2024, "record_type": kind,
            "value": value, "transformed_at": at, **more}


@pytest.fixture
def layers(path):
    return ingest.Layers(store.fact_table(f"{path}/staging"), store.mart_table(f"{path}/mart"))


def take_in(spark, path, layers):
    ingest.ingest_and_merge(
        spark, f"{path}/land", f"{path}/raw", layers, f"{path}/ck", as_of(), as_of()
    )


def staged(spark, layers):
    return rows(store.read_table(spark, layers.staging), "country_code", "record_type", "value")


def test_two_files_then_the_same_again(spark, path, layers):
    put(f"{path}/land", "a.json", record(1, 1.0, 1), record(2, 2.0, 1), record(1, 1.5, 2))
    take_in(spark, path, layers)
    assert staged(spark, layers) == [(1, "EFConsTotGHA", 1.5), (2, "EFConsTotGHA", 2.0)]
    put(f"{path}/land", "b.json", record(2, 9.0, 3), record(1, 0.1, 1), record(3, 3.0, 1, "BiocapTotGHA"))
    take_in(spark, path, layers)
    after = [(1, "EFConsTotGHA", 1.5), (2, "EFConsTotGHA", 9.0), (3, "BiocapTotGHA", 3.0)]
    assert staged(spark, layers) == after
    assert ingest.read_raw(spark, f"{path}/raw").count() == 6
    # the same rows under new names: landed again, nothing changes further on
    put(f"{path}/land", "c.json", record(2, 9.0, 3), record(1, 0.1, 1))
    take_in(spark, path, layers)
    assert staged(spark, layers) == after
    assert ingest.read_raw(spark, f"{path}/raw").count() == 8
    names = [*schemas.MART_KEY, *schemas.MART_METRICS]
    mart = store.read_table(spark, layers.mart)
    assert rows(mart, *names) == rows(mart_summary(store.read_table(spark, layers.staging)), *names)


def test_old_field_names_and_broken_lines(spark, path):
    old = {"countryCode": 7, "countryName": "G", "year": 2024, "record": "EF", "cropLand": 1.5}
    put(f"{path}/land", "a.json", old, "{broken", record(8, 1.0, 1))
    ingest.auto_ingest(
        spark, f"{path}/land", f"{path}/raw", f"{path}/ck", loaded_at=as_of()
    ).awaitTermination()
    found = ingest.read_raw(spark, f"{path}/raw")
    assert rows(found, "country_code", "record_type", "crop_land", "_loaded_at") == [
        (7, "EF", 1.5, AT), (8, "EFConsTotGHA", None, AT),
    ]
    bad = ingest.read_raw(spark, f"{path}/raw", corrupt=True)
    assert rows(bad, "_corrupt_record") == [("{broken",)]


def test_a_batch_delivered_twice_lands_once(spark, path):
    """The checkpoint is lost after the batch was written: the folder of the batch is written over."""
    put(f"{path}/land", "a.json", record(1, 1.0, 1))
    for mark in ("ck1", "ck2"):
        ingest.auto_ingest(spark, f"{path}/land", f"{path}/raw", f"{path}/{mark}").awaitTermination()
    assert ingest.read_raw(spark, f"{path}/raw").count() == 1


def test_mart_of_touched_keys_keeps_other_metrics(spark, path, layers):
    put(f"{path}/land", "a.json", record(1, 10.0, 1), record(1, 7.0, 1, "BiocapTotGHA"))
    take_in(spark, path, layers)
    put(f"{path}/land", "b.json", record(1, 12.0, 2))
    take_in(spark, path, layers)
    row = store.read_table(spark, layers.mart).first()
    assert (row.total_ecological_footprint, row.total_biocapacity, row.ecological_deficit) == (12.0, 7.0, 5.0)


def test_a_stream_that_stops_between_staging_and_mart_goes_on_there(spark, path, layers, monkeypatch):
    """The batch is delivered again; tables, counts and log are as if nothing had happened."""
    layers = ingest.Layers(layers.staging, layers.mart, f"{path}/runs")
    put(f"{path}/land", "a.json", record(1, 1.0, 1), record(2, 2.0, 1))
    ingest.auto_ingest(spark, f"{path}/land", f"{path}/raw", f"{path}/ck1", loaded_at=as_of()).awaitTermination()
    seen = []

    def run():
        stream = ingest.raw_stream(spark, f"{path}/raw")
        ingest.stream_merge(
            stream, layers, f"{path}/ck2", as_of=as_of(), on_done=lambda i, d: seen.append((i, d))
        ).awaitTermination()

    def stop(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(ingest, "refresh_mart", stop)
        with pytest.raises(Exception, match="killed"):
            run()
    assert store.read_table(spark, layers.staging).count() == 2
    assert store.read_table(spark, layers.mart).count() == 0
    run()
    counts = {"inserted": 2, "updated": 0, "unchanged": 0}
    assert seen == [(0, {"staging": counts, "mart": counts})]
    assert versions.current(spark, layers.staging.path).number == 1
    log = read_run_log(spark, layers.log_path).collect()
    assert [(r.stage, r.records_processed, r.metadata["staging_inserted"]) for r in log] == [("MERGE", 2, "2")]
    # once more, when everything is there: nothing is read, written or logged
    mark = versions.Batch(ingest.stream_name(spark, f"{path}/ck2"), 0)
    again = ingest.merge_batch(ingest.read_raw(spark, f"{path}/raw"), layers, as_of(), mark)
    assert again == {"staging": counts, "mart": counts}
    assert versions.current(spark, layers.mart.path).number == 1
    assert read_run_log(spark, layers.log_path).count() == 1


def test_changes_of_a_table_are_merged_once(spark, path, layers):
    """A landing table under a manifest feeds staging, version by version."""
    schema = schemas.T.StructType([f for f in ingest.RAW_FILES if f.name in schemas.RAW.names])
    source = store.Table(f"{path}/landing", schema, schemas.FACT_KEY, "year")

    def rows_of(*facts):
        df = spark.createDataFrame([(c, 2024, "EFConsTotGHA", v, datetime(2024, 1, d)) for c, v, d in facts],
                                   "country_code long, year long, record_type string, value double, transformed_at timestamp_ntz")
        return store.shaped(df, schema)

    def run():
        ingest.merge_changes(spark, source, layers, f"{path}/ck", as_of=as_of()).awaitTermination()

    store.load_append(rows_of((1, 1.0, 1), (2, 2.0, 1)), source, AT)
    store.load_append(rows_of((1, 3.0, 2)), source, AT)
    run()
    assert rows(store.read_table(spark, layers.staging), "country_code", "value") == [(1, 3.0), (2, 2.0)]
    store.load_append(rows_of((2, 9.0, 1), (2, 5.0, 3)), source, AT)
    run()
    run()
    assert rows(store.read_table(spark, layers.staging), "country_code", "value") == [(1, 3.0), (2, 5.0)]
    assert versions.current(spark, layers.staging.path).number == 2


def test_insert_only(spark):
    df = spark.createDataFrame([(1, "INSERT"), (2, "DELETE")], "id int, change_action string")
    assert rows(ingest.insert_only(df)) == [(1,)]
    assert ingest.insert_only(df.select("id")).count() == 2


def test_a_batch_without_usable_rows_changes_nothing(spark, layers):
    empty = spark.createDataFrame([], ingest.RAW_FILES)
    assert ingest.merge_batch(empty, layers, as_of()) == {}
    assert store.read_table(spark, layers.staging).count() == 0
