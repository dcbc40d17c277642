"""Rows put aside and judged again, and fields that change their type."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from snapmart.plans import batch, redrive
from snapmart.sources import drift, variant
from snapmart.tables import store
from tests.conftest import rows
from tests.test_runs_monitor import config, envelope, loaded, put, record


@pytest.fixture
def cfg(spark, path):
    """Two rows without a code, one of a key that is loaded; one without a type; one broken line."""
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 1.0), record(0, 2015, 2.0), record(0, 2016, 3.0)),
        envelope(record(5, 2015, 4.0, kind="")), "{broken")
    cfg = config(path)
    batch.direct_run(spark, cfg)
    return cfg


def coded(rows_):
    return rows_.withColumn("countryCode", F.when(F.col("countryCode") == "0", "1").otherwise(F.col("countryCode")))


def report(spark, cfg):
    return rows(redrive.redrive_report(spark, cfg), "status", "attempt", "rows")


def test_corrected_rows_are_merged_once(spark, cfg):
    assert report(spark, cfg) == [("new", 0, 4)]
    assert redrive.redrive(spark, cfg) == {"judged": 4, "resolved": 0, "bad": 4, "inserted": 0}
    assert report(spark, cfg) == [("bad", 1, 4)]
    done = redrive.redrive(spark, cfg, coded)
    # the fact of 2015 is there already and stays as it is
    assert done == {"judged": 4, "resolved": 2, "bad": 2, "inserted": 1}
    assert loaded(spark, cfg) == [(1, 2015, "EFConsTotGHA", 1.0), (1, 2016, "EFConsTotGHA", 3.0)]
    assert redrive.redrive(spark, cfg, coded) == {"judged": 2, "resolved": 0, "bad": 2, "inserted": 0}
    assert report(spark, cfg) == [("bad", 3, 2), ("resolved", 2, 2)]
    notes = store.read_table(spark, redrive.notes_table(cfg)).where("status = 'bad'")
    assert sorted(r for n in notes.collect() for r in n.reasons) == [
        "no country code", "no record type", "no record type", "no year", "unparsable",
    ]


def test_other_rules_let_rows_pass(spark, cfg):
    """Rules may be relaxed, but a row needs a whole key."""
    done = redrive.redrive(spark, cfg, rules=lambda landed: {"unparsable": F.col("_corrupt_record").isNotNull()})
    assert done == {"judged": 4, "resolved": 0, "bad": 4, "inserted": 0}
    notes = rows(store.read_table(spark, redrive.notes_table(cfg)), "reasons")
    assert notes.count((["no whole key"],)) == 3


def test_a_redrive_that_stops_before_its_notes_is_repeated(spark, cfg, monkeypatch):
    with monkeypatch.context() as m:
        def stop(*args, **options):
            raise RuntimeError("stopped")

        m.setattr(store, "load_merge", stop)
        with pytest.raises(RuntimeError):
            redrive.redrive(spark, cfg, coded)
    assert len(loaded(spark, cfg)) == 2 and report(spark, cfg) == [("new", 0, 4)]
    assert redrive.redrive(spark, cfg, coded)["inserted"] == 0
    assert len(loaded(spark, cfg)) == 2 and report(spark, cfg) == [("bad", 1, 2), ("resolved", 1, 2)]


def test_nothing_put_aside(spark, path):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 1.0)))
    cfg = config(path)
    batch.direct_run(spark, replace(cfg, check=False))
    assert redrive.redrive(spark, cfg) == {"judged": 0, "resolved": 0, "bad": 0, "inserted": 0}
    assert report(spark, cfg) == []


def landed(spark, path, *lines):
    put(f"{path}/v", "a.json", *lines)
    return variant.land_variant(spark, f"{path}/v")


def test_types_of_landed_fields(spark, path):
    records = landed(spark, path, {"a": 1, "b": 1.5, "c": None}, {"a": "x", "b": 22.25, "d": [1]}, {"a": "7", "it's": True, "d": {}}, {})
    found = rows(drift.drift_report(records, {"a": "bigint", "b": "double", "z": "string"}))
    assert found == sorted([
        ("a", "BIGINT", 1, "bigint", True), ("a", "STRING", 2, "bigint", True), ("b", "DECIMAL", 2, "double", False),
        ("c", "VOID", 1, None, False), ("d", "ARRAY", 1, None, True), ("d", "OBJECT", 1, None, True),
        ("it's", "BOOLEAN", 1, None, False),
    ], key=repr)
    assert "a: VARIANT" in drift.merged_schema(records).first()["schema"]
    good, bad = drift.split_misfits(records, {"a": "bigint", "b": "double", "c": "bigint"})
    assert rows(bad, "_reasons") == [(["a: not bigint"],)]
    assert good.count() == 3


def test_types_of_no_records(spark, path):
    records = landed(spark, path, {"a": 1}).where("false")
    assert drift.drift_report(records, {"a": "bigint"}).count() == 0
