"""Tables that change together, and files that are loaded once."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import types as T

from snapmart.plans import batch
from snapmart.streaming import ingest
from snapmart.tables import ledger, sets, store, versions
from tests.conftest import rows
from tests.test_runs_monitor import NOW, config, envelope, put, record
from tests.test_tables import AT, frame, table


@pytest.fixture
def pair(path):
    """Facts and a mart, here plain tables."""
    return sets.TableSet(f"{path}/_set", {"facts": table(f"{path}/f"), "mart": table(f"{path}/m")})


def both(spark, pair):
    at = sets.current_set(spark, pair)
    return [rows(sets.read_from(spark, pair, n, at), "value") for n in ("facts", "mart")]


def write_both(spark, pair, value, between=None):
    with sets.together(spark, pair):
        store.load_merge(frame(spark, (1, 2020, value)), pair.tables["facts"])
        if between:
            between()
        store.load_merge(frame(spark, (1, 2020, value)), pair.tables["mart"])


def stop():
    raise RuntimeError("stopped")


def test_a_stop_between_two_tables_leaves_the_old_set(spark, pair):
    assert both(spark, pair) == [[], []]
    write_both(spark, pair, 1.0)
    with pytest.raises(RuntimeError):
        write_both(spark, pair, 2.0, stop)
    # the table alone has moved on, the set has not
    assert rows(store.read_table(spark, pair.tables["facts"]), "value") == [(2.0,)]
    assert both(spark, pair) == [[(1.0,)], [(1.0,)]]
    # the next writer undoes the half that is there
    with sets.together(spark, pair):
        store.load_merge(frame(spark, (2, 2020, 3.0)), pair.tables["mart"])
    assert both(spark, pair) == [[(1.0,)], [(1.0,), (3.0,)]]
    assert sets.current_set(spark, pair).number == 2


def test_of_two_writers_of_a_set_one_wins_whole(spark, pair):
    write_both(spark, pair, 1.0)
    with pytest.raises(versions.Conflict, match="another writer"):
        write_both(spark, pair, 2.0, lambda: write_both(spark, pair, 3.0))
    assert both(spark, pair) == [[(3.0,)], [(3.0,)]]
    write_both(spark, pair, 4.0)
    assert both(spark, pair) == [[(4.0,)], [(4.0,)]]


def test_commits_to_one_table_join_the_next_version(spark, pair):
    write_both(spark, pair, 1.0)
    store.load_merge(frame(spark, (7, 2021, 7.0)), pair.tables["facts"])
    assert both(spark, pair) == [[(1.0,)], [(1.0,)]]
    add = lambda: store.load_merge(frame(spark, (8, 2021, 8.0)), pair.tables["facts"])
    write_both(spark, pair, 2.0, add)
    assert both(spark, pair) == [[(2.0,), (7.0,), (8.0,)], [(2.0,)]]


def test_expiry_keeps_what_the_set_names(spark, pair):
    for value in (1.0, 2.0, 3.0):
        write_both(spark, pair, value)
    with pytest.raises(RuntimeError):
        write_both(spark, pair, 4.0, stop)
    sets.expire_set(spark, pair, keep=1, grace_hours=0)
    assert both(spark, pair) == [[(3.0,)], [(3.0,)]]
    assert [v.number for v in sets.set_versions(spark, pair)] == [3]
    write_both(spark, pair, 5.0)
    assert both(spark, pair) == [[(5.0,)], [(5.0,)]]


def test_a_run_that_stops_after_the_facts_shows_nothing(spark, path, monkeypatch):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 1.0)))
    cfg = config(path, check=False)
    assert batch.batch_run(spark, cfg)["status"] == "success"
    put(f"{path}/land", "b.json", envelope(record(2, 2024, 2.0), countries=((3, "C"),)))
    with monkeypatch.context() as m:
        m.setattr(batch, "_types_of", lambda facts: stop())
        assert batch.batch_run(spark, replace(cfg, at=NOW.replace(hour=13)))["status"] == "failed"
    named = cfg.tables("main")
    assert rows(sets.read_from(spark, named, "footprint_data"), "country_code") == [(1,)]
    assert rows(sets.read_from(spark, named, "countries"), "country_code") == [(1,), (2,)]
    assert batch.batch_run(spark, replace(cfg, at=NOW.replace(hour=14)))["status"] == "success"
    assert rows(sets.read_from(spark, named, "footprint_data"), "country_code") == [(1,), (2,)]
    assert rows(sets.read_from(spark, named, "countries"), "country_code") == [(1,), (2,), (3,)]


@pytest.mark.parametrize("layout", ["lines", "files", "records"])
def test_a_backfill_leaves_other_countries(spark, path, layout):
    cfg = config(path, layout=layout)
    if layout == "records":
        os.makedirs(f"{path}/people")
        put(f"{path}/people", "c.json", *[{"countryCode": c, "countryName": n} for c, n in ((1, "A"), (2, "B"))])
        for year in (2011, 2012):
            put(f"{path}/land/year={year}", "a.json", record(year - 2010, year, 1.0))
        batch.direct_run(spark, replace(cfg, countries_landing=f"{path}/people"))
    else:
        for year in (2011, 2012):
            put(f"{path}/land/year={year}", "a.json", envelope(record(year - 2010, year, 1.0), countries=((year - 2010, "N"),)))
        batch.direct_run(spark, cfg)
    for _ in range(2):
        batch.backfill_range(spark, cfg, 2011, 2011)
    assert rows(store.read_table(spark, cfg.countries("main")), "country_code") == [(1,), (2,)]
    assert rows(store.read_table(spark, cfg.fact("main")), "country_code") == [(1,), (2,)]


# The ledger. ----------------------------------------------------------------------------------

RAW = T.StructType().add("country_code", "string").add("file_name", "string").add("_loaded_at", "timestamp_ntz")


def line(code):
    return json.dumps(record(code, 2024, 1.0))


@pytest.fixture
def loads(spark, path):
    target = store.Table(f"{path}/raw", RAW, ["country_code"])
    book = ledger.ledger_table(f"{path}/ledger")

    def load(**how):
        found = ledger.load_new_files(
            spark, f"{path}/land", target, book, AT, rows_of=lambda r: store.shaped(r.withColumn("country_code", r["countryCode"]), T.StructType(RAW.fields[:2])), **how
        )
        return rows(found, "file_name", "status")

    return load, lambda: [r[0] for r in rows(store.read_table(spark, target), "country_code")], book


def test_the_same_bytes_under_another_name_load_once(spark, path, loads):
    load, codes, _ = loads
    put(f"{path}/land", "a.json", line(1), line(2))
    put(f"{path}/land", "b.json", line(1), line(2))
    put(f"{path}/land", "c.json", line(2), line(1), line(1))
    assert load() == [("a.json", "LOADED"), ("b.json", "SAME_CONTENT"), ("c.json", "LOADED")]
    put(f"{path}/land/later", "d.json", line(1), line(2))
    put(f"{path}/land", "a.json", line(3))
    assert load() == [("a.json", "LOADED"), ("b.json", "KNOWN"), ("c.json", "KNOWN"), ("later/d.json", "KNOWN")]
    assert codes() == ["1", "1", "1", "2", "2", "3"]
    assert {s for _, s in load()} == {"KNOWN"}
    assert [s for _, s in load(force=True, pattern="^b.json$")] == ["LOADED"]
    assert codes() == ["1", "1", "1", "1", "2", "2", "2", "3"]


def test_files_of_several_blocks(spark, path, loads):
    load, codes, _ = loads
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        lines = [line(i) for i in range(40)]
        put(f"{path}/land", "a.json", *lines)
        put(f"{path}/land", "b.json", *lines)
        put(f"{path}/land", "c.json", *lines[:20], line(77), *lines[21:])
        assert load() == [("a.json", "LOADED"), ("b.json", "SAME_CONTENT"), ("c.json", "LOADED")]
        assert len(codes()) == 80
        put(f"{path}/land", "d.json", *lines)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # cut at other places
        assert load()[-1] == ("d.json", "KNOWN")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_streams_and_batches_share_a_ledger(spark, path, loads):
    load, codes, book = loads
    put(f"{path}/land", "a.json", line(1))
    assert load() == [("a.json", "LOADED")]
    put(f"{path}/in", "x.json", line(1))
    put(f"{path}/in", "y.json", line(2))

    def stream():
        ingest.auto_ingest(spark, f"{path}/in", f"{path}/landed", f"{path}/ck", ledger=book).awaitTermination()

    stream()
    put(f"{path}/in", "z.json", line(2))
    stream()
    assert rows(ingest.read_raw(spark, f"{path}/landed"), "country_code") == [(2,)]
    put(f"{path}/land", "b.json", line(2))
    assert load() == [("a.json", "KNOWN"), ("b.json", "KNOWN")]
    assert codes() == ["1"]


def test_an_empty_landing(spark, path, loads):
    load, codes, _ = loads
    os.makedirs(f"{path}/land")
    put(f"{path}/land", "a.json", "")
    assert load() == [] and codes() == []
