import json
import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapmart.plans import batch, monitor
from snapmart.tables import state, store
from tests.conftest import plan_of, rows

NOW = datetime(2024, 1, 31, 12)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def record(code, year, value, kind="EFConsTotGHA", name="N"):
    return {"countryCode": code, "countryName": name, "year": year, "record": kind, "value": value}


def envelope(*records, countries=((1, "A"), (2, "B"))):
    return {
        "footprint_data": list(records),
        "countries": [{"countryCode": c, "countryName": n} for c, n in countries],
        "record_types": [],
    }


def put(path, name, *docs):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as out:
        out.write("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))


def config(path, **more):
    return batch.RunConfig(f"{path}/land", f"{path}/root", 2010, 2024, at=NOW, **more)


def loaded(spark, cfg, target="main"):
    return rows(store.read_table(spark, cfg.fact(target)), "country_code", "year", "record_type", "value")


def test_batch_run(spark, path):
    put(
        f"{path}/land", "a.json",
        envelope(record(1, 2015, 1.0), record(1, 2015, 2.0), record(0, 2015, 3.0),
                 record("all", 2015, 4.0), record(2, 2005, 5.0), record(2, 2016, 6.0, None)),
        "{broken",
    )
    cfg = config(path, targets=("main", "copy"))
    done = batch.batch_run(spark, cfg)
    assert done["status"] == "success" and done["window"] == (2010, 2024)
    assert (done["extracted"], done["valid"], done["quarantined"]) == (6, 1, 4)
    assert loaded(spark, cfg) == loaded(spark, cfg, "copy") == [(1, 2015, "EFConsTotGHA", 1.0)]
    assert store.read_table(spark, cfg.countries("main")).count() == 2
    bad = spark.read.parquet(f"{cfg.root}/failed/snapshot=20240131_120000")
    assert sorted(map(sorted, (r._reasons for r in bad.collect()))) == [
        ["no country code"], ["no country code"],
        ["no country code", "no record type", "no year", "unparsable"], ["no record type"],
    ]
    log = monitor.status_counts(state.read_run_log(spark, cfg.log_path))
    assert {r.stage for r in log.collect()} == {"EXTRACT", "CHECK", "TRANSFORM", "LOAD"}

    put(f"{path}/land", "b.json", envelope(record(1, 2024, 8.0), record(1, 2010, 9.0)))
    again = batch.batch_run(spark, replace(cfg, at=datetime(2024, 2, 1)))
    assert again["window"] == (2023, 2024)  # one year of overlap after 2024
    assert loaded(spark, cfg) == [(1, 2015, "EFConsTotGHA", 1.0), (1, 2024, "EFConsTotGHA", 8.0)]


DIRTY = [
    record(1, 2015, 1.0), record(1, "2016.0", 2.0), record(2, None, 3.0), record(2, "20x5", 4.0),
    record(2, "2015.5", 5.0), record("all", 2015, 6.0), record(2, 2015, 7.0, None), record(1, 1999, 8.0),
]


@pytest.mark.parametrize("layout", ["records", "lines", "files"])
@pytest.mark.parametrize("run", ["batch", "direct", "staged"])
def test_no_row_vanishes_in_any_layout(spark, path, layout, run):
    """Good and bad rows are the landed rows of the window, the same for every layout and run."""
    lines = [*DIRTY, "{broken"]
    people = [{"countryCode": 1, "countryName": "A"}, {"countryCode": "all", "countryName": "B"}, "{no"]
    for folder, docs in (("land", lines), ("people", people)):
        files = [[d] for d in docs] if layout == "files" else [docs]
        for i, some in enumerate(files):
            put(f"{path}/{folder}", f"{i}.json", *some)
    cfg = config(path, layout=layout, countries_landing=f"{path}/people")
    staged = run == "staged"
    if run == "batch":
        done = batch.batch_run(spark, cfg)
        assert (done["extracted"], done["status"], done["quarantined_countries"]) == (8, "success", 2)
    elif run == "direct":
        done = batch.direct_run(spark, cfg)
        assert done["quarantined_countries"] == 2
    else:
        raw = batch.extract_stage(spark, cfg)
        assert raw["records_count"] == 8
        done = batch.transform_stage(spark, raw["path"], NOW)
        batch.load_stage(spark, done["path"], cfg, "main")
    good = [(1, 2015, "EFConsTotGHA", 1.0), (1, 2016, "EFConsTotGHA", 2.0)]
    # A missing type is no fault in a staged run; it becomes unknown.
    assert loaded(spark, cfg) == sorted([*good, *([(2, 2015, "unknown", 7.0)] if staged else [])])
    assert done["quarantined"] == (5 if staged else 6)
    bad = spark.read.parquet(f"{cfg.root}/failed/snapshot=*")
    assert bad.count() == done["quarantined"]


@pytest.mark.parametrize("layout", ["records", "lines"])
def test_folders_of_other_years_are_not_read(spark, path, layout):
    for year in (2001, 2015, "20x5"):
        put(f"{path}/land/year={year}", "a.json", record(1, year, 1.0))
    cfg = config(path, layout=layout)
    rows_ = batch._landed_facts(spark, cfg, (2010, 2024))
    plan = plan_of(rows_)
    assert "PartitionFilters: []" not in plan and "year#" in plan.split("PartitionFilters:")[1]
    assert rows(rows_, "countryCode") == [("1",), ("1",)]
    assert "number of partitions read: 2" in plan or len(set(
        r[0] for r in rows_.select("_source_file").collect())) == 2


def test_no_data(spark, path):
    put(f"{path}/land", "a.json", envelope())
    assert batch.batch_run(spark, config(path))["status"] == "no_data"
    cfg = replace(config(path), root=f"{path}/other")
    assert batch.staged_run(spark, cfg) == {"status": "no_data", "records_count": 0, "path": None}


def test_failed_checks_stop_the_run(spark, path):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, -1.0)))
    cfg = config(path)
    done = batch.batch_run(spark, cfg)
    assert done["status"] == "dq_failed" and done["checks"]["checks_failed"] == 1
    assert store.read_table(spark, cfg.fact("main")).count() == 0
    assert state.last_year_of(state.read_state(spark, cfg.state_path), cfg.job) is None
    warned = batch.batch_run(spark, replace(cfg, warn_only=True, at=datetime(2024, 2, 1)))
    assert warned["status"] == "success"
    with pytest.raises(batch.ChecksFailed, match="1 checks failed"):
        batch.batch_run(spark, replace(cfg, raise_on_failure=True, at=datetime(2024, 2, 2),
                                       full_refresh=True))


def test_state_of_the_years_seen(spark, path):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 1.0)))
    cfg = config(path, state_mode="observed")
    assert batch.batch_run(spark, cfg)["status"] == "success"
    assert state.last_year_of(state.read_state(spark, cfg.state_path), cfg.job) == 2015


def test_contract_puts_rows_aside(spark, path):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 1.0), record(2, 2015, 1.0, name=None)))
    cfg = config(path, enforce_contract=True, check=False)
    done = batch.batch_run(spark, cfg)
    assert (done["status"], done["valid"]) == ("success", 1)
    assert spark.read.parquet(f"{cfg.root}/failed").count() == 1


def test_types_asked_for(spark, path):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 1.0), record(1, 2015, 2.0, "BiocapTotGHA")))
    cfg = config(path, record_types=["BiocapTotGHA"])
    batch.direct_run(spark, cfg)
    assert loaded(spark, cfg) == [(1, 2015, "BiocapTotGHA", 2.0)]


def test_staged_run(spark, path):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 400.0), record(1, 2015, 1.0)))
    cfg = config(path)
    first = batch.extract_stage(spark, cfg)
    second = batch.transform_stage(spark, first["path"], NOW)
    assert (first["records_count"], second["records_count"]) == (2, 1)
    assert "transformed/" in second["path"] and second["path"].endswith("_transformed")
    third = batch.load_stage(spark, second["path"], cfg, "main")
    assert third["inserted"] == 1 and loaded(spark, cfg) == [(1, 2015, "EFConsTotGHA", 400.0)]


def test_full_refresh_replaces(spark, path):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 1.0), record(1, 2020, 1.0)))
    cfg = config(path)
    batch.direct_run(spark, cfg)
    done = batch.full_refresh(spark, replace(cfg, start_year=2018))
    assert done["status"] == "success"
    assert loaded(spark, cfg) == [(1, 2020, "EFConsTotGHA", 1.0)]


def test_unknown_type_or_dropped(spark):
    facts = spark.createDataFrame(
        [(1, 2024, None, 100.0, 400.0, 1), (1, 2024, None, 1.0, 2.0, 2)],
        "country_code long, year long, record_type string, carbon double, value double, pos long",
    )
    kept = batch.transform_enriched(facts, NOW, ["pos"])
    assert rows(kept, "record_type", "carbon_pct_of_total") == [("unknown", 25.0)]
    assert batch.transform_enriched(facts, NOW, ["pos"], on_missing_type="drop").count() == 0


LOADED = "_loaded_at timestamp_ntz, _updated_at timestamp_ntz"


@pytest.mark.parametrize(
    "minute, table, mart",
    [(0, "FRESH", "FRESH"), (30, "FRESH", "FRESH"), (31, "WARNING", "FRESH"),
     (61, "STALE", "WARNING"), (121, "STALE", "STALE")],
)
def test_freshness(spark, minute, table, mart):
    at = datetime(2024, 1, 31, 12 - (minute + 59) // 60, (60 - minute % 60) % 60, 59 if minute else 0)
    df = spark.createDataFrame([(at, at)], LOADED)
    found = {r.table_name: r for r in monitor.freshness(df, df, df, now()).collect()}
    assert (found["raw"].freshness_status, found["mart"].freshness_status) == (table, mart)
    assert found["raw"].minutes_since_last_load == minute


def test_empty_table_is_fresh_unless_marked(spark):
    df = spark.createDataFrame([], LOADED)
    assert {r.freshness_status for r in monitor.freshness(df, df, df, now()).collect()} == {"FRESH"}
    marked = monitor.freshness(df, df, df, now(), mark_empty=True)
    assert {r.freshness_status for r in marked.collect()} == {"EMPTY"}
    assert monitor.alert_stale(marked).count() == 0


RUNS = "run_id string, stage string, state string, scheduled_time timestamp_ntz, completed_time timestamp_ntz, error_code string"


def runs(spark, *data):
    return spark.createDataFrame(
        [(str(i), "LOAD", "FAILED" if e else "SUCCEEDED", a, b, e) for i, (a, b, e) in enumerate(data)], RUNS
    )


def test_run_history_and_failures(spark):
    df = runs(
        spark, (datetime(2024, 1, 31, 11, 55), datetime(2024, 1, 31, 12, 6), None),
        (datetime(2024, 1, 31, 11, 51), datetime(2024, 1, 31, 11, 52), "E1"),
        (datetime(2024, 1, 31, 11, 49), datetime(2024, 1, 31, 11, 50), "E2"),
        (datetime(2024, 1, 1), datetime(2024, 1, 1), "E3"),
    )
    history = monitor.run_history(df, now()).collect()
    assert [(r.run_id, r.duration_seconds) for r in history] == [("0", 660), ("1", 60), ("2", 60)]
    assert rows(monitor.alert_failures(df, now())) == [("run_failure", 1)]
    assert monitor.alert_failures(df.filter("error_code IS NULL"), now()).count() == 0
    checks = spark.createDataFrame([("PASS",), ("FAIL",)], "status string")
    found = monitor.alert_rules(df, checks, spark.range(0))
    assert rows(found, "alert", "value") == [("error_rate", 0.75), ("failed_checks", 1.0), ("long_run", 1.0)]


def test_history_from_the_log(spark, path):
    state.log_run(spark, path, "r", "LOAD", "FAILED", NOW, 1, 90_500, error="boom")
    found = monitor.run_history(monitor.runs_from_log(state.read_run_log(spark, path)), now()).first()
    assert (found.state, found.error_code, found.duration_seconds) == ("FAILED", "boom", 91)


def test_load_history_counts_good_and_bad(spark):
    raw = spark.createDataFrame([("a", NOW), ("a", NOW), ("b", NOW)], "_source_file string, _loaded_at timestamp_ntz")
    bad = spark.createDataFrame(
        [("a", NOW, "y"), ("a", NOW, "x"), ("c", NOW, "z")],
        "_source_file string, _loaded_at timestamp_ntz, reason string",
    )
    found = monitor.file_load_history(raw, bad, now())
    assert rows(found, "file_name", "row_parsed", "error_count", "first_error_message", "status") == [
        ("a", 4, 2, "x", "PARTIALLY_LOADED"), ("b", 1, 0, None, "LOADED"), ("c", 1, 1, "z", "LOAD_FAILED"),
    ]


TYPES = [{"code": "EF", "name": "Footprint", "record": "EFConsTotGHA"},
         {"code": "EF2", "name": "Second name", "record": "EFConsTotGHA"}]


@pytest.mark.parametrize("run", ["batch", "direct"])
def test_descriptions_come_from_what_landed_and_stay(spark, path, run):
    first = {**envelope(record(1, 2015, 1.0), record(1, 2015, 1.0, "BiocapTotGHA")), "record_types": TYPES}
    put(f"{path}/land", "a.json", first)
    cfg = config(path)
    done = getattr(batch, f"{run}_run")(spark, cfg)
    assert done.get("status", "success") == "success"
    found = store.read_table(spark, cfg.fact("main"))
    assert rows(found, "record_type", "record_type_description") == [
        ("BiocapTotGHA", "BiocapTotGHA"), ("EFConsTotGHA", "Footprint"),
    ]
    # A later load without descriptions, of another type, keeps what is known.
    put(f"{path}/land2", "a.json", envelope(record(1, 2016, 1.0), record(1, 2016, 1.0, "EFConsPerCap")))
    batch.direct_run(spark, replace(cfg, landing=f"{path}/land2"))
    assert rows(store.read_table(spark, cfg.types("main"))) == [
        ("BiocapTotGHA", "BiocapTotGHA"), ("EFConsPerCap", "EFConsPerCap"), ("EFConsTotGHA", "Footprint"),
    ]


@pytest.mark.parametrize("layout", ["records", "lines"])
def test_new_landed_fields_are_kept_and_reported(spark, path, layout):
    put(f"{path}/land", "a.json", record(1, 2015, 1.0))
    put(f"{path}/people", "a.json", {"countryCode": 1, "countryName": "A"})
    cfg = config(path, layout=layout, evolve=True, countries_landing=f"{path}/people")
    assert batch.batch_run(spark, cfg)["status"] == "success"
    fresh = record(1, 2016, 2.0) | {"quality": "good"}
    put(f"{path}/land", "b.json", fresh if layout == "records" else [fresh, record(2, 2016, 3.0)])
    done = batch.batch_run(spark, replace(cfg, at=datetime(2024, 2, 1), job="again", start_year=2016))
    assert done["status"] == "success"
    assert done["loaded"]["main"]["result"]["schema_changes"] == [("quality", "added")]
    found = store.read_table(spark, cfg.fact("main"), evolved=True)
    kept = [(1, 2015, None), (1, 2016, "good")] + ([(2, 2016, None)] if layout == "lines" else [])
    assert rows(found, "country_code", "year", "quality") == kept
    assert "quality" not in store.read_table(spark, cfg.fact("main")).columns


def test_metrics_are_appended_after_a_load(spark, path):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 1.0)))
    cfg = config(path, measure=True)
    assert batch.batch_run(spark, cfg)["postload_failures"] > 0  # few countries and years
    once = batch.read_quality(spark, cfg).count()
    batch.measure(spark, replace(cfg, at=datetime(2024, 2, 1)), "main")
    found = batch.read_quality(spark, cfg)
    assert found.count() == 2 * once and found.select("check_timestamp").distinct().count() == 2
    assert {"duplicate_records", "null_country_codes"} <= {r.metric_name for r in found.collect()}


def test_retention_covers_what_runs_write(spark, path):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 1.0), record(0, 2015, 1.0)), "{broken")
    cfg = config(path, enforce_contract=True, check=False)
    for day in (1, 2, 3):
        done = batch.batch_run(spark, replace(cfg, at=datetime(2024, 1, day)))
        assert done["status"] == "success", done
    # Merges of no rows left folders that no version uses; nothing else is old enough.
    early = batch.tidy(spark, cfg, datetime(2024, 1, 20).date(), keep_versions=9)
    assert all(p.startswith("g=") for p in early)
    gone = batch.tidy(spark, cfg, datetime(2024, 2, 5).date(), keep_versions=1)
    assert {p.split(cfg.root + "/")[1].split("/")[0] for p in gone if cfg.root in p} == {"staged"}
    assert any(p.startswith("g=") for p in gone) and len(loaded(spark, cfg)) == 1
    assert batch.tidy(spark, cfg, datetime(2030, 1, 1).date()) != []
    for zone in ("raw", "failed", "staged"):
        assert not [n for n in os.listdir(f"{cfg.root}/{zone}") if "=" in n]
    assert len(loaded(spark, cfg)) == 1


@pytest.mark.parametrize("direct", [True, False])
def test_a_run_parses_its_documents_once(spark, path, monkeypatch, direct):
    put(f"{path}/land", "a.json", envelope(record(1, 2015, 1.0), record(2, 2016, 2.0)), "{broken")
    cfg, seen, read = config(path), [], batch.read_documents
    monkeypatch.setattr(batch, "read_documents", lambda *a, **k: seen.append(a[1]) or read(*a, **k))
    (batch.direct_run if direct else batch.batch_run)(spark, cfg)
    assert seen == [cfg.landing]
    assert len(loaded(spark, cfg)) == 2 and os.listdir(f"{cfg.root}/_landing") == []
    assert store.read_table(spark, cfg.countries("main")).count() == 2
