"""Landings whose years are dealt over several files, and merges into tables that hold nothing yet."""

import datetime as dt
import json

from pyspark.sql import functions as F

from snapmart.catalog import runs
from snapmart.operators.merge import merge
from snapmart.tables import store
from snapmart.tables.versions import children
from tests.conftest import plan_of, rows


def events(spark, path):
    """Days 5 and 6 with events in no order, one of them twice, and one event without a number or a time."""
    day = lambda n: dt.datetime(2024, 1, n, 10)
    made = [(i, day(5 + i % 2), i % 7, "view", 1.5 * i, json.dumps({"k": i % 90})) for i in range(1200, -1, -1)]
    made += [(97, day(6), 3, "click", 2.0, '{"k": 1}'), (None, day(5), 1, "view", 1.0, '{"k": 1}'), (8, None, 1, "view", 1.0, "{}")]
    names = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(made, names).write.parquet(f"{path}/events.parquet")
    customers = "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"
    spark.createDataFrame([(1, "a", 1, 1.0, "m")], customers).write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame([(1, "n")], "n_nationkey long, n_name string").write.parquet(f"{path}/nation.parquet")


def lines_of(spark, folder):
    """The lines of each file, in the order of the files' names."""
    found = []
    for name in [n for n in children(spark, folder) if n.startswith("part-")]:
        with open(f"{folder}/{name}") as file:
            found.append(file.read().splitlines())
    return found


def landed(spark, path, layout):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return runs._land(spark, path, layout)[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_year_is_dealt_over_files_in_order(spark, path):
    """A year has several files; read by name they hold its events in order, each broken line in its place."""
    events(spark, path)
    broken = '{"countryCode": 1,'
    for layout in ("records", "lines"):
        folder = f"{landed(spark, path, layout)}/year=2006"
        files = lines_of(spark, folder)
        assert len(files) > 1
        values, cut = [], 0
        for line in [line for file in files for line in file]:
            if line == broken:
                cut += 1
                continue
            doc = json.loads(line)
            records = doc if isinstance(doc, list) else doc.get("footprint_data", [doc])
            values += [r["value"] for r in records if r.get("record") != "BiocapTotGHA"]
        want = [1.5 * i for i in range(1, 1201, 2) if i % 11]
        have = [v for v in values if int(v / 1.5) % 11]
        assert have == want
        assert cut == len([i for i in range(1, 1201, 2) if i % 97 == 0]) + 1  # number 97 is there twice


def test_a_merge_into_an_empty_table_joins_nothing(spark, path):
    table = store.fact_table(f"{path}/t")
    target = store.read_table(spark, table)
    source = spark.range(3).select(
        F.col("id").alias("country_code"), F.lit(2015).cast("long").alias("year"), F.lit("EF").alias("record_type")
    )
    merged = merge(target, source, table.key)
    assert rows(merged, "country_code", "_action") == [(0, "insert"), (1, "insert"), (2, "insert")]
    assert "Join" not in plan_of(merged)
    assert [f.dataType for f in target.schema] == [f.dataType for f in table.schema]
