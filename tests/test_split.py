import json

import pytest
from pyspark.sql import functions as F

from snapmart.sources import landed
from snapmart.sources.split import read_split
from tests.conftest import rows
from tests.test_sources import ENVELOPE, put, record

FIELDS = ["countryCode", "countryName", "year", "record", "value"]

NASTY = [
    'a } b', '{"x": [', '"footprint_data": [ {', "back\\slash\\", 'quote " } "', "", "]}", "é}ü{",
    "\\\"footprint_data\\\": [{", "line\nbreak }", "@[{", "}" * 9,
]


@pytest.fixture
def small_ranges(spark):
    """Files are cut every 301 bytes."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def told(df):
    name = F.substring_index("_source_file", "/", -1)
    return rows(df, name, "_row_number", *FIELDS, "_corrupt_record")


def both(spark, path, section="footprint_data"):
    return (
        told(read_split(spark, path, section, FIELDS)),
        told(landed.read_envelope(spark, path, section, "files", FIELDS)),
    )


def test_equals_whole_files(spark, path, small_ranges):
    nasty = [record(i, countryName=n, nested={"a": [{"b": n}], "footprint_data": [1, {"c": 2}]})
             for i, n in enumerate(NASTY)]
    many = [record(i, value=i / 4, countryName=NASTY[i % len(NASTY)]) for i in range(60)]
    other = {"note": 'x "footprint_data": [{', "meta": {"footprint_data": [{"countryCode": 9}]}}
    put(path, "a.json", ENVELOPE)
    put(path, "b.json", nasty)
    put(path, "c.json", json.dumps({**other, "footprint_data": nasty, "countries": many}, indent=1))
    put(path, "d.json", {"countries": nasty, "footprint_data": many, "tail": [[{"countryCode": 7}]]})
    put(path, "e.json", {"footprint_data": [], "countries": [record(3)]})
    put(path, "f.json", json.dumps(many, indent=3) + "\n \n")
    put(path, "g.json", record(5, countryName="}{"))
    put(path, "h.json", {"countries": many})
    put(path, "i.json", "[]")
    put(path, "j.json", "  \n")
    put(path, "k.json", "no json at all")
    put(path, "l.json", "﻿" + json.dumps({"footprint_data": many[:3]}))
    put(path, "m.json", json.dumps({**other, "footprint_data": nasty}, ensure_ascii=False))
    put(path, "n.json", {"record_types": [record(1)], "footprint_data": [{}, {"year": None}]})
    for section in ("footprint_data", "countries"):
        found, whole = both(spark, path, section)
        # A reader of whole files keeps the byte order mark and cannot parse what follows.
        apart = [r for r in found if r[0] != "l.json"]
        assert apart == [r for r in whole if r[0] != "l.json"]
    marked = [r for r in told(read_split(spark, path, "footprint_data", FIELDS)) if r[0] == "l.json"]
    assert [(r[1], r[2]) for r in marked] == [(1, "0"), (2, "1"), (3, "2")]


def test_one_document_is_many_tasks(spark, path, small_ranges):
    put(path, "a.json", {"footprint_data": [record(i) for i in range(200)]})
    text = spark.read.text(path, lineSep="}")
    assert text.rdd.getNumPartitions() > 30
    assert both(spark, path)[0] == both(spark, path)[1]


def test_bad_records_leave_the_others(spark, path, small_ranges):
    put(path, "a.json", '[{"countryCode": 1}, {"countryCode" 2}, {"countryCode": 3}]')
    put(path, "b.json", '{"footprint_data": [{"countryCode": 4}, {"countryCode": 5')
    put(path, "c.json", '[{"countryCode": 6}, {"countryCode": 7, "countryName": "x}')
    found = rows(
        read_split(spark, path, fields=FIELDS), F.substring_index("_source_file", "/", -1), "_row_number",
        "countryCode", "_corrupt_record",
    )
    assert found == [
        ("a.json", 1, "1", None), ("a.json", 2, None, '{"countryCode" 2}'), ("a.json", 3, "3", None),
        ("b.json", 1, "4", None), ("b.json", 2, None, '{"countryCode": 5'),
        ("c.json", 1, "6", None), ("c.json", 2, None, '{"countryCode": 7, "countryName": "x}'),
    ]


def test_empty_folder_of_blank_files(spark, path):
    put(path, "a.json", "")
    assert read_split(spark, path).count() == 0


def test_layout_of_read_envelope(spark, path):
    put(path, "a.json", ENVELOPE)
    found = landed.read_envelope(spark, path, layout="split")
    whole = landed.read_envelope(spark, path, layout="files")
    assert found.dtypes == whole.dtypes
    assert rows(found, "countryCode", "_row_number", "value") == [("1", 1, "1.5"), ("2", 2, None)]
