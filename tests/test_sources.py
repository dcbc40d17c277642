import json
import os

import pytest
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.sources import landed, variant
from snapmart.tables import backfill
from tests.conftest import plan_of, rows


def record(code, year=2024, kind="EF", **more):
    return {"countryCode": code, "countryName": f"C{code}", "year": year, "record": kind, **more}


def put(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as out:
        out.write(text if isinstance(text, str) else json.dumps(text))


ENVELOPE = {
    "countries": [{"countryCode": 1, "countryName": "A"}],
    "footprint_data": [record(1, value=1.5), record(2, value=None)],
    "record_types": [{"record_type": "EF", "description": "Footprint"}],
    "metadata": {"total_records": 2},
}


@pytest.mark.parametrize("layout", ["files", "lines"])
def test_envelope_bare_array_and_record(spark, path, layout):
    put(path, "a.json", ENVELOPE)
    put(path, "b.json", [record(3), record(4), record(5)])
    put(path, "c.json", record(6))
    put(path, "d.json", {"footprint_data": []})
    found = landed.read_envelope(spark, path, layout=layout)
    assert rows(found, "countryCode", "_row_number", "value") == [
        ("1", 1, "1.5"), ("2", 2, None), ("3", 1, None), ("4", 2, None), ("5", 3, None),
        ("6", 1, None),
    ]
    assert found.filter("_corrupt_record IS NOT NULL").count() == 0


def test_pretty_printed_files(spark, path):
    put(path, "a.json", json.dumps(ENVELOPE, indent=2))
    assert landed.read_envelope(spark, path, layout="files").count() == 2
    types = landed.read_envelope(spark, path, "record_types", "files")
    assert rows(types, "record_type", "description") == [("EF", "Footprint")]


def test_section_of_envelopes_only(spark, path):
    put(path, "a.json", ENVELOPE)
    put(path, "b.json", [record(3)])
    put(path, "c.json", record(6))
    docs = landed.read_documents(spark, path)
    found = landed.flatten_documents(docs, "countries", bare=False)
    assert rows(found, "countryCode") == [("1",)]


def test_unparsable_text_is_kept(spark, path):
    put(path, "a.json", json.dumps(record(1)) + "\n{broken\n\n[1, {]\n" + json.dumps(record(2)))
    found = landed.read_envelope(spark, path)
    assert rows(found.filter("_corrupt_record IS NULL"), "countryCode") == [("1",), ("2",)]
    assert rows(found.filter("_corrupt_record IS NOT NULL"), "_corrupt_record") == [
        ("[1, {]",), ("{broken",),
    ]


def test_lines_keep_input_order(spark, path):
    put(path, "a.json", "\n".join(json.dumps(record(k)) for k in range(50)))
    found = landed.read_envelope(spark, path).orderBy(*landed.INPUT_ORDER)
    assert [int(r.countryCode) for r in found.collect()] == list(range(50))
    fast = landed.read_records(spark, path).orderBy(*landed.INPUT_ORDER)
    assert [int(r.countryCode) for r in fast.collect()] == list(range(50))
    assert set(fast.columns) == set(found.columns)


def test_record_reader_marks_broken_lines(spark, path):
    put(path, "a.json", json.dumps(record(1)) + "\n{broken\n")
    found = landed.read_records(spark, path)
    assert rows(found, "countryCode", "_corrupt_record") == [("1", None), (None, "{broken")]


def test_years_prune_folders(spark, path):
    for year in (2019, 2020, 2021):
        put(f"{path}/year={year}", "a.json", json.dumps(record(year, year)))
    docs = landed.read_documents(spark, path, years=(2020, 2021))
    assert "PartitionFilters: [isnotnull(year" in plan_of(docs).replace("#", " ").replace(" (", "(") or (
        "PartitionFilters: []" not in plan_of(docs)
    )
    assert rows(landed.flatten_documents(docs), "countryCode") == [("2020",), ("2021",)]
    fast = landed.read_records(spark, path, years=(2020, 2021))
    assert rows(fast, "countryCode", "year") == [("2020", "2020"), ("2021", "2021")]


def test_latest_snapshot(spark, path):
    spark.range(6).select("id", F.concat(F.lit("2024010"), "id").alias("snapshot")).write.partitionBy(
        "snapshot"
    ).parquet(path := f"{path}/s")
    assert rows(landed.read_latest_snapshot(spark, path), "id") == [(5,)]
    assert rows(landed.read_latest_snapshot(spark, path, "20240102"), "id") == [(2,)]
    assert landed.read_latest_snapshot(spark, path, "all").count() == 6


def test_csv_feed(spark, path):
    put(
        path, "data.csv",
        "daily_return,fund_code,market_date,retunr_type\n0.01,F1,2024-01-02,NET\n,F1,2024-01-03,NET\n"
        "x,F2,2024-01-04,NET\n",
    )
    found = landed.read_perf_daily(spark, path)
    assert found.schema.fieldNames() == ["fund_code", "market_date", "return_type", "daily_return"]
    assert rows(found, "fund_code", "daily_return") == [("F1", 0.01), ("F1", None), ("F2", None)]


def test_calendar_feed(spark, path):
    put(
        path, "calendar.csv",
        "date,day_of_week,text_day_of_week,text_month_of_year,is_holiday,is_working_day\n"
        "2024-01-01,1,Monday,January,true,FALSE\n",
    )
    row = landed.read_calendar(spark, path).first()
    assert (row.day_of_week, row.is_holiday, row.is_working_day) == (1, True, False)


def test_variant_column(spark, path):
    put(path, "a.json", '{"country_code": 1, "carbon": "x", "at": "2024-01-01 10:00:00"}\n{"country_code": "n/a"}')
    docs = variant.land_variant(spark, path)
    assert docs.schema["raw_data"].dataType.simpleString() == "variant"
    found = variant.copy_into_typed(
        docs, {"code": ("$.country_code", "bigint"), "carbon": ("$.carbon", "double"),
               "at": ("$.at", "timestamp_ntz")},
    )
    assert [(r.code, r.carbon, str(r.at)) for r in found.orderBy("code").collect()] == [
        (None, None, "None"), (1, None, "2024-01-01 10:00:00"),
    ]
    assert found.filter(F.col("_source_file").endswith("a.json")).count() == 2


def test_legacy_load(spark):
    df = spark.createDataFrame(
        [('{"country_code": 1, "extracted_at": "2024-01-01T10:00:00+00:00"}',),
         ('{"country_code": 2, "extracted_at": "soon"}',), ("{",)], "raw_data string",
    )
    found = variant.copy_into_legacy(df, "f.json")
    got = sorted([(r.country_code, str(r.extracted_at), r._source_file) for r in found.collect()], key=repr)
    assert got == [
        (1, "2024-01-01 10:00:00", "f.json"), (2, "None", "f.json"), (None, "None", "f.json"),
    ]


def test_backfill_by_pattern(spark, path):
    put(f"{path}/2023", "a.json", json.dumps(record(1)) + "\n" + json.dumps(record(2)) + "\n{")
    put(f"{path}/2024", "b.json", "{\n{")
    put(f"{path}/2024", "c.txt", json.dumps(record(3)))
    found = backfill.backfill_rows(spark, path)
    assert rows(backfill.backfill_report(found)) == [
        ("2023/a.json", 2, 1, "SUCCESS"), ("2024/b.json", 0, 2, "FAILED"),
    ]
    only = backfill.backfill_rows(spark, path, r"^2024/.*\.json$")
    assert rows(only.select("file_name").distinct()) == [("2024/b.json",)]
    done = spark.createDataFrame([("2023/a.json",)], "file_name string")
    assert backfill.pending_files(found, done).first().pending_files == 1


def test_filter_reaches_the_scan(spark, path):
    spark.createDataFrame([("EF", 1.0), ("BC", 2.0)], "record_type string, value double").write.parquet(
        path := f"{path}/f"
    )
    df = landed.filter_types(spark.read.parquet(path), ["EF"])
    assert "PushedFilters: [In(record_type, [EF])]" in plan_of(df) or "EqualTo(record_type,EF)" in plan_of(df)
    wanted = spark.createDataFrame([("BC",)], schemas.T.StructType().add("record_type", "string"))
    assert rows(landed.filter_types(spark.read.parquet(path), wanted)) == [("BC", 2.0)]


def test_sections_come_from_one_parse(spark, path):
    """The same rows as a parse for each section, whatever another section holds."""
    types = [{"record_type": "EF", "description": "Footprint"}, {"record_type": "BC"}]
    put(
        path, "a.json",
        "\n".join([
            json.dumps({**ENVELOPE, "record_types": types}), "{broken", "[1, {]", "[]", "{}",
            json.dumps(record(7)), json.dumps([record(8), record(9)]),
            json.dumps({"footprint_data": [record(3)], "countries": "none", "record_types": [1]}),
            json.dumps({"footprint_data": "none", "countries": [{"countryCode": 5}]}),
            json.dumps({"countries": [{"countryCode": 6, "countryName": "a\"b{]é"}, None]}),
        ]),
    )
    docs = landed.read_documents(spark, path)
    sections = {s: landed.record_fields(s) for s in ("footprint_data", "countries", "record_types")}
    found = landed.flatten_sections(docs, sections)
    for section, fields in sections.items():
        bare = section == "footprint_data"
        alone = landed.flatten_documents(docs, section, bare=bare)
        if not bare:
            alone = alone.filter("_corrupt_record IS NULL")
        columns = [*fields, "_seq", "_row_number", "_corrupt_record"]
        part = found.filter(found[landed.SECTION] == section)
        assert rows(part, *columns) == rows(alone, *columns), section
