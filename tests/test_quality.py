from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.quality import checks as Q
from snapmart.quality import postload as post
from snapmart.quality import preload as pre
from tests.conftest import plan_of, rows

FACT = "country_code long, country_name string, year long, record_type string, value double"
COUNTRY = "country_code long, country_name string"
def as_of():
    return F.lit(datetime(2024, 1, 31)).cast("timestamp_ntz")


def facts(spark, *data):
    return spark.createDataFrame(list(data), FACT)


def countries(spark, *data):
    return spark.createDataFrame(list(data), COUNTRY)


def report(facts_df, countries_df, definitions=pre.STANDARD_DEFINITIONS):
    results = pre.run_definitions(
        {"footprint_data": facts_df, "countries": countries_df}, definitions
    )
    return pre.dq_report(results).first()


def test_good_data_passes(spark):
    found = report(
        facts(spark, (1, "Test", 2020, "EFConsTotGHA", 100.0), (2, "Test2", 2020, "BiocapTotGHA", 200.0)),
        countries(spark, (1, "Test"), (2, "Test2")),
    )
    assert found.passed and found.checks_failed == 0
    assert found.checks_run == 14 and found.checks_passed == 14
    assert found.checks_warned == 1 and "countries.coverage: 2" in found.warnings


def test_missing_name_fails(spark):
    found = report(facts(spark, (1, None, 2020, "EF", None)), countries(spark))
    assert not found.passed
    assert any("country_name" in c for c in found.failed_checks)


def test_year_out_of_range_fails(spark):
    found = report(facts(spark, (1, "T", 1800, "EFConsTotGHA", 1.0)), countries(spark))
    assert not found.passed and any("range.year" in c for c in found.failed_checks)


def test_year_zero_is_missing_not_out_of_range(spark):
    found = report(facts(spark, (1, "T", 0, "EFConsTotGHA", 1.0)), countries(spark, (1, "T")))
    assert [c for c in found.failed_checks] == ["footprint_data.required.year: 1"]


def test_unknown_type_warns(spark):
    df = facts(spark, (1, "T", 2020, "UnknownType", 1.0), (1, "T", 2021, "UnknownType", 1.0))
    found = report(df, countries(spark, (1, "T")))
    assert found.passed
    assert "footprint_data.valid.record_type: 1" in found.warnings
    assert rows(pre.unknown_types(df)) == [("UnknownType", 2)]


def test_duplicates_fail(spark):
    found = report(
        facts(spark, (1, "T", 2020, "EFConsTotGHA", 100.0), (1, "T", 2020, "EFConsTotGHA", 200.0)),
        countries(spark, (1, "T")),
    )
    assert found.failed_checks == ["footprint_data.unique_key: 1"]


def test_null_keys_are_equal_in_facts_and_skipped_in_countries(spark):
    df = facts(spark, (None, "T", 2020, "EFCtot", 1.0), (None, "T", 2020, "EFCtot", 1.0))
    found = Q.run_checks(df, [pre.dq_unique_key("f", schemas.FACT_KEY)]).first()
    assert found.metric_value == 1.0
    people = countries(spark, (None, "A"), (None, "B"), (0, "C"), (0, "D"), (1, "E"), (1, "F"))
    found = Q.run_checks(people, [pre.dq_unique_country(people, "countries")]).first()
    assert found.metric_value == 1.0


def test_negative_values_fail(spark):
    found = report(facts(spark, (1, "T", 2020, "EFCtot", -1.0)), countries(spark, (1, "T")))
    assert found.failed_checks == ["footprint_data.non_negative.value: 1"]


def test_gate(spark):
    results = pre.run_definitions(
        {"footprint_data": facts(spark), "countries": countries(spark)}, pre.DEFAULT_DEFINITIONS
    )
    summary = pre.dq_report(results)
    with pytest.raises(ValueError, match="2 checks failed"):
        pre.gate(summary)
    assert pre.gate(summary, warn_only=True)["checks_failed"] == 2
    assert not pre.gate(summary, raise_on_failure=False)["passed"]


def test_definitions_from_file(path):
    pytest.importorskip("yaml")
    with open(f"{path}/checks.yml", "w") as out:
        out.write("countries:\n  row_count:\n    min: 3\n  unique_key:\n    - country_code\n")
    assert pre.load_definitions(f"{path}/checks.yml")["countries"]["row_count"]["min"] == 3
    assert pre.load_definitions(f"{path}/none.yml") == pre.DEFAULT_DEFINITIONS


def test_plain_counts_share_one_aggregate(spark, path):
    facts(spark, (1, "T", 2020, "EFCtot", 1.0)).write.parquet(f"{path}/facts")
    df = spark.read.parquet(f"{path}/facts")
    plain = [pre.dq_row_count("f"), pre.dq_required(df, "f", "year"), pre.dq_non_negative("f")]
    plan = plan_of(Q.run_checks(df, plain))
    assert plan.count("FileScan") == 1 and "Expand" not in plan
    unique = plan_of(Q.run_checks(df, [pre.dq_unique_key("f", schemas.FACT_KEY)]))
    assert "ReadSchema: struct<country_code:bigint,year:bigint,record_type:string>" in unique


def test_schema_check_needs_no_column_to_exist(spark):
    df = facts(spark, (1, "T", 2020, "EFCtot", 1.0))
    found = Q.run_checks(df, [post.pq_schema(df, "raw", ["year", "per_capita"])]).first()
    assert (found.metric_value, found.status, found.details) == (1.0, "FAIL", "per_capita")


def test_freshness_of_empty_table_fails(spark):
    df = spark.createDataFrame([], "_loaded_at timestamp_ntz")
    found = Q.run_checks(df, [post.pq_freshness("raw", "_loaded_at", as_of())]).first()
    assert (found.metric_value, found.status) == (None, "FAIL")


@pytest.mark.parametrize("hours, status", [(1, "PASS"), (23, "PASS"), (25, "FAIL")])
def test_freshness(spark, hours, status):
    df = spark.range(1).select((as_of() - F.make_dt_interval(hours=F.lit(hours))).alias("_loaded_at"))
    assert Q.run_checks(df, [post.pq_freshness("raw", "_loaded_at", as_of())]).first().status == status


def test_missing_counts_nulls_only(spark):
    df = facts(spark, (0, "", 2020, "EFCtot", 1.0), (None, None, 2020, "EFCtot", 1.0))
    found = Q.run_checks(df, [post.pq_missing("raw", c) for c in ("country_code", "country_name")])
    assert rows(found, "metric_value") == [(1.0,), (1.0,)]


def test_invalid_percent(spark):
    df = spark.range(200).select(F.when(F.col("id") == 0, 1800).otherwise(2000).alias("year"))
    found = Q.run_checks(df, [post.pq_invalid_percent("raw", "year", 1961, 2030)]).first()
    assert (found.metric_value, found.status) == (0.5, "PASS")


def test_required_values(spark):
    df = facts(spark, (1, "T", 2020, "EFCtot", 1.0))
    found = Q.run_checks(
        df, [post.pq_required_value("raw", "record_type", t) for t in ("EFCtot", "BioCaptot")]
    )
    assert rows(found, "status") == [("FAIL",), ("PASS",)]


def test_category_comes_from_the_types(spark):
    types = spark.createDataFrame(schemas.RECORD_TYPE_ROWS, schemas.RECORD_TYPES)
    df = post.with_category(facts(spark, (1, "T", 2020, "BiocapTotGHA", 1.0)), types)
    assert df.first().category == "biocapacity"


def test_scheduled_checks(spark):
    staging = facts(
        spark, (None, "T", 2020, "EFCtot", 1.0), (1, " ", 1950, "EFCtot", -1.0),
        (2, "U", 2025, "EFCtot", 1.0), (2, "U", 2026, "EFCtot", 1.0),
        (2, "U", 2025, "EFCtot", 1.0),
    ).withColumn("carbon", F.lit(None).cast("double"))
    mart = spark.createDataFrame([(2, 2025)], "country_code long, year long")
    found = {r.metric_name: (r.metric_value, r.status) for r in post.sq_metrics(staging, mart, as_of()).collect()}
    assert found == {
        "null_country_codes": (1.0, "FAIL"), "duplicate_records": (1.0, "WARNING"),
        "negative_values": (1.0, "WARNING"), "invalid_years": (2.0, "FAIL"),
        "missing_country_names": (1.0, "WARNING"), "orphaned_staging_records": (3.0, "PASS"),
    }


def test_row_count_anomaly(spark):
    data = [(datetime(2024, 1, d), 100 + d % 3) for d in range(1, 20)]
    log = spark.createDataFrame(data, "log_timestamp timestamp_ntz, records_processed long")
    assert post.pq_row_count_anomaly(log).first().status == "PASS"
    odd = log.unionByName(
        spark.createDataFrame([(datetime(2024, 2, 1), 500)], log.schema)
    )
    assert post.pq_row_count_anomaly(odd).first().status == "WARNING"
