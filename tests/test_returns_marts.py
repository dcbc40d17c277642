import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from snapmart.operators import lookups, marts, returns
from tests.conftest import plan_of, rows

PERF = "fund_code string, market_date date, return_type string, daily_return double"
CAL = "date date, day_of_week int, is_holiday boolean, is_working_day boolean"


def calendar(spark, holidays=()):
    days = [date(2024, 1, d) for d in range(1, 29)]
    return spark.createDataFrame(
        [(d, d.isoweekday(), d in holidays, d.isoweekday() <= 5) for d in days], CAL
    )


def perf(spark, *data):
    return spark.createDataFrame([("F", date(2024, 1, d), "NET", r) for d, r in data], PERF)


def test_compounding(spark):
    found = returns.weekly_returns(perf(spark, (1, 0.1), (2, -0.05), (3, None), (6, 0.5)), calendar(spark))
    row = found.first()
    assert row.n_observations == 2  # a null is no observation, a Saturday no trading day
    assert math.isclose(row.weekly_return, 1.1 * 0.95 - 1)
    assert row.week_start_date == date(2024, 1, 1)
    assert (row.first_market_date_in_week, row.last_market_date_in_week) == (
        date(2024, 1, 1), date(2024, 1, 2),
    )


def test_week_without_observation_vanishes(spark):
    assert returns.weekly_returns(perf(spark, (1, None), (7, 0.1)), calendar(spark)).count() == 0


def test_repeated_days_compound_twice(spark):
    row = returns.weekly_returns(perf(spark, (1, 0.1), (1, 0.1)), calendar(spark)).first()
    assert row.n_observations == 2 and math.isclose(row.weekly_return, 0.21)


def test_guard_leaves_out_total_losses(spark):
    data = perf(spark, (1, 0.1), (2, -1.0), (3, -1.5))
    assert returns.weekly_returns(data, calendar(spark)).first().n_observations == 3
    row = returns.weekly_returns(data, calendar(spark), guard=True).first()
    assert row.n_observations == 1 and math.isclose(row.weekly_return, 0.1)
    assert returns.invalid_returns(data).count() == 2


def test_holiday_week_can_be_complete(spark):
    data = perf(spark, *[(d, 0.01) for d in (2, 3, 4, 5, 8, 9)])
    cal = calendar(spark, holidays={date(2024, 1, 1)})
    strict = returns.weekly_returns_strict(data, cal)
    assert rows(strict, "week_start_date", "expected_trading_days") == [(date(2024, 1, 1), 4)]
    cover = returns.weekly_returns_coverage(data, cal)
    assert rows(cover, "coverage_ratio", "is_complete_week") == [(0.4, False), (1.0, True)]


def test_unordered_result_has_no_range_shuffle(spark):
    df = returns.weekly_returns(perf(spark, (1, 0.1)), calendar(spark), ordered=False)
    assert "rangepartitioning" not in plan_of(df)


def test_calendar_checks(spark):
    cal = spark.createDataFrame(
        [(date(2024, 1, 1), 1, True, True), (date(2024, 1, 1), 1, False, True),
         (date(2024, 1, 6), 6, False, True), (date(2024, 1, 7), 7, False, False)], CAL,
    ).withColumn("text_day_of_week", F.date_format("date", "EEEE"))
    assert rows(returns.calendar_duplicates(cal)) == [(date(2024, 1, 1), 2)]
    assert rows(returns.calendar_conflicts(cal), "date") == [(date(2024, 1, 1),)]
    assert rows(returns.calendar_weekend_working(cal), "date") == [(date(2024, 1, 6),)]


def test_dates_the_calendar_lacks(spark):
    data = perf(spark, (1, 0.1), (31, 0.1), (31, None))
    found = lookups.missing_calendar_dates(data, calendar(spark))
    assert rows(found) == [(date(2024, 1, 31), 2)]


STAGING = (
    "country_code long, country_name string, iso_alpha2 string, year long, record_type string, "
    "value double, carbon double, carbon_pct_of_total double, crop_land double, "
    "grazing_land double, forest_land double, fishing_ground double, builtup_land double, "
    "_updated_at timestamp_ntz"
)


def staging(spark, *data):
    full = [
        (code, f"C{code}", "AA", year, kind, value, carbon, None, 1.0, 2.0, 3.0, 4.0, 5.0, at)
        for code, year, kind, value, carbon, at in data
    ]
    return spark.createDataFrame(full, STAGING)


T1, T2 = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 12)


def test_mart_pivots_types(spark):
    df = staging(
        spark, (1, 2020, "EFConsTotGHA", 10.0, 4.0, T1), (1, 2020, "BiocapTotGHA", 7.0, None, T1),
        (1, 2020, "EFImportsPerCap", 2.5, None, T1), (1, 2020, "EFConsPerCap", 1.5, None, T1),
        (1, 2020, "EFCcarb", 9.0, 3.0, T1), (2, 2020, "EFCtot", 5.0, None, T1),
        (3, 2020, "efconstotgha", 5.0, None, T1),
    )
    found = {r.country_code: r for r in marts.mart_summary(df).collect()}
    one = found[1]
    assert (one.total_ecological_footprint, one.total_biocapacity, one.ecological_deficit) == (10.0, 7.0, 3.0)
    assert one.footprint_per_capita == 2.5  # every type that names both counts
    assert one.carbon_footprint == 3.0 and one.builtup_footprint == 5.0
    assert found[2].ecological_deficit is None and found[2].total_ecological_footprint == 5.0
    assert found[3].total_ecological_footprint is None  # matching minds case


def test_recent_summary_forgets_older_rows(spark):
    df = staging(spark, (1, 2020, "EFConsTotGHA", 10.0, None, T1), (1, 2020, "BiocapTotGHA", 7.0, None, T2))
    recent = marts.mart_summary_recent(df, F.lit(T2).cast("timestamp_ntz"), hours=1).first()
    assert recent.total_ecological_footprint is None and recent.total_biocapacity == 7.0
    touched = spark.createDataFrame([(1, 2020), (1, 2020)], "country_code long, year long")
    whole = marts.mart_summary_for(df, touched).first()
    assert whole.ecological_deficit == 3.0


def test_latest_year_of_each_country(spark):
    df = staging(
        spark, (1, 2019, "EFConsTotGHA", 1.0, None, T1), (1, 2020, "EFConsTotGHA", 2.0, None, T1),
        (2, 2018, "EFConsTotGHA", 3.0, None, T1), (None, 2021, "EFConsTotGHA", 4.0, None, T1),
    )
    assert rows(lookups.latest_per_country(df), "country_code", "year") == [(1, 2020), (2, 2018)]


def test_orphans_count_rows_and_null_codes(spark):
    df = staging(
        spark, (1, 2020, "A", 1.0, None, T1), (2, 2020, "A", 1.0, None, T1),
        (2, 2020, "B", 1.0, None, T1), (None, 2020, "A", 1.0, None, T1),
    )
    mart = spark.createDataFrame([(1, 2020)], "country_code long, year long")
    assert tuple(lookups.orphaned_staging(df, mart).first()) == (3, "PASS")
    assert lookups.orphaned_staging(df, mart, threshold=2).first().status == "WARNING"


def test_types(spark):
    sample = spark.createDataFrame([("EF",), ("BC",), ("EF",), (None,), ("",)], "record_type string")
    meta = spark.createDataFrame(
        [(1, "b", "", "BC"), (2, "a", "First", "EF"), (3, "c", "Second", "EF"), (4, None, "x", "XX")],
        "position int, code string, name string, record string",
    )
    assert rows(lookups.discover_types(sample, meta)) == [("BC", "BC"), ("EF", "First")]
    alone = lookups.discover_types(sample.filter("false"), meta)
    assert rows(alone) == [("BC", ""), ("EF", "Second")]


def test_top_emitters(spark):
    df = spark.createDataFrame(
        [(1, "A", 2023, "EFConsTotGHA", None), (2, "B", 2023, "EFConsTotGHA", 2_345_678.0),
         (3, "C", 2022, "EFConsTotGHA", 9e9), (4, "D", 2023, "EFConsTotGHA", 5e6)],
        "country_code long, country_name string, year long, record_type string, value double",
    )
    found = [tuple(r) for r in marts.top_emitters(df, 2023, n=3).collect()]
    assert found == [("D", 2023, 5.0), ("B", 2023, 2.35), ("A", 2023, None)]
    assert "TakeOrderedAndProject" in plan_of(marts.top_emitters(df, 2023))


@pytest.mark.parametrize("count", [2, 3])
def test_business_keys(spark, count):
    df = spark.createDataFrame([("a",)] * count + [("b",)], "k string")
    assert rows(marts.business_key_dups(df, ["k"])) == [("a", count)]
