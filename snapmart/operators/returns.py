"""Weekly compounded returns against a trading calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import week_start
from snapmart.operators.lookups import open_days

WEEK_KEY = ["fund_code", "return_type", "week_start_date"]


def _grouped(perf: DataFrame, calendar: DataFrame, observations: str, guard: bool) -> DataFrame:
    rows = open_days(perf, calendar).filter(F.col("daily_return").isNotNull())
    if guard:
        rows = rows.filter(F.col("daily_return") > -1)
    growth = F.ln(F.lit(1.0) + F.col("daily_return"))
    return rows.groupBy(
        "fund_code", "return_type", week_start(F.col("market_date")).alias("week_start_date")
    ).agg(
        F.count("daily_return").alias(observations),
        F.min("market_date").alias("first_market_date_in_week"),
        F.max("market_date").alias("last_market_date_in_week"),
        (F.exp(F.sum(growth)) - F.lit(1.0)).alias("weekly_return"),
    )


def _in_order(df: DataFrame, ordered: bool) -> DataFrame:
    return df.orderBy(*WEEK_KEY) if ordered else df


def weekly_returns(
    perf: DataFrame, calendar: DataFrame, guard: bool = False, ordered: bool = True
) -> DataFrame:
    """Compounded return per fund, type and week over the observed trading days.

    A return of -1 or less has no logarithm and drops out of the sum but not of the count;
    ``guard`` leaves such rows out altogether. Turn ``ordered`` off before further steps: the
    order costs a shuffle of its own.
    """
    return _in_order(_grouped(perf, calendar, "n_observations", guard), ordered)


def expected_days(calendar: DataFrame) -> DataFrame:
    """Trading days per week."""
    return (
        calendar.filter("is_working_day AND NOT is_holiday")
        .groupBy(week_start(F.col("date")).alias("week_start_date"))
        .agg(F.count("*").alias("expected_trading_days"))
    )


def weekly_returns_strict(
    perf: DataFrame, calendar: DataFrame, guard: bool = False, ordered: bool = True
) -> DataFrame:
    """Only weeks in which every trading day has a return."""
    weeks = _grouped(perf, calendar, "n_observations", guard)
    complete = (
        weeks.join(expected_days(calendar), "week_start_date")
        .filter("n_observations = expected_trading_days")
        .select(*WEEK_KEY, "expected_trading_days", "n_observations", "weekly_return")
    )
    return _in_order(complete, ordered)


def weekly_returns_coverage(
    perf: DataFrame, calendar: DataFrame, guard: bool = False, ordered: bool = True
) -> DataFrame:
    """Every week with how much of it was observed."""
    observed, expected = F.col("observed_trading_days"), F.col("expected_trading_days")
    ratio = F.try_divide(observed.cast("double"), expected.cast("double"))
    weeks = (
        _grouped(perf, calendar, "observed_trading_days", guard)
        .join(expected_days(calendar), "week_start_date")
        .select(
            *WEEK_KEY,
            "expected_trading_days",
            "observed_trading_days",
            F.round(ratio, 4).alias("coverage_ratio"),
            (observed == expected).alias("is_complete_week"),
            "first_market_date_in_week",
            "last_market_date_in_week",
            "weekly_return",
        )
    )
    return _in_order(weeks, ordered)


def invalid_returns(perf: DataFrame) -> DataFrame:
    """Returns that cannot be compounded."""
    return perf.filter("daily_return <= -1").orderBy("market_date", "fund_code", "return_type")


def calendar_duplicates(calendar: DataFrame) -> DataFrame:
    return (
        calendar.groupBy("date").agg(F.count("*").alias("cnt")).filter("cnt > 1").orderBy("date")
    )


def calendar_conflicts(calendar: DataFrame) -> DataFrame:
    """Days flagged holiday and working at once."""
    return (
        calendar.filter("is_holiday AND is_working_day")
        .select("date", "day_of_week", "text_day_of_week", "is_holiday", "is_working_day")
        .orderBy("date")
    )


def calendar_weekend_working(calendar: DataFrame) -> DataFrame:
    """Saturdays and Sundays (6 and 7) flagged working."""
    return (
        calendar.filter("day_of_week IN (6, 7) AND is_working_day")
        .select("date", "day_of_week", "text_day_of_week", "is_working_day")
        .orderBy("date")
    )
