"""Marts, views, weekly returns, table summaries, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.catalog import inputs as I
from snapmart.catalog.registry import AS_OF, MART_METRICS, mart_sql, query, sql
from snapmart.operators import marts, returns

# Compounded returns have at most ten exact decimals here.
PLACES = 10

WEEKS = f"""SELECT fund_code, return_type, CAST(date_trunc('week', p.market_date) AS DATE)
    AS week_start_date, CAST(count(daily_return) AS BIGINT) AS n,
  min(p.market_date) AS first_market_date_in_week, max(p.market_date) AS last_market_date_in_week,
  round(exp(sum(ln(1.0 + daily_return))) - 1.0, {PLACES}) AS weekly_return
  FROM perf AS p JOIN cal AS c ON c.date = p.market_date
  WHERE c.is_working_day AND NOT c.is_holiday AND daily_return IS NOT NULL GROUP BY 1, 2, 3"""

EXPECTED = """SELECT CAST(date_trunc('week', date) AS DATE) AS week_start_date,
  CAST(count(*) AS BIGINT) AS expected_trading_days
  FROM cal WHERE is_working_day AND NOT is_holiday GROUP BY 1"""


def _rounded(df: DataFrame, column: str = "weekly_return", places: int = PLACES) -> DataFrame:
    return df.withColumn(column, F.round(column, places))


@query("mart_summary", sql(mart_sql("stg"), "stg"))
def mart_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_summary(I.staging(spark, sf))


@query(
    "mart_summary_recent",
    sql(
        mart_sql(
            f"(SELECT * FROM stg WHERE _updated_at >= TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR)"
        ),
        "stg",
    ),
)
def mart_summary_recent(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_summary_recent(I.staging(spark, sf), I.as_of(), hours=48)


@query(
    "summary_view",
    sql(
        f"""SELECT country_code, country_name, iso_alpha2, year, {MART_METRICS},
        max(_updated_at) AS last_updated FROM stg
        GROUP BY country_code, country_name, iso_alpha2, year""",
        "stg",
    ),
)
def summary_view(spark: SparkSession, sf: str) -> DataFrame:
    return marts.summary_view(I.staging(spark, sf))


@query(
    "trends_view",
    sql(
        """SELECT country_name, iso_alpha2, year,
        round(sum(value) FILTER (WHERE contains(record_type, 'EFConsTot')), 6) AS total_footprint,
        round(sum(carbon), 6) AS carbon_footprint,
        max(carbon_pct_of_total) AS carbon_percentage
        FROM stg GROUP BY country_name, iso_alpha2, year""",
        "stg",
    ),
)
def trends_view(spark: SparkSession, sf: str) -> DataFrame:
    rows = marts.trends_view(I.staging(spark, sf))
    return _rounded(_rounded(rows, "total_footprint", 6), "carbon_footprint", 6)


@query(
    "legacy_summary",
    sql(
        """SELECT country_code, country_name, iso_alpha2, year,
        round(sum(carbon), 6) AS total_carbon_footprint_gha,
        CAST(count(*) AS BIGINT) AS record_count, max(score) AS latest_score
        FROM fp GROUP BY country_code, country_name, iso_alpha2, year""",
        "fp",
    ),
)
def legacy_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(marts.legacy_summary(I.facts(spark, sf)), "total_carbon_footprint_gha", 6)


@query(
    "weekly_returns",
    sql(
        f"""SELECT fund_code, return_type, week_start_date, n AS n_observations,
        first_market_date_in_week, last_market_date_in_week, weekly_return FROM ({WEEKS}) AS w""",
        "perf",
        "cal",
    ),
)
def weekly_returns(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(returns.weekly_returns(I.perf(spark, sf), I.calendar(spark, sf)))


@query(
    "weekly_returns_guarded",
    sql(
        f"""SELECT fund_code, return_type, CAST(date_trunc('week', p.market_date) AS DATE)
          AS week_start_date, CAST(count(*) AS BIGINT) AS n_observations,
        round(exp(sum(ln(1.0 + daily_return))) - 1.0, {PLACES}) AS weekly_return
        FROM (SELECT * FROM odd WHERE daily_return > -1) AS p JOIN cal AS c ON c.date = p.market_date
        WHERE c.is_working_day AND NOT c.is_holiday GROUP BY 1, 2, 3""",
        "odd",
        "cal",
    ),
)
def weekly_returns_guarded(spark: SparkSession, sf: str) -> DataFrame:
    rows = returns.weekly_returns(I.odd_perf(spark, sf), I.calendar(spark, sf), guard=True)
    names = [*returns.WEEK_KEY, "n_observations", "weekly_return"]
    return _rounded(rows).select(*names)


@query("expected_days", sql(EXPECTED, "cal"))
def expected_days(spark: SparkSession, sf: str) -> DataFrame:
    return returns.expected_days(I.calendar(spark, sf))


@query(
    "weekly_returns_strict",
    sql(
        f"""SELECT fund_code, return_type, w.week_start_date, expected_trading_days,
        n AS n_observations, weekly_return FROM ({WEEKS}) AS w JOIN ({EXPECTED}) AS e
          ON e.week_start_date = w.week_start_date WHERE n = expected_trading_days""",
        "perf",
        "cal",
    ),
)
def weekly_returns_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(returns.weekly_returns_strict(I.perf(spark, sf), I.calendar(spark, sf)))


@query(
    "weekly_returns_coverage",
    sql(
        f"""SELECT fund_code, return_type, w.week_start_date, expected_trading_days,
        n AS observed_trading_days,
        round(CAST(n AS DOUBLE) / nullif(expected_trading_days, 0), 4) AS coverage_ratio,
        n = expected_trading_days AS is_complete_week, first_market_date_in_week,
        last_market_date_in_week, weekly_return FROM ({WEEKS}) AS w JOIN ({EXPECTED}) AS e
          ON e.week_start_date = w.week_start_date""",
        "perf",
        "cal",
    ),
)
def weekly_returns_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(returns.weekly_returns_coverage(I.perf(spark, sf), I.calendar(spark, sf)))


@query(
    "country_coverage",
    sql(
        """SELECT country_code, country_name, iso_alpha2,
        CAST(count(DISTINCT year) AS BIGINT) AS years_available, min(year) AS first_year,
        max(year) AS last_year, CAST(count(DISTINCT record_type) AS BIGINT) AS record_types,
        max(_loaded_at) AS last_updated FROM stg GROUP BY country_code, country_name, iso_alpha2""",
        "stg",
    ),
)
def country_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return marts.country_coverage(I.staging(spark, sf))


@query(
    "load_summary",
    sql(
        f"""SELECT CAST(date_trunc('hour', _loaded_at) AS TIMESTAMP) AS load_hour,
        CAST(count(*) AS BIGINT) AS records_loaded,
        CAST(count(DISTINCT _source_file) AS BIGINT) AS files_loaded,
        CAST(count(DISTINCT country_code) AS BIGINT) AS countries_loaded,
        min(year) AS min_year, max(year) AS max_year FROM fp
        WHERE _loaded_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1""",
        "fp",
    ),
)
def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.load_summary(I.facts(spark, sf), I.as_of())


@query(
    "extract_metadata",
    sql(
        """SELECT CAST(count(*) AS BIGINT) AS total_records,
        CAST(count(DISTINCT country_code) AS BIGINT) AS unique_countries,
        CAST(count(DISTINCT record_type) AS BIGINT) AS unique_record_types FROM fp""",
        "fp",
    ),
)
def extract_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return marts.extract_metadata(I.facts(spark, sf))


@query(
    "table_counts",
    sql(
        """SELECT CAST(count(*) AS BIGINT) AS records,
        CAST(count(DISTINCT country_code) AS BIGINT) AS countries FROM fp""",
        "fp",
    ),
)
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return marts.table_counts(I.facts(spark, sf))


@query(
    "table_summary",
    """SELECT CAST(count(*) AS BIGINT) AS records,
    CAST(count(DISTINCT o_custkey) AS BIGINT) AS countries,
    CAST(count(DISTINCT year(o_orderdate)) AS BIGINT) AS years,
    CAST(min(year(o_orderdate)) AS BIGINT) AS min_year,
    CAST(max(year(o_orderdate)) AS BIGINT) AS max_year FROM orders""",
)
def table_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.table_summary(_orders(spark, sf))


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as facts: customers as countries."""
    return I.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("country_code"),
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("country_name"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.lit("EFConsTotGHA").alias("record_type"),
        F.col("o_totalprice").alias("value"),
        "o_orderkey",
    )


@query(
    "business_key_dups",
    """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS cnt FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def business_key_dups(spark: SparkSession, sf: str) -> DataFrame:
    return marts.business_key_dups(I.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "top_emitters",
    """SELECT 'O' || o_orderkey AS country_name, CAST(1998 AS BIGINT) AS year,
    round(o_totalprice / 1e6, 2) AS value_million FROM orders WHERE year(o_orderdate) = 1998
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10""",
)
def top_emitters(spark: SparkSession, sf: str) -> DataFrame:
    return marts.top_emitters(_orders(spark, sf), 1998, tie_break=["o_orderkey"])
