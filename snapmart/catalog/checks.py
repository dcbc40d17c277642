"""Quality checks before and after a load, scheduled checks, calendar checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.catalog import inputs as I
from snapmart.catalog.registry import AS_OF, query, sql
from snapmart.operators import returns
from snapmart.quality import checks as Q
from snapmart.quality import postload as post
from snapmart.quality import preload as pre
from snapmart.quality import profiles
from snapmart.session import scratch_path

ALLOWED = ", ".join(f"'{t}'" for t in schemas.VALID_RECORD_TYPES)
KEY = ", ".join(schemas.FACT_KEY)
FACTS = "footprint_data"

Rows = Callable[[SparkSession, str], DataFrame]


def check_sql(
    table: str, name: str, value: str, passes: str, source: str = "fp", threshold: float = 0,
    breach: str = "FAIL", details: str = "",
) -> str:
    """SQL of one check row; ``passes`` tests v."""
    return f"""SELECT '{table}' AS table_name, '{name}' AS metric_name,
      CAST(v AS DOUBLE) AS metric_value, CAST({threshold} AS DOUBLE) AS threshold,
      CASE WHEN {passes} THEN 'PASS' ELSE '{breach}' END AS status, '{details}' AS details
      FROM (SELECT {value} AS v FROM {source}) AS q"""


def register(name: str, check: Callable[[DataFrame], Q.Check], select: str, rows: Rows, *ctes: str):
    """A query that runs one check over whole rows."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = rows(spark, sf)
        return Q.run_checks(df, [check(df)])

    query(name, sql(select, *ctes))(run)


def _balances(spark: SparkSession, sf: str) -> DataFrame:
    return I.countries(spark, sf).withColumn("value", F.col("balance"))


def _repeats(key: str, source: str, where: str = "TRUE") -> str:
    return f"""(SELECT coalesce(sum(n - 1), 0) AS surplus, count(*) FILTER (WHERE n > 1) AS groups
      FROM (SELECT count(*) AS n FROM {source} WHERE {where} GROUP BY {key}) AS g) AS r"""


# Before a load.
register(
    "dq_row_count", lambda df: pre.dq_row_count(FACTS, 5000),
    check_sql(FACTS, "row_count", "count(*)", "v >= 5000", threshold=5000), I.facts, "fp",
)
register(
    "dq_required", lambda df: pre.dq_required(df, FACTS, "country_code"),
    check_sql(FACTS, "required.country_code",
              "count(*) FILTER (WHERE country_code IS NULL OR country_code = 0)", "v <= 0"),
    I.facts, "fp",
)
register(
    "dq_year_range", lambda df: pre.dq_year_range(df, FACTS, 2005, 2020),
    check_sql(FACTS, "range.year", "count(*) FILTER (WHERE year < 2005 OR year > 2020)", "v <= 0",
              details="[2005, 2020]"),
    I.facts, "fp",
)
register(
    "dq_valid_types", lambda df: pre.dq_valid_types(df, FACTS, schemas.VALID_RECORD_TYPES),
    check_sql(FACTS, "valid.record_type",
              f"count(DISTINCT record_type) FILTER (WHERE record_type NOT IN ({ALLOWED}))",
              "v <= 0", breach="WARNING"),
    I.facts, "fp",
)
register(
    "dq_non_negative", lambda df: pre.dq_non_negative("countries"),
    check_sql("countries", "non_negative.value", "count(*) FILTER (WHERE balance < 0)", "v <= 0",
              "countries"),
    _balances, "countries",
)
register(
    "dq_unique_key", lambda df: pre.dq_unique_key(FACTS, schemas.FACT_KEY),
    check_sql(FACTS, "unique_key", "surplus", "v <= 0", _repeats(KEY, "fp"), details=KEY),
    I.facts, "fp",
)
register(
    "dq_unique_country", lambda df: pre.dq_unique_country(df, "countries"),
    check_sql("countries", "unique_key", "surplus", "v <= 0",
              _repeats("country_code", "fp", "country_code <> 0"), details="country_code"),
    I.facts, "fp",
)
register(
    "dq_coverage", lambda df: pre.dq_coverage(df, "countries", 150),
    check_sql("countries", "coverage", "count(DISTINCT country_code) FILTER (WHERE country_code <> 0)",
              "v >= 150", threshold=150, breach="WARNING"),
    I.facts, "fp",
)


@query(
    "dq_unknown_types",
    sql(
        f"""SELECT record_type, CAST(count(*) AS BIGINT) AS rows FROM fp
        WHERE record_type NOT IN ({ALLOWED}) GROUP BY record_type""",
        "fp",
    ),
)
def dq_unknown_types(spark: SparkSession, sf: str) -> DataFrame:
    return pre.unknown_types(I.facts(spark, sf))


_SURPLUS = _repeats(KEY, "fp")
_CODES = _repeats("country_code", "countries", "country_code <> 0")
REPORT = f"""SELECT failed = 0 AS passed, CAST(13 AS BIGINT) AS checks_run,
  CAST(13 - failed AS BIGINT) AS checks_passed, CAST(failed AS BIGINT) AS checks_failed,
  CAST(warned AS BIGINT) AS checks_warned FROM (
  SELECT (f.n < 1)::INT + (f.no_code > 0)::INT + (f.no_name > 0)::INT + (f.no_year > 0)::INT
    + (f.no_type > 0)::INT + (f.bad_year > 0)::INT + (f.negative > 0)::INT + (k.surplus > 0)::INT
    + (c.n < 1)::INT + (c.no_code > 0)::INT + (c.no_name > 0)::INT + (u.surplus > 0)::INT AS failed,
    (f.unknown > 0)::INT AS warned FROM
  (SELECT count(*) AS n, count(*) FILTER (WHERE country_code = 0) AS no_code,
    count(*) FILTER (WHERE country_name = '') AS no_name, count(*) FILTER (WHERE year = 0) AS no_year,
    count(*) FILTER (WHERE record_type = '') AS no_type,
    count(*) FILTER (WHERE year < 1960 OR year > 2030) AS bad_year,
    count(*) FILTER (WHERE value < 0) AS negative,
    count(*) FILTER (WHERE record_type NOT IN ({ALLOWED})) AS unknown FROM fp) AS f,
  (SELECT count(*) AS n, count(*) FILTER (WHERE country_code = 0) AS no_code,
    count(*) FILTER (WHERE country_name = '') AS no_name FROM countries) AS c,
  (SELECT surplus FROM {_SURPLUS}) AS k, (SELECT surplus FROM {_CODES}) AS u) AS x"""


def _standard(spark: SparkSession, sf: str) -> DataFrame:
    definitions = {**pre.STANDARD_DEFINITIONS, "countries": pre.DEFAULT_DEFINITIONS["countries"]}
    tables = {FACTS: I.facts(spark, sf), "countries": I.countries(spark, sf)}
    return pre.run_definitions(tables, definitions)


@query("dq_report", sql(REPORT, "fp", "countries"))
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """All checks of both tables, summed up."""
    return pre.dq_report(_standard(spark, sf)).drop("failed_checks", "warnings")


# After a load.
register(
    "pq_row_count", lambda df: post.pq_row_count("raw", 5000, 200000),
    check_sql("raw", "row_count", "count(*)", "v BETWEEN 5000 AND 200000", threshold=5000),
    I.facts, "fp",
)
register(
    "pq_freshness", lambda df: post.pq_freshness("raw", "_loaded_at", I.as_of()),
    check_sql("raw", "freshness._loaded_at",
              f"date_sub('second', max(_loaded_at), TIMESTAMP '{AS_OF}')",
              "coalesce(v < 86400, FALSE)", threshold=86400),
    I.facts, "fp",
)
register(
    "pq_missing", lambda df: post.pq_missing("raw", "transformed_at"),
    check_sql("raw", "missing.transformed_at", "count(*) FILTER (WHERE transformed_at IS NULL)",
              "v <= 0"),
    I.facts, "fp",
)
register(
    "pq_range", lambda df: post.pq_range("raw", "value", 1, 300),
    check_sql("raw", "range.value", "count(*) FILTER (WHERE value < 1 OR value > 300)", "v <= 0"),
    I.facts, "fp",
)
register(
    "pq_invalid_percent", lambda df: post.pq_invalid_percent("raw", "year", 2001, 2029),
    check_sql("raw", "invalid_percent.year",
              "count(*) FILTER (WHERE year < 2001 OR year > 2029) * 100.0::DOUBLE / count(*)",
              "v < 1.0", threshold=1),
    I.facts, "fp",
)
register(
    "pq_valid_values", lambda df: post.pq_valid_values("raw", "record_type", schemas.VALID_RECORD_TYPES),
    check_sql("raw", "valid.record_type",
              f"count(*) FILTER (WHERE record_type NOT IN ({ALLOWED}))", "v <= 0"),
    I.facts, "fp",
)
register(
    "pq_duplicates", lambda df: post.pq_duplicates("raw", schemas.FACT_KEY),
    check_sql("raw", "duplicates", "groups", "v <= 0", _repeats(KEY, "fp"), details=KEY),
    I.facts, "fp",
)
_SCHEMA = check_sql("raw", "schema", "2", "v <= 0", "(SELECT 1) AS one",
                    details="record_category, per_capita")
_MEASURED = check_sql("raw", "missing.value", "count(*) FILTER (WHERE value IS NULL)", "v <= 0")


@query("pq_schema", sql(f"({_SCHEMA}) UNION ALL ({_MEASURED})", "fp"))
def pq_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Two required columns do not exist: a failed row, not an error, next to the other check."""
    rows = I.facts(spark, sf)
    required = ["country_code", "year", "record_category", "per_capita"]
    return Q.run_checks(
        rows, [post.pq_schema(rows, "raw", required), post.pq_missing("raw", "value")]
    )


register(
    "pq_required_values", lambda df: post.pq_required_value("raw", "record_type", "EFCtot"),
    check_sql("raw", "present.record_type.EFCtot", "count(*) FILTER (WHERE record_type = 'EFCtot')",
              "v >= 1", threshold=1),
    I.facts, "fp",
)
register(
    "pq_distinct", lambda df: post.pq_distinct("raw", "year", 50),
    check_sql("raw", "distinct.year", "count(DISTINCT year)", "v >= 50", threshold=50),
    I.facts, "fp",
)
register(
    "pq_iso_format", lambda df: post.pq_iso_format("raw", "country_name"),
    check_sql("raw", "format.country_name",
              "count(*) FILTER (WHERE NOT regexp_matches(country_name, '^[A-Z]{2}$'))", "v <= 0"),
    I.facts, "fp",
)


@query(
    "pq_category",
    sql(
        check_sql("raw", "valid.category", "count(*) FILTER (WHERE category NOT IN ('biocapacity'))",
                  "v <= 0",
                  """(SELECT CASE WHEN record_type LIKE 'EF%' THEN 'ecological_footprint'
                    ELSE 'biocapacity' END AS category FROM fp) AS c"""),
        "fp",
    ),
)
def pq_category(spark: SparkSession, sf: str) -> DataFrame:
    """The category of a type comes from the record type table."""
    types = spark.createDataFrame(schemas.RECORD_TYPE_ROWS, schemas.RECORD_TYPES)
    rows = post.with_category(I.facts(spark, sf), types)
    return Q.run_checks(rows, [post.pq_valid_values("raw", "category", ["biocapacity"])])


def _count_where(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


_STANDARD = [
    check_sql("raw", "schema", "0", "v <= 0", "(SELECT 1) AS one"),
    check_sql("raw", "row_count", "count(*)", "v >= 1", threshold=1),
    check_sql("raw", "freshness._loaded_at",
              f"date_sub('second', max(_loaded_at), TIMESTAMP '{AS_OF}')", "v < 86400",
              threshold=86400),
    *[check_sql("raw", f"missing.{c}", _count_where(f"{c} IS NULL"), "v <= 0")
      for c in ["country_code", "country_name", "year", "record_type"]],
    check_sql("raw", "range.year", _count_where("year < 1960 OR year > 2030"), "v <= 0"),
    check_sql("raw", "range.value", _count_where("value < 0"), "v <= 0"),
    check_sql("raw", "valid.record_type", _count_where(f"record_type NOT IN ({ALLOWED})"), "v <= 0"),
    check_sql("raw", "duplicates", "groups", "v <= 0", _repeats(KEY, "fp"), details=KEY),
    *[check_sql("raw", f"present.record_type.{t}", _count_where(f"record_type = '{t}'"), "v >= 1",
                threshold=1) for t in ["EFCtot", "BioCaptot"]],
    check_sql("raw", "distinct.country_code", "count(DISTINCT country_code)", "v >= 150",
              threshold=150),
    check_sql("raw", "distinct.year", "count(DISTINCT year)", "v >= 50", threshold=50),
]


@query("pq_standard", sql(" UNION ALL ".join(f"({s})" for s in _STANDARD), "fp"))
def pq_standard(spark: SparkSession, sf: str) -> DataFrame:
    """The whole post-load set, required columns first."""
    return post.run_postload(I.facts(spark, sf), "raw", I.as_of())


@query(
    "pq_row_count_anomaly",
    """WITH log AS (SELECT date_trunc('day', ts) AS d, count(*) AS n FROM events GROUP BY 1),
    newest AS (SELECT max(d) AS d FROM log)
    SELECT CAST(last AS BIGINT) AS latest_count, round(mean, 6) AS mean_count,
    round(spread, 6) AS stddev_count,
    CASE WHEN abs(last - mean) > 3 * spread THEN 'WARNING' ELSE 'PASS' END AS status
    FROM (SELECT max(n) FILTER (WHERE d = (SELECT d FROM newest)) AS last,
      avg(n) FILTER (WHERE d <> (SELECT d FROM newest)) AS mean,
      stddev_pop(n) FILTER (WHERE d <> (SELECT d FROM newest)) AS spread FROM log) AS x""",
)
def pq_row_count_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    """The events of a day as one run."""
    log = (
        I.table(spark, sf, "events")
        .groupBy(F.date_trunc("day", "ts").alias("log_timestamp"))
        .agg(F.count("*").alias("records_processed"))
    )
    found = post.pq_row_count_anomaly(log)
    return found.withColumns(
        {"mean_count": F.round("mean_count", 6), "stddev_count": F.round("stddev_count", 6)}
    )


_SEASON = "dayname(d)"


@query(
    "pq_count_limits",
    f"""WITH p AS (SELECT user_id, CAST(date_trunc('day', ts) AS DATE) AS d, count(*) AS n FROM events
      GROUP BY 1, 2),
    l AS (SELECT DISTINCT d FROM p
      WHERE {_SEASON} = (SELECT {_SEASON} FROM (SELECT max(d) AS d FROM p) AS x)),
    last AS (SELECT max(d) AS d FROM l),
    u AS (SELECT user_id, min(d) AS seen FROM p WHERE d IN (SELECT d FROM l) GROUP BY 1),
    c AS (SELECT user_id, l.d, coalesce(n, 0) AS n FROM u JOIN l ON l.d >= seen
      LEFT JOIN p USING (user_id, d)),
    m AS (SELECT user_id, coalesce(max(n) FILTER (WHERE d = (SELECT d FROM last)), 0) AS n_rows,
      count(*) FILTER (WHERE d <> (SELECT d FROM last)) AS n_loads,
      median(n) FILTER (WHERE d <> (SELECT d FROM last)) AS median_rows,
      mad(CAST(n AS DOUBLE)) FILTER (WHERE d <> (SELECT d FROM last)) AS away FROM c GROUP BY 1),
    s AS (SELECT *, greatest(away * 1.4826 * 4, median_rows * 0.1) AS spread FROM m)
    SELECT user_id AS country_code, CAST(n_rows AS BIGINT) AS n_rows,
    CAST(n_loads AS BIGINT) AS n_loads, CAST(median_rows AS DOUBLE) AS median_rows,
    round(greatest(median_rows - spread, 0), 6) AS low_rows, round(median_rows + spread, 6) AS high_rows,
    CASE WHEN n_loads < 3 THEN 'NEW' WHEN n_rows < round(greatest(median_rows - spread, 0), 6) THEN 'LOW'
      WHEN n_rows > round(median_rows + spread, 6) THEN 'HIGH' ELSE 'PASS' END AS status FROM s""",
)
def pq_count_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a day as one load, profiled per user, then judged by loads of the same weekday."""
    events = I.table(spark, sf, "events").select(
        F.col("user_id").alias("country_code"), F.to_date("ts").alias("day"), "event_type", "value"
    )
    path = scratch_path(spark, "profiles")
    made = profiles.profile(events, ["country_code"], ["day"], "event_type", "value")
    profiles.append_profile(made, path)
    stored = profiles.read_profiles(spark, path)
    found = profiles.count_anomalies(
        stored, ["country_code"], "day", profiles.day_of_week(F.col("day"))
    )
    return found.withColumns({c: F.round(c, 6) for c in ("low_rows", "high_rows")})


# Scheduled.
def _stg(spark: SparkSession, sf: str) -> DataFrame:
    return I.facts(spark, sf)


SCHEDULED = {
    "sq_null_codes": (
        lambda df: post.sq_null_codes(),
        check_sql("staging", "null_country_codes", "count(*) FILTER (WHERE country_code IS NULL)",
                  "v <= 0", details="rows without a country code"),
    ),
    "sq_duplicates": (
        lambda df: post.sq_duplicates(),
        check_sql("staging", "duplicate_records", "groups", "v <= 0", _repeats(KEY, "fp"),
                  breach="WARNING", details="keys that occur more than once"),
    ),
    "sq_negative": (
        lambda df: post.sq_negative(),
        check_sql("staging", "negative_values", "count(*) FILTER (WHERE value < 0 OR carbon < 0)",
                  "v <= 0", breach="WARNING", details="rows with a negative measure"),
    ),
    "sq_years": (
        lambda df: post.sq_years(I.as_of()),
        check_sql("staging", "invalid_years", "count(*) FILTER (WHERE year < 1960 OR year > 2025)",
                  "v <= 0", details="years before 1960 or after next year"),
    ),
    "sq_names": (
        lambda df: post.sq_names(),
        check_sql("staging", "missing_country_names",
                  "count(*) FILTER (WHERE country_name IS NULL OR trim(country_name) = '')",
                  "v <= 0", "countries", breach="WARNING", details="rows without a country name"),
    ),
}
for _name, (_check, _select) in SCHEDULED.items():
    _countries = _name == "sq_names"
    register(_name, _check, _select, I.countries if _countries else _stg,
             "countries" if _countries else "fp")

_ORPHANS = check_sql(
    "staging", "orphaned_staging_records", "count(*)", "v <= 100",
    """(SELECT s.year FROM stg AS s LEFT JOIN mart AS m ON s.country_code = m.country_code
      AND s.year = m.year WHERE m.country_code IS NULL) AS o""",
    threshold=100, breach="WARNING", details="staging rows the mart does not have yet",
)


@query("sq_orphans", sql(_ORPHANS, "stg", "mart"))
def sq_orphans(spark: SparkSession, sf: str) -> DataFrame:
    staging = I.stored_staging(spark, sf)
    return Q.run_checks(staging, [post.sq_orphans(staging, I.lagging_mart(staging))])


def _on(source: str, select: str) -> str:
    return select.replace("FROM fp", f"FROM {source}").replace("FROM countries", f"FROM {source}")


_UNION = " UNION ALL ".join(
    [f"({_on('stg', s)})" for _, s in SCHEDULED.values()] + [f"({_ORPHANS})"]
)


@query(
    "sq_metrics",
    sql(f"SELECT *, TIMESTAMP '{AS_OF}' AS check_timestamp FROM ({_UNION}) AS u", "stg", "mart"),
)
def sq_metrics(spark: SparkSession, sf: str) -> DataFrame:
    staging = I.stored_staging(spark, sf)
    return post.sq_metrics(staging, I.lagging_mart(staging), I.as_of())


# Calendar and returns.
@query(
    "cal_duplicates",
    """SELECT CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS BIGINT) AS cnt FROM orders
    GROUP BY 1 HAVING count(*) > 1""",
)
def cal_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return returns.calendar_duplicates(I.calendar_feed(spark, sf))


@query(
    "cal_conflicts",
    sql(
        """SELECT date, day_of_week, text_day_of_week, is_holiday, is_working_day FROM cal
        WHERE is_holiday AND is_working_day""",
        "cal",
    ),
)
def cal_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return returns.calendar_conflicts(I.calendar(spark, sf))


@query(
    "cal_weekend_working",
    sql(
        """SELECT date, day_of_week, text_day_of_week, is_working_day FROM cal
        WHERE day_of_week IN (6, 7) AND is_working_day""",
        "cal",
    ),
)
def cal_weekend_working(spark: SparkSession, sf: str) -> DataFrame:
    return returns.calendar_weekend_working(I.calendar(spark, sf))


@query("invalid_returns", sql("SELECT * FROM odd WHERE daily_return <= -1", "odd"))
def invalid_returns(spark: SparkSession, sf: str) -> DataFrame:
    return returns.invalid_returns(I.odd_perf(spark, sf))
