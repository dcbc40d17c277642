"""Registration of queries and the common table expressions their SQL shares."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

AS_OF = "2024-01-31 00:00:00"

FACT_TYPE = """CASE event_type WHEN 'view' THEN 'EFConsTotGHA' WHEN 'click' THEN 'BiocapTotGHA'
    WHEN 'purchase' THEN 'EFConsPerCap' WHEN 'signup' THEN 'BiocapPerCap'
    ELSE 'EFConsCarbonGHA' END"""


# Written out, not made from the operators' own tables, so that a wrong metric shows.
MART_METRICS = """
  max(value) FILTER (WHERE record_type LIKE '%EFConsTot%' OR record_type = 'EFCtot')
    AS total_ecological_footprint,
  max(carbon) FILTER (WHERE record_type LIKE '%Carbon%' OR record_type = 'EFCcarb')
    AS carbon_footprint,
  max(value) FILTER (WHERE record_type LIKE '%BiocapTot%' OR record_type = 'BioCaptot')
    AS total_biocapacity,
  max(value) FILTER (WHERE record_type LIKE '%EFConsTot%' OR record_type = 'EFCtot')
    - max(value) FILTER (WHERE record_type LIKE '%BiocapTot%' OR record_type = 'BioCaptot')
    AS ecological_deficit,
  max(carbon_pct_of_total) AS carbon_percentage"""
MART_COLUMNS = f"""{MART_METRICS},
  max(value) FILTER (WHERE record_type LIKE '%PerCap%' AND record_type LIKE '%EF%')
    AS footprint_per_capita,
  max(carbon) FILTER (WHERE record_type LIKE '%CarbonPerCap%' OR record_type = 'EFCcarbPerCap')
    AS carbon_per_capita,
  max(value) FILTER (WHERE record_type LIKE '%BiocapPerCap%' OR record_type = 'BioCaptotPerCap')
    AS biocapacity_per_capita,
  max(crop_land) AS cropland_footprint, max(grazing_land) AS grazing_footprint,
  max(forest_land) AS forest_footprint, max(fishing_ground) AS fishing_footprint,
  max(builtup_land) AS builtup_footprint"""

LATEST = (
    "row_number() OVER (PARTITION BY country_code, year, record_type "
    "ORDER BY transformed_at DESC NULLS LAST, _loaded_at DESC, _row_number DESC)"
)


def mart_sql(source: str) -> str:
    return f"""SELECT country_code, year, max(country_name) AS country_name,
  max(iso_alpha2) AS iso_alpha2, {MART_COLUMNS} FROM {source} GROUP BY country_code, year"""


# Shared expressions, in the order a WITH clause needs them.
CTES: dict[str, str] = {
    "fp": f"""SELECT event_id, user_id AS country_code, 'C' || user_id AS country_name,
  'c' || user_id AS short_name,
  chr(CAST(65 + user_id % 26 AS INTEGER)) || chr(CAST(65 + user_id // 26 % 26 AS INTEGER))
    AS iso_alpha2,
  CAST(2000 + day(ts) AS BIGINT) AS year, {FACT_TYPE} AS record_type,
  value * 0.25 AS crop_land, value * 0.125 AS grazing_land, value * 0.5 AS forest_land,
  value * 0.0625 AS fishing_ground, k * 0.03125 AS builtup_land, k AS carbon, value,
  CASE WHEN k >= 50 THEN '3A' ELSE '2B' END AS score,
  CASE WHEN value > 0 THEN round(k / value * 100, 2) END AS carbon_pct_of_total,
  CAST(date_trunc('day', ts) AS TIMESTAMP) AS extracted_at,
  CASE WHEN k >= 5 THEN TIMESTAMP '2024-01-01' + to_hours(CAST(k AS INTEGER)) END
    AS transformed_at,
  ts AS _loaded_at, 'load_' || strftime(ts, '%Y%m%d') || '.json' AS _source_file,
  event_id AS _row_number
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) AS e""",
    "stg": f"""SELECT * EXCLUDE (rn), _loaded_at AS _updated_at
  FROM (SELECT *, {LATEST} AS rn FROM fp) AS x WHERE rn = 1""",
    "morning": f"""SELECT * EXCLUDE (rn), _loaded_at AS _updated_at
  FROM (SELECT *, {LATEST} AS rn FROM fp WHERE hour(_loaded_at) < 12) AS x WHERE rn = 1""",
    "afternoon": f"""SELECT * EXCLUDE (rn), _loaded_at AS _updated_at
  FROM (SELECT *, {LATEST} AS rn FROM fp WHERE hour(_loaded_at) >= 12) AS x WHERE rn = 1""",
    "mart": mart_sql("(SELECT * FROM stg WHERE _loaded_at < TIMESTAMP '2024-01-20')"),
    "runs": f"""SELECT CAST(event_id AS VARCHAR) AS run_id, upper(event_type) AS stage,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
  ts AS scheduled_time,
  ts + to_seconds(CAST(json_extract_string(props, '$.k') AS INTEGER) * 10) AS completed_time,
  CASE WHEN event_type = 'error' THEN 'E' || json_extract_string(props, '$.k') END AS error_code
  FROM events""",
    "perf": """SELECT 'F' || l_linenumber AS fund_code, CAST(l_shipdate AS DATE) AS market_date,
  l_returnflag AS return_type,
  CASE WHEN max(l_quantity) > 48 AND min(l_quantity) > 47 THEN NULL
    ELSE max(l_discount) - 0.05 END AS daily_return
  FROM lineitem GROUP BY 1, 2, 3""",
    "odd": """SELECT fund_code, market_date, return_type,
  CASE WHEN low < 2 THEN daily_return - 1 ELSE daily_return END AS daily_return
  FROM (SELECT 'F' || l_linenumber AS fund_code, CAST(l_shipdate AS DATE) AS market_date,
    l_returnflag AS return_type, max(l_discount) - 0.05 AS daily_return, min(l_quantity) AS low
    FROM lineitem GROUP BY 1, 2, 3) AS g""",
    "cal": """SELECT date, CAST(isodow(date) AS INTEGER) AS day_of_week,
  dayname(date) AS text_day_of_week, monthname(date) AS text_month_of_year,
  strftime(date, '%m-%d') IN ('01-01', '05-01', '12-25') AS is_holiday,
  isodow(date) <= 5 OR (isodow(date) = 6 AND day(date) = 15) AS is_working_day
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) AS d""",
    "countries": """SELECT c_custkey AS country_code,
  CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END AS country_name, n_name AS short_name,
  c_mktsegment AS segment, c_acctbal AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
}

_NEEDS = {
    "stg": ["fp"],
    "morning": ["fp"],
    "afternoon": ["fp"],
    "mart": ["fp", "stg"],
}


def sql(select: str, *names: str) -> str:
    """``select`` with the named shared expressions, and those they need, in front."""
    wanted = {n for name in names for n in [*_NEEDS.get(name, []), name]}
    parts = [f"{name} AS ({text})" for name, text in CTES.items() if name in wanted]
    return f"WITH {', '.join(parts)} {select}" if parts else select


def query(name: str, oracle: str | None = None):
    """Register a query, with its SQL where it has one."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            SQL[name] = oracle
        return run

    return register
