"""Whole runs: transform steps, batch, direct and staged runs, refresh and backfill."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.catalog import inputs as I
from snapmart.catalog.registry import AS_OF, query, sql
from snapmart.operators import clean
from snapmart.plans import batch, redrive
from snapmart.session import scratch_path
from snapmart.tables import store

KEY = ", ".join(schemas.FACT_KEY)
ORDER = ["_row_number"]


@query(
    "transform_batch",
    sql(
        f"""SELECT {KEY}, value, TIMESTAMP '{AS_OF}' AS transformed_at, 'fact' AS kind FROM
        (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY _row_number) AS rn FROM fp
          WHERE country_code <> 0) AS x WHERE rn = 1
        UNION ALL SELECT country_code, NULL AS year, country_name AS record_type, balance AS value,
          TIMESTAMP '{AS_OF}' AS transformed_at, 'country' AS kind FROM countries
          WHERE country_code <> 0""",
        "fp",
        "countries",
    ),
)
def transform_batch(spark: SparkSession, sf: str) -> DataFrame:
    people = I.countries(spark, sf).withColumn("_row_number", F.col("country_code"))
    countries, facts = batch.transform_batch(people, I.facts(spark, sf), I.as_of(), ORDER)
    names = [*schemas.FACT_KEY, "value", "transformed_at"]
    rows = facts.select(*names, F.lit("fact").alias("kind"))
    return rows.unionByName(
        countries.select(
            "country_code",
            F.lit(None).cast("bigint").alias("year"),
            F.col("country_name").alias("record_type"),
            F.col("balance").alias("value"),
            "transformed_at",
            F.lit("country").alias("kind"),
        )
    )


@query(
    "transform_enriched",
    sql(
        f"""SELECT {KEY}, value, carbon_pct_of_total, TIMESTAMP '{AS_OF}' AS transformed_at FROM
        (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY _row_number) AS rn FROM
          (SELECT * REPLACE (CASE WHEN record_type = 'EFConsCarbonGHA' THEN 'unknown'
            ELSE record_type END AS record_type) FROM fp WHERE country_code <> 0) AS y) AS x
        WHERE rn = 1""",
        "fp",
    ),
)
def transform_enriched(spark: SparkSession, sf: str) -> DataFrame:
    known = F.nullif("record_type", F.lit("EFConsCarbonGHA"))
    facts = I.facts(spark, sf).withColumn("record_type", known).drop("carbon_pct_of_total")
    rows = batch.transform_enriched(facts, I.as_of(), ORDER)
    return rows.select(*schemas.FACT_KEY, "value", "carbon_pct_of_total", "transformed_at")


# What the runs land: every fact row, several rows of a key, some without type, broken lines.
DIRTY = """SELECT event_id, country_code, year,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE record_type END AS record_type,
    value, carbon, score, carbon_pct_of_total FROM fp"""
BROKEN_EVERY = 97
ENVELOPE = 5


def _dirty(events: DataFrame, *keep: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 11 > 0, F.col("record_type"))
    return I.facts_of(events, *keep).withColumn("record_type", kind)


def _land(spark: SparkSession, sf: str, layout: str) -> tuple[str, str]:
    """Facts by year, in the order of their events, and countries, as JSON.

    'records' lands a record per line; 'lines' lands envelopes and bare arrays in turn, with
    ``ENVELOPE`` records each. One line in ``BROKEN_EVERY`` records is broken. Lines are dealt by year and
    event, so a year may lie in several files, whose names keep the order.
    """
    facts, people = scratch_path(spark, "landing"), scratch_path(spark, "countries")
    fields = [F.col(c).alias(f) for c, f in schemas.RECORD_FIELDS.items()]
    order, record = F.col("event_id"), F.struct(*schemas.RECORD_FIELDS.values())
    # Events are dealt as they are given: what finds the bounds reads them too, and neither the grouping
    # nor the order needs another exchange.
    events = I.table(spark, sf, "events").withColumns(
        {"folder": I.year_of(F.col("ts")), "group": F.floor(order / (ENVELOPE * 31))}
    )
    rows = _dirty(events.repartitionByRange("folder", "group"), "folder", "group")
    rows = rows.select("folder", "group", "event_id", *fields)

    def line(place: Column, value: Column) -> Column:
        return F.struct(place.cast("double").alias("place"), value.alias("value"))

    def broken(place: Column) -> Column:
        return line(place + 0.5, F.lit('{"countryCode": 1,'))

    if layout == "records":
        own = F.array(line(order, F.to_json(record)))
        both = F.when(order % BROKEN_EVERY == 0, F.concat(own, F.array(broken(order)))).otherwise(own)
        lines = rows.select("folder", F.inline(both))
    else:
        docs = rows.select("folder", "group", "event_id", record.alias("r")).groupBy("folder", "group").agg(
            F.array_sort(F.collect_list(F.struct("event_id", "r"))).alias("rs")
        )
        records = F.transform("rs", lambda x: x["r"])
        bare = F.to_json(records)
        envelope = F.to_json(F.struct(records.alias("footprint_data"), F.array().cast("array<string>").alias("record_types")))
        whole = line(F.col("rs")[0]["event_id"], F.when(F.col("group") % 2 == 0, bare).otherwise(envelope))
        cut = F.filter("rs", lambda x: x["event_id"] % BROKEN_EVERY == 0)
        both = F.concat(F.array(whole), F.transform(cut, lambda x: broken(x["event_id"])))
        lines = docs.select("folder", F.inline(both))
    lines = lines.sortWithinPartitions("folder", "place")
    lines.select("value", F.col("folder").alias("year")).write.partitionBy("year").text(facts)
    I.countries(spark, sf).select(
        F.col("country_code").alias("countryCode"),
        F.col("country_name").alias("countryName"),
        F.col("short_name").alias("shortName"),
    ).write.json(people)
    return facts, people


def _config(
    spark: SparkSession, sf: str, start: int, end: int, layout: str = "lines", **options
) -> batch.RunConfig:
    facts, people = _land(spark, sf, layout)
    return batch.RunConfig(
        landing=facts, countries_landing=people, root=scratch_path(spark, "root"), layout=layout,
        start_year=start, end_year=end, at=datetime(2024, 1, 31), **options,
    )


def _facts_of(spark: SparkSession, cfg: batch.RunConfig, target: str = "main") -> DataFrame:
    rows = store.read_table(spark, cfg.fact(target))
    return rows.select(*schemas.FACT_KEY, "value", "carbon", "score")


def loaded_sql(start: int, end: int, extra: str = "", unknown: bool = False) -> str:
    """The first landed row of every key of the years, of the rows that are usable."""
    kind = "coalesce(record_type, 'unknown')" if unknown else "record_type"
    return sql(
        f"""SELECT {KEY}, value, carbon, score{extra} FROM (
          SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY event_id) AS rn
          FROM (SELECT * REPLACE ({kind} AS record_type) FROM ({DIRTY}) AS d) AS e
          WHERE country_code <> 0 AND record_type IS NOT NULL AND year BETWEEN {start} AND {end})
        AS x WHERE rn = 1""",
        "fp",
    )


def aside_sql(start: int, end: int, need_type: bool = True) -> str:
    """Rows by why they were put aside, and the landed rows."""
    dirty = f"(SELECT * FROM ({DIRTY}) AS d WHERE year BETWEEN {start} AND {end})"
    broken = f"(SELECT * FROM {dirty} AS b WHERE event_id % {BROKEN_EVERY} = 0)"
    kind = (
        f"""UNION ALL SELECT 'no record type', count(*) FROM
        (SELECT event_id FROM {dirty} AS t WHERE record_type IS NULL UNION ALL SELECT event_id FROM {broken} AS t2)
        AS t3""" if need_type else ""
    )
    # The folder is the year of a record read by line; a broken document has none.
    return sql(
        f"""SELECT reason, CAST(n AS BIGINT) AS n FROM (
        SELECT 'unparsable' AS reason, count(*) AS n FROM {broken} AS u
        UNION ALL SELECT 'no country code', count(*) FROM
          (SELECT event_id FROM {dirty} AS c WHERE country_code = 0 UNION ALL SELECT event_id FROM {broken} AS c2) AS c3
        {kind}
        UNION ALL SELECT 'no year', count(*) FROM {broken} AS y
        UNION ALL SELECT 'landed', count(*) FROM
          (SELECT event_id FROM {dirty} AS l UNION ALL SELECT event_id FROM {broken} AS l2) AS l3)
        AS r WHERE n > 0""",
        "fp",
    )


def _aside(spark: SparkSession, cfg: batch.RunConfig, landed: int) -> DataFrame:
    """Reasons of the rows below ``failed``, with the number of landed rows."""
    bad = spark.read.parquet(f"{cfg.root}/failed/snapshot=*")
    reasons = bad.select(F.explode("_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
    total = spark.range(1).select(F.lit("landed").alias("reason"), F.lit(landed).cast("bigint").alias("n"))
    return reasons.union(total)


def _ran(done: dict) -> dict:
    if done["status"] != "success":
        raise RuntimeError(str(done))
    return done


@query("batch_run", loaded_sql(2001, 2020))
def batch_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs: the second goes on from the state of the first. Failed checks would stop them."""
    cfg = _config(spark, sf, 2001, 2010, layout="records")
    for end, day in ((2010, 30), (2020, 31)):
        _ran(batch.batch_run(spark, replace(cfg, end_year=end, at=datetime(2024, 1, day))))
    return _facts_of(spark, cfg)


@query("batch_run_aside", aside_sql(2003, 2020))
def batch_run_aside(spark: SparkSession, sf: str) -> DataFrame:
    """What a run puts aside from documents of several records: good and bad are all that landed."""
    cfg = _config(spark, sf, 2003, 2020)
    done = _ran(batch.batch_run(spark, cfg))
    return _aside(spark, cfg, done["extracted"])


@query(
    "batch_run_types",
    f"""SELECT record_type, CASE WHEN record_type LIKE 'EF%' THEN 'About ' || record_type
    ELSE record_type END AS record_type_description, CAST(count(*) AS BIGINT) AS n
    FROM ({loaded_sql(2005, 2012)}) AS l GROUP BY record_type""",
)
def batch_run_types(spark: SparkSession, sf: str) -> DataFrame:
    """Facts with the descriptions that landed beside them; of two for a type the first counts."""
    kinds = scratch_path(spark, "types")
    known = I.facts(spark, sf).filter("record_type LIKE 'EF%'").select("record_type").distinct()
    entry = F.struct(F.col("record_type").alias("record"), F.concat(F.lit("About "), "record_type").alias("name"))
    second = F.struct(F.col("record_type").alias("record"), F.lit("Second").alias("name"))
    line = F.to_json(F.struct(F.array(entry, second).alias("record_types")))
    known.select(line.alias("value")).write.text(kinds)
    cfg = replace(_config(spark, sf, 2005, 2012), types_landing=kinds)
    _ran(batch.batch_run(spark, cfg))
    rows = store.read_table(spark, cfg.fact("main"))
    return rows.groupBy("record_type", "record_type_description").agg(F.count("*").alias("n"))


_MEASURED = """SELECT 'null_country_codes' AS metric_name, 0::DOUBLE AS metric_value, 'PASS' AS status
    UNION ALL SELECT 'duplicate_records', 0::DOUBLE, 'PASS'
    UNION ALL SELECT 'negative_values', n::DOUBLE, CASE WHEN n > 0 THEN 'WARNING' ELSE 'PASS' END
      FROM (SELECT count(*) FILTER (WHERE value < 0 OR carbon < 0) AS n FROM l) AS c"""


@query(
    "quality_metrics_table",
    f"""WITH l AS ({loaded_sql(2005, 2012)})
    SELECT metric_name, metric_value, status, 2::BIGINT AS runs FROM ({_MEASURED}) AS m""",
)
def quality_metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics appended by a run and by a later check of the same table, read back."""
    cfg = replace(_config(spark, sf, 2005, 2012), measure=True)
    _ran(batch.batch_run(spark, cfg))
    batch.measure(spark, replace(cfg, at=datetime(2024, 2, 1)), "main")
    names = ["null_country_codes", "duplicate_records", "negative_values"]
    found = batch.read_quality(spark, cfg).filter(F.col("metric_name").isin(names))
    found = found.groupBy("metric_name", "metric_value", "status")
    return found.agg(F.count_distinct("check_timestamp").alias("runs"))


@query("direct_run", loaded_sql(2005, 2015))
def direct_run(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, sf, 2005, 2015)
    batch.direct_run(spark, cfg)
    return _facts_of(spark, cfg)


@query("direct_run_aside", aside_sql(2005, 2015))
def direct_run_aside(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, sf, 2005, 2015)
    done = batch.direct_run(spark, cfg)
    usable = batch._typed_facts(batch._landed_facts(spark, cfg, (2005, 2015)), cfg.now(), (2005, 2015))
    good = clean.require_fields(usable).count()
    return _aside(spark, cfg, good + done["quarantined"])


@query("staged_run", loaded_sql(2010, 2030, ", carbon_pct_of_total", unknown=True))
def staged_run(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, sf, 2010, 2030)
    _ran(batch.staged_run(spark, cfg))
    rows = store.read_table(spark, cfg.fact("main"))
    return rows.select(*schemas.FACT_KEY, "value", "carbon", "score", "carbon_pct_of_total")


@query("staged_run_aside", aside_sql(2010, 2030, need_type=False))
def staged_run_aside(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, sf, 2010, 2030)
    raw = batch.extract_stage(spark, cfg)
    batch.transform_stage(spark, raw["path"], cfg.now())
    return _aside(spark, cfg, raw["records_count"])


@query("full_refresh", loaded_sql(2015, 2025))
def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Years loaded before and not in the refreshed range are gone."""
    cfg = _config(spark, sf, 2001, 2010)
    batch.direct_run(spark, cfg)
    _ran(batch.full_refresh(spark, replace(cfg, start_year=2015, end_year=2025)))
    return _facts_of(spark, cfg)


@query("backfill_range", loaded_sql(2001, 2012))
def backfill_range(spark: SparkSession, sf: str) -> DataFrame:
    """2001 to 2008, then 2006 to 2012 twice: later years are added, none doubled."""
    cfg = _config(spark, sf, 2001, 2008)
    batch.direct_run(spark, cfg)
    for _ in range(2):
        batch.backfill_range(spark, cfg, 2006, 2012)
    return _facts_of(spark, cfg)


def _redriven_sql(start: int, end: int) -> str:
    dirty = f"(SELECT * FROM ({DIRTY}) AS d WHERE year BETWEEN {start} AND {end})"
    return sql(
        f"""SELECT 'resolved' AS status, CAST(2 AS BIGINT) AS attempt, CAST(count(*) AS BIGINT) AS rows
        FROM {dirty} AS r WHERE country_code = 0 AND record_type IS NOT NULL
        UNION ALL SELECT 'bad', CAST(3 AS BIGINT), CAST(count(*) AS BIGINT) FROM
          (SELECT event_id FROM {dirty} AS t WHERE record_type IS NULL
           UNION ALL SELECT event_id FROM {dirty} AS b WHERE event_id % {BROKEN_EVERY} = 0) AS x""",
        "fp",
    )


def _redriven(spark: SparkSession, sf: str) -> batch.RunConfig:
    """Rows put aside judged three times: as they are, with a code for code 0, and once more."""
    cfg = _config(spark, sf, 2005, 2015)
    batch.direct_run(spark, cfg)
    code = F.when(F.col("countryCode") == "0", "999").otherwise(F.col("countryCode"))
    redrive.redrive(spark, cfg)
    for _ in range(2):
        redrive.redrive(spark, cfg, lambda rows: rows.withColumn("countryCode", code))
    return cfg


@query("redrive", _redriven_sql(2005, 2015))
def redrive_rows(spark: SparkSession, sf: str) -> DataFrame:
    return redrive.redrive_report(spark, _redriven(spark, sf))


@query(
    "redrive_facts",
    sql(
        f"""SELECT country_code, year, record_type, CAST(count(*) AS BIGINT) AS n FROM
        (SELECT DISTINCT 999 AS country_code, year, record_type FROM ({DIRTY}) AS d
         WHERE country_code = 0 AND record_type IS NOT NULL AND year BETWEEN 2005 AND 2015) AS k
        GROUP BY ALL""",
        "fp",
    ),
)
def redrive_facts(spark: SparkSession, sf: str) -> DataFrame:
    """The facts of the corrected code: one row per key, however many rows were put aside."""
    cfg = _redriven(spark, sf)
    rows = store.read_table(spark, cfg.fact("main")).filter("country_code = 999")
    found = rows.groupBy(*schemas.FACT_KEY).agg(F.count("*").alias("n"))
    return found.withColumn("country_code", F.col("country_code").cast("int"))


@query(
    "backfill_countries",
    sql(
        """SELECT DISTINCT country_code, country_name FROM fp
        WHERE country_code <> 0 AND year BETWEEN 2005 AND 2007""",
        "fp",
    ),
)
def backfill_countries(spark: SparkSession, sf: str) -> DataFrame:
    """Countries known from the envelopes of 2005 to 2007 stay when 2006 is loaded again."""
    path = scratch_path(spark, "landed")
    rows = I.facts(spark, sf).filter("year BETWEEN 2005 AND 2007")
    people = F.struct(F.col("country_code").alias("countryCode"), F.col("country_name").alias("countryName"))
    line = F.to_json(F.struct(F.array(people).alias("countries")))
    rows.select(line.alias("value"), "year").write.partitionBy("year").text(path)
    cfg = batch.RunConfig(path, scratch_path(spark, "root"), 2005, 2007, at=datetime(2024, 1, 31))
    batch.direct_run(spark, cfg)
    batch.backfill_range(spark, cfg, 2006, 2006)
    return store.read_table(spark, cfg.countries("main")).select("country_code", "country_name")
