"""Batch runs over landed snapshots.

Each stage reads what the stage before it wrote, so stages can be restarted by path, lineage
stays short, and the quality checks run over stored columns.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schemas
from snapmart.functions import coalesce_names, is_missing, safe_long, whole_number
from snapmart.operators import clean, dedupe
from snapmart.operators.lookups import describe_types
from snapmart.operators.merge import merge
from snapmart.quality import postload, preload
from snapmart.sources.landed import (
    CORRUPT,
    INPUT_ORDER,
    SECTION,
    flatten_documents,
    flatten_sections,
    in_years,
    landed_fields,
    landed_schema,
    read_documents,
    read_records,
    record_fields,
)
from snapmart.tables import state as S
from snapmart.tables import sets, store, zones
from snapmart.tables.layout import literal, materialise


def transform_batch(
    countries: DataFrame, facts: DataFrame, at, order: Sequence[str] = tuple(INPUT_ORDER)
) -> tuple[DataFrame, DataFrame]:
    """Required fields, first row per key, transform time; for countries and facts."""
    kept = dedupe.dedupe_countries(countries, order)
    rows = dedupe.dedupe_first(clean.require_fields(facts), schemas.FACT_KEY, order)
    return clean.stamp_transformed(kept, at), clean.stamp_transformed(rows, at)


def transform_enriched(
    facts: DataFrame, at, order: Sequence[str] = tuple(INPUT_ORDER),
    on_missing_type: str = "unknown",
) -> DataFrame:
    """Like ``transform_batch`` for facts, with carbon share; a missing type becomes unknown.

    ``on_missing_type='drop'`` leaves such rows out.
    """
    if on_missing_type == "drop":
        rows = clean.require_fields(facts)
    else:
        rows = clean.default_record_type(
            clean.require_fields(facts, ["country_code", "year"]), on_missing_type
        )
    rows = dedupe.dedupe_first(rows, schemas.FACT_KEY, order)
    return clean.carbon_pct(clean.stamp_transformed(rows, at))


@dataclass(frozen=True)
class RunConfig:
    """One batch run: where files land, where tables live, what to load.

    ``layout`` is 'records' (a record per line), 'lines' (a document per line) or 'files'.
    Countries and record types lie in landings of their own or in the envelopes of the facts.
    ``evolve`` keeps landed fields that no schema names; ``measure`` runs the checks that follow a
    load and appends their metrics.
    """

    landing: str
    root: str
    start_year: int
    end_year: int
    job: str = "facts"
    countries_landing: str | None = None
    types_landing: str | None = None
    layout: str = "lines"
    targets: Sequence[str] = ("main",)
    record_types: Sequence[str] | None = None
    check: bool = True
    warn_only: bool = False
    raise_on_failure: bool = False
    enforce_contract: bool = False
    full_refresh: bool = False
    state_mode: str = "requested"
    evolve: bool = False
    measure: bool = False
    definitions: Mapping[str, Mapping] = field(
        default_factory=lambda: preload.DEFAULT_DEFINITIONS
    )
    at: datetime | None = None

    def now(self) -> datetime:
        at = self.at or datetime.now(timezone.utc)
        return at.astimezone(timezone.utc).replace(tzinfo=None) if at.tzinfo else at

    def fact(self, target: str) -> store.Table:
        return store.fact_table(f"{self.root}/{target}/footprint_data")

    def countries(self, target: str) -> store.Table:
        return store.Table(f"{self.root}/{target}/countries", COUNTRY_ROWS, ["country_code"])

    def types(self, target: str) -> store.Table:
        return store.Table(f"{self.root}/{target}/record_types", TYPE_ROWS, ["record_type"])

    @property
    def state_path(self) -> str:
        return f"{self.root}/_state"

    def mart(self, target: str) -> store.Table:
        return store.mart_table(f"{self.root}/{target}/mart")

    def tables(self, target: str) -> sets.TableSet:
        """The tables of a target, which runs change together."""
        return sets.TableSet(
            f"{self.root}/{target}/_set",
            {"footprint_data": self.fact(target), "countries": self.countries(target),
             "record_types": self.types(target), "mart": self.mart(target)},
        )

    @property
    def quality_path(self) -> str:
        return f"{self.root}/_quality"

    @property
    def log_path(self) -> str:
        return f"{self.root}/_runs"


COUNTRY_ROWS = schemas._struct(
    {"country_code": schemas.LONG},
    {
        **{c: schemas.TEXT for c in list(schemas.COUNTRY_FIELDS)[1:]},
        "extracted_at": schemas.STAMP,
        "transformed_at": schemas.STAMP,
    },
)
TRANSFORMED = T.StructType(
    [f for f in schemas.STAGING if f.name in store.FACT_COLUMNS]
)
TYPE_ROWS = schemas._struct({"record_type": schemas.TEXT}, {"description": schemas.TEXT})


def read_raw_snapshot(spark: SparkSession, path: str, extra: Sequence[str] = ()) -> DataFrame:
    """A raw snapshot with its fields, and the ``extra`` ones, as text and its input order.

    The snapshot holds text that did not parse in a column of its own, which is data here.
    """
    schema = landed_schema()
    for name in extra:
        schema = schema.add(name, T.StringType())
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_unread")
    return reader.json(path)


def staging_rows(facts: DataFrame, at, extra: Sequence[str] = ()) -> DataFrame:
    """Facts with every staging column and the extra ones, stamped with load and update time."""
    stamp = literal(at)
    rows = facts.withColumns({"_loaded_at": stamp, "_updated_at": stamp})
    more = [T.StructField(n, T.StringType()) for n in extra]
    return store.shaped(rows, T.StructType([*schemas.STAGING, *more]))


def _of_run(cfg: RunConfig, rows: DataFrame, window: tuple[int, int]) -> DataFrame:
    """Landed rows of the window and of the types asked for; rows without them are kept aside
    later, so they stay here."""
    rows = rows.filter(in_years(F.col("year"), window))
    if cfg.record_types is None:
        return rows
    return rows.filter(F.col("record").isin(list(cfg.record_types)) | is_missing(rows, "record"))


def _landed_facts(
    spark: SparkSession, cfg: RunConfig, window: tuple[int, int], extra: Sequence[str] = ()
) -> DataFrame:
    """Landed facts of a run, read straight from the landing. The same rows for every layout."""
    if cfg.layout == "records":
        return _of_run(cfg, read_records(spark, cfg.landing, years=window, extra=extra), window)
    docs = read_documents(spark, cfg.landing, cfg.layout, years=window)
    return _of_run(cfg, flatten_documents(docs, fields=[*record_fields(), *extra]), window)


class Landing:
    """What landed for a run: facts, countries and type descriptions.

    Documents that hold more than facts are parsed once into ``_landing``, a folder per section, and
    every later step reads the folders it needs; ``close`` deletes them. Single records need no
    such copy, and neither do facts that come without other sections and are read ``once``.
    """

    def __init__(
        self, spark: SparkSession, cfg: RunConfig, window: tuple[int, int],
        extra: Sequence[str] = (), once: bool = False,
    ):
        self.spark, self.cfg, self.window, self.extra = spark, cfg, window, extra
        self.path = None
        lone = cfg.countries_landing is not None and cfg.types_landing is not None
        if cfg.layout == "records" or (lone and once):
            return
        self.sections = {"footprint_data": [*record_fields(), *extra]}
        for section, landing in (
            ("countries", cfg.countries_landing), ("record_types", cfg.types_landing)
        ):
            if landing is None:
                self.sections[section] = record_fields(section)
        docs = read_documents(spark, cfg.landing, cfg.layout, years=window)
        rows = flatten_sections(docs, self.sections)
        self.schema = rows.schema
        self.path = f"{cfg.root}/_landing/{uuid.uuid4().hex}"
        rows.write.mode("errorifexists").partitionBy(SECTION).parquet(self.path)

    def _section(self, section: str) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows.filter(F.col(SECTION) == section).select(
            *self.sections[section], *INPUT_ORDER, CORRUPT
        )

    def facts(self) -> DataFrame:
        if self.path is None:
            return _landed_facts(self.spark, self.cfg, self.window, self.extra)
        return _of_run(self.cfg, self._section("footprint_data"), self.window)

    def countries(self) -> DataFrame:
        """Countries from their own landing, or from the envelopes the facts of the window came in.

        An envelope that does not parse was put aside with its facts. Single records without a
        landing of countries name none.
        """
        cfg = self.cfg
        if cfg.countries_landing is None and self.path is not None:
            return self._section("countries")
        if cfg.countries_landing is not None and cfg.layout == "records":
            return read_records(self.spark, cfg.countries_landing, "countries")
        if cfg.countries_landing is not None:
            docs = read_documents(self.spark, cfg.countries_landing, cfg.layout)
            return flatten_documents(docs, "countries")
        docs = read_documents(self.spark, cfg.landing, "lines", years=self.window)
        rows = flatten_documents(docs, "countries", bare=False)
        return rows.filter(F.col(CORRUPT).isNull())

    def types(self) -> DataFrame | None:
        """(record_type, description) from what landed; of several for a type the first."""
        cfg = self.cfg
        if cfg.types_landing is None:
            if cfg.layout == "records":
                return None
            rows = self._section("record_types")
        elif cfg.layout == "records":
            rows = read_records(self.spark, cfg.types_landing, "record_types")
        else:
            docs = read_documents(self.spark, cfg.types_landing, cfg.layout)
            rows = flatten_documents(docs, "record_types")
        named = rows.select(
            coalesce_names(rows, ["record_type", "record"]).alias("record_type"),
            coalesce_names(rows, ["description", "name"]).alias("description"),
            F.struct(*INPUT_ORDER).alias("place"),
        ).filter("record_type <> '' AND description <> ''")
        return named.groupBy("record_type").agg(
            F.min_by("description", "place").alias("description")
        )

    def close(self) -> None:
        if self.path is not None:
            store.delete_folder(self.spark, self.path)


def _new_fields(spark: SparkSession, cfg: RunConfig, window: tuple[int, int]) -> list[str]:
    """Names of landed fields that no schema knows, where the run keeps them."""
    if not cfg.evolve:
        return []
    layout = "lines" if cfg.layout == "records" else cfg.layout
    docs = read_documents(spark, cfg.landing, layout, years=window)
    known = {n.lower() for n in [*record_fields(), *schemas.STAGING.names, *INPUT_ORDER]}
    return [n for n in landed_fields(docs) if n.lower() not in known]


def _described(facts: DataFrame, types: DataFrame | None) -> DataFrame:
    """With the description of each type; a type without one describes itself."""
    if types is None:
        return facts.withColumn("record_type_description", F.col("record_type"))
    return describe_types(facts, types)


def _typed_facts(
    landed: DataFrame, at: datetime, window: tuple[int, int], extra: Sequence[str] = ()
) -> DataFrame:
    parsed = landed.filter(F.col(CORRUPT).isNull())
    facts = clean.normalise_records(parsed, at, keep=[*INPUT_ORDER, *extra])
    return facts.filter(F.col("year").between(*window))


def _typed_countries(landed: DataFrame, at: datetime) -> DataFrame:
    return clean.normalise_countries(landed.filter(F.col(CORRUPT).isNull()), at, keep=INPUT_ORDER)


def _no_number(field: str, number=safe_long) -> Column:
    return F.coalesce(number(F.col(field)), F.lit(0)) == 0


def _landed_rules(landed: DataFrame, need_type: bool = True) -> dict:
    """Why a landed row cannot become a fact."""
    rules = {
        "unparsable": F.col(CORRUPT).isNotNull(),
        "no country code": _no_number("countryCode"),
        "no year": _no_number("year", whole_number),
    }
    return {**rules, "no record type": is_missing(landed, "record")} if need_type else rules


def _country_rules(landed: DataFrame) -> dict:
    """Why a landed row cannot become a country."""
    return {
        "unparsable": F.col(CORRUPT).isNotNull(),
        "no country code": _no_number("countryCode"),
        "no country name": is_missing(landed, "countryName"),
    }


def quarantine(landed: DataFrame, rules: Mapping, root: str, name: str) -> int:
    """Keep landed rows that cannot be used, with their reasons; returns how many."""
    bad = clean.quarantine_split(landed, rules)[1]
    path, seen = f"{root}/failed/{name}", Observation()
    rows = bad.observe(seen, F.count("*").alias("rows"))
    rows.write.mode("errorifexists").parquet(path)
    if not seen.get["rows"]:
        store.delete_folder(landed.sparkSession, path)
    return seen.get["rows"]


def _put_aside(landed: DataFrame, people: DataFrame, root: str, name: str) -> dict[str, int]:
    """Unusable rows of both kinds, below ``failed``."""
    return {
        "quarantined": quarantine(landed, _landed_rules(landed), root, f"snapshot={name}"),
        "quarantined_countries": quarantine(people, _country_rules(people), root, f"countries={name}"),
    }


def _types_of(facts: DataFrame) -> DataFrame:
    """Each type with its description; that of a type that describes itself gives way."""
    return facts.groupBy("record_type").agg(
        F.max_by(
            "record_type_description", F.col("record_type_description") != F.col("record_type")
        ).alias("description")
    )


def _merge_types(target: DataFrame, source: DataFrame, **options) -> DataFrame:
    """Types of earlier loads stay, and no description is replaced by the bare type."""
    options.pop("as_of", None)
    return merge(
        target, source, ["record_type"], lambda t, s: s("description") != s("record_type"), **options
    )


def _load(
    cfg: RunConfig, target: str, facts: DataFrame, countries: DataFrame, replace_countries: bool,
    extra: Sequence[str] = (),
) -> dict[str, object]:
    """Load the tables of a target; those who read the set see all of it or nothing."""
    with sets.together(facts.sparkSession, cfg.tables(target)):
        return _load_tables(cfg, target, facts, countries, replace_countries, extra)


def _load_tables(
    cfg: RunConfig, target: str, facts: DataFrame, countries: DataFrame, replace_countries: bool,
    extra: Sequence[str],
) -> dict[str, object]:
    at, spark = cfg.now(), facts.sparkSession
    rows = staging_rows(facts, at, extra)
    people = countries.select(*[f.name for f in COUNTRY_ROWS])
    changes = []
    if cfg.evolve:
        before = store.read_table(spark, cfg.fact(target), evolved=True).schema
        changes = clean.schema_changes(before, rows.schema)
    if cfg.full_refresh:
        store.load_replace(rows, cfg.fact(target))
        counts = {"replaced": True}
    else:
        counts = store.load_merge(
            rows, cfg.fact(target), literal(at), order=["transformed_at"], evolve=cfg.evolve
        )
    if cfg.full_refresh or replace_countries:
        store.load_replace(people, cfg.countries(target))
    else:
        store.load_merge(people, cfg.countries(target))
    store.apply_merge(spark, cfg.types(target), _types_of(facts), _merge_types)
    return {**counts, "schema_changes": changes} if cfg.evolve else counts


def measure(spark: SparkSession, cfg: RunConfig, target: str) -> DataFrame:
    """Run the checks that follow a load on a target's stored tables and append their metrics."""
    at = literal(cfg.now())
    facts = store.read_table(spark, cfg.fact(target))
    mart = store.read_table(spark, cfg.mart(target))
    found = postload.run_postload(facts, target, at).withColumn("check_timestamp", at)
    found = found.unionByName(postload.sq_metrics(facts, mart, at))
    store.shaped(found, schemas.QUALITY_METRICS).write.mode("append").parquet(cfg.quality_path)
    return read_quality(spark, cfg).filter(F.col("check_timestamp") == at)


def read_quality(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """All metrics that runs below the root have appended."""
    return spark.read.schema(schemas.QUALITY_METRICS).parquet(cfg.quality_path)


def tidy(spark: SparkSession, cfg: RunConfig, as_of: date, keep_versions: int = 2) -> list[str]:
    """Delete copies past their retention and table versions nobody reads any more."""
    gone = [p for z in schemas.RETENTION_DAYS for p in zones.expire_partitions(spark, cfg.root, z, as_of)]
    for target in cfg.targets:
        gone += sets.expire_set(spark, cfg.tables(target), keep_versions)
    return gone


def _window(spark: SparkSession, cfg: RunConfig) -> tuple[int, int]:
    last = S.last_year_of(S.read_state(spark, cfg.state_path), cfg.job)
    return S.year_window(last, cfg.start_year, cfg.end_year, cfg.full_refresh)


class ChecksFailed(ValueError):
    """A run that was told to raise found its checks failed."""


class _Run:
    """Bookkeeping of one run: a run log row per stage, written as it ends, and the metrics."""

    def __init__(self, spark: SparkSession, cfg: RunConfig):
        self.spark, self.cfg = spark, cfg
        self.id, self.clock = uuid.uuid4().hex, time.monotonic()
        self.metrics: dict[str, object] = {"run_id": self.id, "loaded": {}}

    def log(self, stage: str, status: str, **facts) -> None:
        millis = int((time.monotonic() - self.clock) * 1000)
        row = S.log_row(self.id, stage, status, self.cfg.now(), millis=millis, **facts)
        S.log_runs(self.spark, self.cfg.log_path, [row])
        self.clock = time.monotonic()

    def end(self, status: str) -> dict[str, object]:
        self.metrics["status"] = status
        return self.metrics


def batch_run(spark: SparkSession, cfg: RunConfig) -> dict[str, object]:
    """Window, raw copy, transform, checks, staged copy, load of each target, state, run log.

    Ends as success, no_data, dq_failed or failed; with ``raise_on_failure`` failed checks raise.
    """
    run, at, landing = _Run(spark, cfg), cfg.now(), None
    try:
        window = _window(spark, cfg)
        extra = _new_fields(spark, cfg, window)
        landing = Landing(spark, cfg, window, extra, once=True)
        raw = zones.write_raw_snapshot(landing.facts(), cfg.root, at)
        run.metrics.update(window=window, raw_path=raw["path"], extracted=raw["record_count"])
        run.log("EXTRACT", "SUCCESS", records=raw["record_count"], source_file=raw["path"])
        if not raw["record_count"]:
            return run.end("no_data")

        landed = read_raw_snapshot(spark, raw["path"], extra)
        people = landing.countries()
        run.metrics.update(_put_aside(landed, people, cfg.root, zones.snapshot_name(at)))
        countries = _typed_countries(people, at)
        facts = _typed_facts(landed, at, window, extra)
        countries, facts = transform_batch(countries, facts, at)
        facts = _described(facts, landing.types())
        if cfg.enforce_contract:
            facts, broken = clean.contract_enforce(facts, schemas.FACT)
            broken.write.mode("errorifexists").parquet(
                f"{cfg.root}/failed/contract={zones.snapshot_name(at)}_{run.id}"
            )
        # Written first: the checks and the loads read the stored copies.
        staged = zones.write_staged(facts, cfg.root, at)
        stored = zones.read_staged(spark, cfg.root, staged["snapshot"], facts.schema)
        countries = materialise(countries)
        run.metrics.update(staged_path=staged["path"], valid=staged["record_count"])
        run.log("TRANSFORM", "SUCCESS", records=staged["record_count"])
        if cfg.check:
            results = preload.run_definitions(
                {"footprint_data": stored, "countries": countries}, cfg.definitions
            )
            report = preload.gate(preload.dq_report(results), raise_on_failure=False)
            run.metrics["checks"] = report
            run.log("CHECK", "SUCCESS" if report["passed"] else "WARNING")
            if not report["passed"] and not cfg.warn_only:
                if cfg.raise_on_failure:
                    raise ChecksFailed(f"{report['checks_failed']} checks failed: {report['failed_checks']}")
                return run.end("dq_failed")

        results = store.multi_target(
            stored,
            {t: lambda df, t=t: _load(cfg, t, df, countries, False, extra) for t in cfg.targets},
        )
        run.metrics["loaded"] = {r["target"]: r for r in results}
        failed = [r for r in results if r["status"] == "failed"]
        run.log("LOAD", "FAILED" if failed else "SUCCESS", records=staged["record_count"],
                error=str(failed[0]["result"]) if failed else None)
        if failed:
            return run.end("failed")

        if cfg.measure:
            bad = [measure(spark, cfg, t).filter("status = 'FAIL'").count() for t in cfg.targets]
            run.metrics["postload_failures"] = sum(bad)
            run.log("MEASURE", "WARNING" if sum(bad) else "SUCCESS")
        last = window[1]
        if cfg.state_mode == "observed":
            last = S.observed_last_year(stored, window[1])
        S.write_state(spark, cfg.state_path, cfg.job, last, run.id, at)
        return run.end("success")
    except ChecksFailed as error:
        run.log("RUN", "FAILED", error=str(error))
        raise
    except Exception as error:
        run.metrics["error"] = str(error)
        run.log("RUN", "FAILED", error=str(error))
        return run.end("failed")
    finally:
        if landing is not None:
            landing.close()


def direct_run(
    spark: SparkSession, cfg: RunConfig, keep_countries: bool = False
) -> dict[str, object]:
    """Extract and load without landing copies; facts are merged.

    Countries are replaced where they land in a list of their own, which has all of them; those found
    in the envelopes of some years are merged, as they are with ``keep_countries``.
    Returns the counts of each target, and how many rows were put aside.
    """
    whole = cfg.countries_landing is not None and not keep_countries
    at, window = cfg.now(), (cfg.start_year, cfg.end_year)
    extra = _new_fields(spark, cfg, window)
    landing = Landing(spark, cfg, window, extra)
    try:
        landed, people = landing.facts(), landing.countries()
        name = f"{zones.snapshot_name(at)}_{uuid.uuid4().hex[:8]}"
        aside = _put_aside(landed, people, cfg.root, name)
        facts = _typed_facts(landed, at, window, extra)
        facts = dedupe.dedupe_first(clean.require_fields(facts), schemas.FACT_KEY, INPUT_ORDER)
        facts = materialise(_described(facts, landing.types()))
        countries = dedupe.dedupe_countries(_typed_countries(people, at), INPUT_ORDER)
        countries = materialise(
            countries.withColumn("transformed_at", F.lit(None).cast("timestamp_ntz"))
        )
    finally:
        landing.close()
    return {**{t: _load(cfg, t, facts, countries, whole, extra) for t in cfg.targets}, **aside}


def extract_stage(spark: SparkSession, cfg: RunConfig) -> dict[str, object]:
    """Stage 1: the landed rows of the window as a raw snapshot."""
    window = (cfg.start_year, cfg.end_year)
    raw = zones.write_raw_snapshot(_landed_facts(spark, cfg, window), cfg.root, cfg.now())
    if not raw["record_count"]:
        return {"status": "no_data", "records_count": 0, "path": None}
    return {"status": "success", "records_count": raw["record_count"], "path": raw["path"]}


def transform_stage(spark: SparkSession, raw_path: str, at: datetime) -> dict[str, object]:
    """Stage 2: a raw snapshot, by path, to its transformed copy; unusable rows are put aside."""
    landed = read_raw_snapshot(spark, raw_path)
    root, _, name = raw_path.rpartition("/raw/")
    bad = quarantine(landed, _landed_rules(landed, need_type=False), root, name)
    parsed = landed.filter(F.col(CORRUPT).isNull())
    facts = clean.normalise_records(parsed, at, parse_code=False, keep=INPUT_ORDER)
    out = zones.write_transformed(transform_enriched(facts, at), raw_path, at)
    return {
        "status": "success", "records_count": out["record_count"], "path": out["path"],
        "quarantined": bad,
    }


def load_stage(spark: SparkSession, path: str, cfg: RunConfig, target: str) -> dict[str, object]:
    """Stage 3: a transformed copy, by path, merged into the fact table of a target."""
    rows = spark.read.schema(TRANSFORMED).json(path)
    with sets.together(spark, cfg.tables(target)):
        counts = store.insert_or_replace(rows, cfg.fact(target).path)
    return {"status": "success", "destination": target, "path": path, **counts}


def staged_run(spark: SparkSession, cfg: RunConfig) -> dict[str, object]:
    """The three stages one after the other, linked by path; stops when nothing was extracted."""
    first = extract_stage(spark, cfg)
    if not first["records_count"]:
        return first
    second = transform_stage(spark, first["path"], cfg.now())
    return load_stage(spark, second["path"], cfg, cfg.targets[0])


def full_refresh(spark: SparkSession, cfg: RunConfig) -> dict[str, object]:
    """Load the whole range and put it in place of the tables."""
    return batch_run(spark, replace(cfg, full_refresh=True))


def backfill_range(spark: SparkSession, cfg: RunConfig, start: int, end: int) -> dict[str, object]:
    """Load a range of years again, whatever the state says; running it twice changes nothing.

    Countries and types of other years stay.
    """
    again = replace(cfg, start_year=start, end_year=end)
    return direct_run(spark, again, keep_countries=True)
