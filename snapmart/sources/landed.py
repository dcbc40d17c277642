"""Landed JSON: whole documents (an envelope or a bare array per file) or JSON Lines.

A whole document is one task, so large landings should be JSON Lines, which Spark splits, or be
read by ``snapmart.sources.split``; lines that are single records go through ``read_records``,
which skips the flattening.
Scalars are read as text; ``normalise_records`` casts them, so a misfit is seen, not lost.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schemas
from snapmart.functions import whole_number

CORRUPT = "_corrupt_record"
SOURCE, ROW, BLOCK, SEQ = "_source_file", "_row_number", "_block", "_seq"
SECTION = "_section"

# Input order of a landed row: file, block within the file, document within the block, position.
INPUT_ORDER = [SOURCE, BLOCK, SEQ, ROW]


def in_years(year: Column, years: tuple[int, int]) -> Column:
    """Rows of the years asked for, and those whose year is none, which have to be put aside.

    Over a folder column this prunes folders, since nothing else is looked at.
    """
    number = whole_number(year.cast("string"))
    return F.coalesce(number.between(*years), F.lit(True))


def _texts(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def record_fields(section: str = "footprint_data") -> list[str]:
    """Fields of a landed record that the schemas know, under old and new names."""
    raw = {
        "footprint_data": list(schemas.RECORD_FIELDS.values()) + list(schemas.RECORD_FIELDS),
        "countries": list(schemas.COUNTRY_FIELDS.values()) + list(schemas.COUNTRY_FIELDS),
        "record_types": ["record_type", "description", "code", "name", "note", "record"],
    }[section]
    extra = ["record_type_description", "carbon_pct_of_total", "extracted_at", "transformed_at"]
    return list(dict.fromkeys(raw + (extra if section != "record_types" else [])))


def landed_schema(section: str = "footprint_data") -> T.StructType:
    """Landed fields as text, with the order columns: the shape of a raw snapshot."""
    text, number = T.StringType(), T.LongType()
    order = {SOURCE: text, BLOCK: number, SEQ: number, ROW: number, CORRUPT: text}
    schema = _texts(record_fields(section))
    for name, kind in order.items():
        schema = schema.add(name, kind)
    return schema


def read_documents(
    spark: SparkSession,
    path: str,
    layout: str = "lines",
    years: tuple[int, int] | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Landed texts with file and order columns; ``layout`` is 'lines' or 'files'.

    Where files lie in ``year=`` folders, ``years`` keeps the others from being read; a folder
    that names no year is read. ``recursive`` takes any folders and treats none of them as columns.
    """
    texts = spark.read.text(path, wholetext=layout == "files", recursiveFileLookup=recursive)
    if years is not None and "year" in texts.columns:
        texts = texts.filter(in_years(F.col("year"), years))
    return texts.select(
        F.col("value").alias("document"),
        F.col("_metadata.file_path").alias(SOURCE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(SEQ),
    ).filter(F.trim("document") != "")


def flatten_documents(
    docs: DataFrame,
    section: str = "footprint_data",
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = (SOURCE, BLOCK, SEQ),
    bare: bool = True,
) -> DataFrame:
    """One row per record of a section, with its 1-based position in its document.

    A document is an envelope or, unless ``bare`` is off, a bare array of records or one record.
    One that does not parse stays as a row of nulls with its text in the corrupt column.
    """
    record = _texts(list(fields) if fields is not None else record_fields(section))
    whole = T.StructType([*record.fields, T.StructField(section, T.ArrayType(record))])
    whole = T.StructType([*whole.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

    # Parsed in a projection of its own, so each document is parsed once however often used.
    is_array = F.ltrim("document").startswith("[")
    parsed = docs.select(
        *keep,
        "document",
        is_array.alias("_is_array"),
        F.when(is_array, F.from_json("document", T.ArrayType(record))).alias("_array"),
        F.when(~is_array, F.from_json("document", whole, options)).alias("_object"),
    )
    obj, array = F.col("_object"), F.col("_array")
    one = F.struct(*[obj[f.name].alias(f.name) for f in record])
    nothing = F.struct(*[F.lit(None).cast("string").alias(f.name) for f in record])
    has_record = F.lit(bare) & F.coalesce(*[obj[f.name] for f in record]).isNotNull()
    from_object = F.when(obj[section].isNotNull(), obj[section]).when(has_record, F.array(one))
    broken = F.when(F.col("_is_array"), array.isNull()).otherwise(obj[CORRUPT].isNotNull())
    records = (
        F.when(broken, F.array(nothing))
        .when(F.col("_is_array"), F.when(F.lit(bare), array))
        .otherwise(from_object)
    )
    rows = parsed.select(
        *keep,
        F.when(broken, F.col("document")).alias(CORRUPT),
        F.posexplode(records).alias("_pos", "_rec"),
    )
    return rows.select(
        "_rec.*", *keep, (F.col("_pos") + 1).cast("bigint").alias(ROW), CORRUPT
    )


def flatten_sections(
    docs: DataFrame,
    sections: Mapping[str, Sequence[str]],
    keep: Sequence[str] = (SOURCE, BLOCK, SEQ),
) -> DataFrame:
    """One row per record of several sections, named in ``_section``; each document is parsed once.

    ``sections`` maps a section to its fields. The first is read as by ``flatten_documents``. The
    others come out of the same parse as text, whatever it holds, and only that text is parsed
    again; records of theirs that do not parse are left out. Fields a section lacks are null.
    """
    (main, own), *others = sections.items()
    record = _texts(list(own))
    whole = T.StructType([*record.fields, T.StructField(main, T.ArrayType(record))])
    whole = T.StructType([*whole.fields, *_texts([*[s for s, _ in others], CORRUPT]).fields])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    names = list(dict.fromkeys(f for fields in sections.values() for f in fields))

    is_array = F.ltrim("document").startswith("[")
    first = docs.select(
        *keep,
        "document",
        is_array.alias("_is_array"),
        F.when(is_array, F.from_json("document", T.ArrayType(record))).alias("_array"),
        F.when(~is_array, F.from_json("document", whole, options)).alias("_object"),
    )

    def inside(section: str, fields: Sequence[str]) -> Column:
        """The section's text as an envelope of its own."""
        schema = T.StructType([T.StructField(section, T.ArrayType(_texts(list(fields))))])
        schema = schema.add(CORRUPT, T.StringType())
        text = F.concat(F.lit(f'{{"{section}":'), F.col("_object")[section], F.lit("}"))
        return F.from_json(text, schema, options).alias(f"_in_{section}")

    parsed = first.select("*", *[inside(s, fields) for s, fields in others])
    kinds = {s: _texts(list(fields)) for s, fields in sections.items()}
    row_type = T.StructType([T.StructField(SECTION, T.StringType()), T.StructField(ROW, T.LongType())])
    row_type = T.StructType([*row_type.fields, *[T.StructField(f"_of_{s}", k) for s, k in kinds.items()]])

    def rows_of(section: str, records: Column) -> Column:
        """The records as they were parsed; their fields become columns once there is a row for each."""

        def row(r: Column, at: Column) -> Column:
            own = [(r if s == section else F.lit(None).cast(k)).alias(f"_of_{s}") for s, k in kinds.items()]
            return F.struct(F.lit(section).alias(SECTION), (at + 1).cast("bigint").alias(ROW), *own)

        return F.coalesce(F.transform(records, row), F.array().cast(T.ArrayType(row_type)))

    obj, array = F.col("_object"), F.col("_array")
    one = F.struct(*[obj[f.name].alias(f.name) for f in record])
    nothing = F.struct(*[F.lit(None).cast("string").alias(f.name) for f in record])
    has_record = F.coalesce(*[obj[f.name] for f in record]).isNotNull()
    broken = F.when(F.col("_is_array"), array.isNull()).otherwise(obj[CORRUPT].isNotNull())
    records = (
        F.when(broken, F.array(nothing))
        .when(F.col("_is_array"), array)
        .when(obj[main].isNotNull(), obj[main])
        .when(has_record, F.array(one))
    )
    found = [rows_of(main, records)]
    for section, _ in others:
        part = F.col(f"_in_{section}")
        found.append(rows_of(section, F.when(part[CORRUPT].isNull(), part[section])))
    corrupt = F.when(broken, F.col("document")).alias(CORRUPT)
    rows = parsed.select(*keep, corrupt, F.explode(F.concat(*found)).alias("_rec"))

    def cell(name: str) -> Column:
        parts = [F.col(f"_rec._of_{s}")[name] for s, fields in sections.items() if name in fields]
        return F.coalesce(*parts).alias(name)

    of_main = F.when(F.col(f"_rec.{SECTION}") == main, F.col(CORRUPT)).alias(CORRUPT)
    return rows.select(*[cell(n) for n in names], *keep, f"_rec.{ROW}", of_main, f"_rec.{SECTION}")


def landed_fields(docs: DataFrame, section: str = "footprint_data") -> list[str]:
    """Names of all fields that records of a section have, in any document form."""
    text = F.col("document")
    records = T.ArrayType(T.MapType(T.StringType(), T.StringType()))
    array = F.when(F.ltrim(text).startswith("["), F.from_json(text, records))
    inside = F.from_json(text, T.StructType([T.StructField(section, records)]))[section]
    own = F.when(inside.isNull() & array.isNull(), F.json_object_keys(text))
    nested = F.transform(F.coalesce(array, inside), lambda r: F.map_keys(r))
    names = F.coalesce(F.array_distinct(F.flatten(nested)), own)
    found = docs.select(F.explode(names).alias("name")).distinct().collect()
    return sorted(r["name"] for r in found)


def read_records(
    spark: SparkSession,
    path: str,
    section: str = "footprint_data",
    years: tuple[int, int] | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """JSON Lines of single records, by Spark's own JSON reader: the fastest way in.

    Same columns as ``flatten_documents``. Where files lie in ``year=`` folders, the folder is the
    year of its rows, and folders of other ``years`` are not read.
    """
    fields = [*record_fields(section), *extra]
    schema = _texts([*fields, CORRUPT])
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    if years is not None:
        rows = rows.filter(in_years(F.col("year"), years))
    return rows.select(
        *fields,
        F.col("_metadata.file_path").alias(SOURCE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(SEQ),
        F.lit(1).cast("bigint").alias(ROW),
        CORRUPT,
    )


def read_envelope(
    spark: SparkSession,
    path: str,
    section: str = "footprint_data",
    layout: str = "lines",
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Records of a section from every document below ``path``.

    ``layout`` is 'lines', 'files', or 'split' for files of one huge document each.
    """
    if layout == "split":
        from snapmart.sources.split import read_split

        return read_split(spark, path, section, fields)
    return flatten_documents(read_documents(spark, path, layout), section, fields)


def read_years(
    spark: SparkSession, path: str, start: int, end: int, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of the requested years; only their ``year=`` folders are read.

    A year without rows has no folder and simply adds none.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).filter(F.col("year").between(start, end))


def filter_types(df: DataFrame, types: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows of the given record types; a list reaches the scan, a DataFrame is semi-joined."""
    if types is None:
        return df
    if isinstance(types, DataFrame):
        return df.join(types.select("record_type"), "record_type", "left_semi")
    return df.filter(F.col("record_type").isin(list(types)))


def read_latest_snapshot(
    spark: SparkSession, path: str, which: str = "latest", schema: T.StructType | None = None
) -> DataFrame:
    """The newest ``snapshot=`` folder by name, one named folder, or all of them.

    The folders are listed and only the one asked for is read.
    """
    from snapmart.tables.versions import list_folders

    reader = spark.read.schema(schema) if schema is not None else spark.read
    reader = reader.option("basePath", path)
    if which == "all":
        return reader.parquet(path)
    name = which
    if which == "latest":
        found = list_folders(spark, f"{path}/snapshot=*")
        if not found:
            return reader.parquet(path)
        name = found[-1].rsplit("snapshot=", 1)[1]
    return reader.parquet(f"{path}/snapshot={name}")


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header; columns are cast to ``schema``, ``renames`` maps header to column.

    Header names are matched without regard to order; text that does not cast turns null.
    """
    headers = {new: old for old, new in (renames or {}).items()}
    rows = spark.read.option("header", True).csv(path)
    return rows.select(
        *[
            F.col(headers.get(f.name, f.name)).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_typed(spark, path, schemas.CALENDAR)


def read_perf_daily(spark: SparkSession, path: str) -> DataFrame:
    """Daily returns; the feed misspells one header."""
    return read_csv_typed(spark, path, schemas.PERF_DAILY, {"retunr_type": "return_type"})


def calendar_flags(days: DataFrame, holiday: Column, working: Column) -> DataFrame:
    """Calendar rows for a frame with a ``date`` column; Monday is day 1."""
    iso_day = F.weekday("date") + 1
    return days.select(
        "date",
        iso_day.cast("int").alias("day_of_week"),
        F.date_format("date", "EEEE").alias("text_day_of_week"),
        F.date_format("date", "MMMM").alias("text_month_of_year"),
        holiday.alias("is_holiday"),
        working.alias("is_working_day"),
    )
