"""Huge documents: one file is read by many tasks and comes out as its records.

The text reader cuts a file behind every closing brace, in byte ranges like any text. What a piece
means depends on all before it, but only through three things: whether it starts inside a string,
how deep, and in which section. Each is a running sum within a range, plus what the ranges before it
add up to, and there are few ranges. So no task holds more of a file than its range.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.sources.landed import BLOCK, CORRUPT, ROW, SEQ, SOURCE, flatten_documents, record_fields
from snapmart.tables.layout import materialise


def _range() -> WindowSpec:
    return Window.partitionBy(SOURCE, BLOCK).orderBy(SEQ)


def _file() -> WindowSpec:
    return Window.partitionBy(SOURCE).orderBy(BLOCK)


def _over_file(value: Column) -> Column:
    return value.over(_file().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def _before(number: Column, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(number).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _of_range(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Pieces with the columns of their range."""
    ranges = ranges.withColumnsRenamed({SOURCE: "_in_file", BLOCK: "_in_block"})
    same = (F.col(SOURCE) == F.col("_in_file")) & (F.col(BLOCK) == F.col("_in_block"))
    return df.join(ranges, same).drop("_in_file", "_in_block")


def _pieces(spark: SparkSession, path: str, section: str, recursive: bool) -> DataFrame:
    """Pieces with their brackets outside strings (``_marks``; ``@`` for the section's key) and
    their depth against the start of their range (``_rise``)."""
    text = spark.read.text(path, lineSep="}", recursiveFileLookup=recursive)
    # A cut never falls inside an escape, since no escape ends with a brace.
    plain = F.regexp_replace("value", r"(?s)\\.", "??")
    cut = text.select(
        F.col("value").alias("_text"),
        F.col("_metadata.file_path").alias(SOURCE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias(SEQ),
        (F.regexp_count(plain, F.lit('"')) % 2).alias("_odd"),
    )
    ranges = cut.groupBy(SOURCE, BLOCK).agg(
        F.sum("_odd").alias("_quotes"),
        F.sum(F.octet_length("_text") + 1).alias("_bytes"),
        F.max("_size").alias("_size"),
        F.max(SEQ).alias("_last"),
    )
    # The last piece of a file has no brace behind it if pieces and braces add up to a byte more
    # than the file; the reader leaves out a byte order mark of three bytes.
    total = _over_file(F.sum("_bytes"))
    final = F.col(BLOCK) == _over_file(F.max(BLOCK))
    ended = total.isin(F.col("_size"), F.col("_size") - 3)
    ranges = ranges.select(
        SOURCE, BLOCK, (_before(F.col("_quotes"), _file()) % 2).alias("_open"),
        F.when(final & ~ended, F.col("_last")).alias("_tail_at"),
    )
    quotes = F.col("_open") + _before(F.col("_odd"), _range())
    seen = _of_range(cut, ranges).select(
        "_text", SOURCE, BLOCK, SEQ,
        (quotes % 2 == 1).alias("_starts_in"),
        ((quotes + F.col("_odd")) % 2 == 1).alias("_ends_in"),
        F.coalesce(F.col(SEQ) == F.col("_tail_at"), F.lit(False)).alias("_tail"),
    )
    bare = F.regexp_replace("_text", r"(?s)\\.", "??")
    bare = F.when(F.col("_starts_in"), F.concat(F.lit('"}'), bare)).otherwise(bare)
    bare = F.regexp_replace(bare, rf'"{re.escape(section)}"\s*+:\s*+\[', "@[")
    bare = F.regexp_replace(bare, r'"[^"]*+(?:"|\z)', "")
    bare = F.regexp_replace(bare, r"[^{\[\]@]++", "")
    closed = F.col("_ends_in") | F.col("_tail")
    marked = seen.withColumn("_marks", F.when(closed, bare).otherwise(F.concat(bare, F.lit("}"))))
    rise = F.regexp_count("_marks", F.lit(r"[{\[]")) - F.regexp_count("_marks", F.lit(r"[}\]]"))
    return marked.withColumn("_delta", rise).select(
        "_text", SOURCE, BLOCK, SEQ, "_tail", "_marks", "_delta",
        _before(F.col("_delta"), _range()).alias("_rise"),
    )


def _section_after(marks: Column, depth: Column) -> Column:
    """Whether a piece ends inside the section; null if it never comes up to the top level."""
    here = F.struct(
        depth.cast("long").alias("depth"),
        F.lit(False).alias("named"),
        F.when(depth <= 1, F.lit(False)).alias("inside"),
    )

    def step(at: Column, mark: Column) -> Column:
        opens, closes = mark.isin("{", "["), mark.isin("}", "]")
        now = at["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        inside = F.when(opens & at["named"], True).when(closes & (now <= 1), False)
        return F.struct(
            now.alias("depth"),
            ((mark == "@") & (at["depth"] == 1)).alias("named"),
            F.coalesce(inside, at["inside"]).alias("inside"),
        )

    return F.aggregate(F.split(marks, ""), here, step)["inside"]


def _ranges(pieces: DataFrame) -> DataFrame:
    """Depth at the start of each range, the kind of its document and where its section lies."""
    first = F.min_by(F.substring("_marks", 1, 1), F.when(F.col("_marks") != "", F.col(SEQ)))
    ranges = pieces.groupBy(SOURCE, BLOCK).agg(F.sum("_delta").alias("_up"), first.alias("_kind"))
    ranges = ranges.select(
        SOURCE, BLOCK, _before(F.col("_up"), _file()).alias("_start"),
        _over_file(F.first("_kind", ignorenulls=True)).alias("_kind"),
    )
    depth = F.col("_start") + F.col("_rise")
    lowest = depth - F.regexp_count("_marks", F.lit(r"[}\]]"))
    turns = _of_range(pieces, ranges).filter((F.col("_kind") == "{") & (F.least(depth, lowest) <= 1))
    place = F.struct(BLOCK, SEQ)
    turns = turns.select(SOURCE, place.alias("_at"), _section_after(F.col("_marks"), depth).alias("_inside"))
    turns = turns.filter("_inside IS NOT NULL").withColumn(
        "_to", F.lead("_at").over(Window.partitionBy(SOURCE).orderBy("_at"))
    )
    spans = turns.filter("_inside").groupBy(SOURCE).agg(F.collect_list(F.struct("_at", "_to")).alias("_spans"))
    return ranges.join(spans, SOURCE, "left")


def read_split(
    spark: SparkSession,
    path: str,
    section: str = "footprint_data",
    fields: Sequence[str] | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Records of a section from documents of any size, a document per file.

    Same columns as ``flatten_documents``; the row number is the record's place in its section or
    array. A record that does not parse, one cut off at the end included, is a row of nulls with
    its own text in the corrupt column, and the records around it are kept. Elements that are no
    objects are left out. A file without the section that is no array either is read whole, as a
    single record may be. Compressed files cannot be cut and are one range. The pieces are
    checkpointed once, and shuffled by range twice.
    """
    names = list(fields) if fields is not None else record_fields(section)
    pieces = materialise(_pieces(spark, path, section, recursive))
    placed = _of_range(pieces, materialise(_ranges(pieces)))
    return _records(placed, section, names).unionByName(_others(placed, section, names))


def _records(placed: DataFrame, section: str, names: list[str]) -> DataFrame:
    array, place = F.col("_kind") == "[", F.struct(BLOCK, SEQ)
    depth = F.col("_start") + F.col("_rise")
    level = F.when(array, 1).otherwise(2)
    inside = array | F.exists(
        "_spans", lambda s: (place >= s["_at"]) & (s["_to"].isNull() | (place < s["_to"]))
    )
    enters = ~array & (depth < level)  # the section begins in this piece
    key = rf'(?s)^.*?(?<!\\)"{re.escape(section)}"\s*+:\s*+\['
    rest = F.when(enters, F.regexp_replace("_text", key, "")).otherwise(F.col("_text"))
    marks = F.when(enters, F.regexp_replace("_marks", r"^[^@]*+@", "")).otherwise(F.col("_marks"))
    opens = (depth <= level) & F.contains(marks, F.lit("{"))
    ends = (depth + F.col("_delta") == level) & F.endswith("_marks", F.lit("}"))
    part = F.when(opens, F.substr(rest, F.instr(rest, "{"))).otherwise(F.col("_text"))
    part = F.when(F.col("_tail"), part).otherwise(F.concat(part, F.lit("}")))
    parts = placed.filter(inside & (opens | (depth > level))).select(
        SOURCE, BLOCK, SEQ, opens.alias("_opens"), (opens & ends).alias("_whole"), part.alias("_part")
    )

    # Records are numbered by their openings: those in the range, and in the ranges before.
    opened = F.col("_opens").cast("long")
    earlier = parts.groupBy(SOURCE, BLOCK).agg(F.sum(opened).alias("_n"))
    earlier = earlier.select(SOURCE, BLOCK, _before(F.col("_n"), _file()).alias("_earlier"))
    so_far = F.sum(opened).over(_range().rowsBetween(Window.unboundedPreceding, 0))
    numbered = _of_range(parts, earlier).withColumn(ROW, F.col("_earlier") + so_far)

    whole = numbered.filter("_whole").select(SOURCE, ROW, F.col("_part").alias("_text"))
    cut = numbered.filter("NOT _whole").groupBy(SOURCE, ROW).agg(
        F.array_sort(F.collect_list(F.struct(BLOCK, SEQ, "_part"))).alias("_parts")
    )
    joined = F.array_join(F.transform("_parts", lambda p: p["_part"]), "")
    texts = whole.unionByName(cut.select(SOURCE, ROW, joined.alias("_text")))

    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    read = texts.select(SOURCE, ROW, F.from_json("_text", schema, options).alias("_r"))
    fine = F.col("_r")[CORRUPT].isNull()
    return read.select(
        *[F.when(fine, F.col("_r")[n]).alias(n) for n in names],
        SOURCE,
        F.lit(0).cast("bigint").alias(BLOCK),
        F.lit(0).cast("bigint").alias(SEQ),
        ROW,
        F.col("_r")[CORRUPT].alias(CORRUPT),
    )


def _others(placed: DataFrame, section: str, names: list[str]) -> DataFrame:
    """Rows of files that are no array and lack the section."""
    lacking = F.coalesce(F.col("_kind") != "[", F.lit(True)) & F.col("_spans").isNull()
    brace = F.when(F.col("_tail"), F.lit("")).otherwise(F.lit("}"))
    text = F.concat("_text", brace).alias("_part")
    whole = placed.filter(lacking).groupBy(SOURCE).agg(
        F.array_sort(F.collect_list(F.struct(BLOCK, SEQ, text))).alias("_parts")
    )
    docs = whole.select(
        SOURCE,
        F.lit(0).cast("bigint").alias(BLOCK),
        F.lit(0).cast("bigint").alias(SEQ),
        F.array_join(F.transform("_parts", lambda p: p["_part"]), "").alias("document"),
    )
    return flatten_documents(docs.filter(F.trim("document") != ""), section, names)
