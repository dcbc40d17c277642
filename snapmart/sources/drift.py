"""Types that landed fields really have, against those declared, and the rows that do not fit.

Records land in a VARIANT column. Their fields are exploded and counted by type before the shuffle, so
field names stay in the cluster however many there are. A field that changes its type shows as several
types; rows whose value the declared type does not hold are put aside with the reason.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.operators.clean import quarantine_split


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def landed_types(records: DataFrame, column: str = "raw_data") -> DataFrame:
    """field, kind, rows: how many records have the field with a value of that type.

    Only the fields of the outermost object; records that are no objects have none. Missing fields are not
    counted, JSON nulls are VOID. Numbers of one kind with other digits are one type (DECIMAL).
    """
    spark: SparkSession = records.sparkSession
    fields = records.select(F.col(column).alias("v")).lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    kind = F.regexp_replace(F.schema_of_variant("value"), r"\(.*\)$|<.*>$", "")
    return fields.where("key IS NOT NULL").groupBy(F.col("key").alias("field"), kind.alias("kind")).agg(
        F.count("*").alias("rows")
    )


def merged_schema(records: DataFrame, column: str = "raw_data") -> DataFrame:
    """One row: the schema all records have in common; a field of several types is a VARIANT in it."""
    return records.agg(F.schema_of_variant_agg(column).alias("schema"))


def type_rules(declared: Mapping[str, str], column: str = "raw_data") -> dict:
    """A rule per declared field, true where a record has a value that the type does not hold."""
    return {
        f"{name}: not {kind}": F.expr(
            f"try_variant_get({column}, {_text('$.' + name)}, 'variant') IS NOT NULL"
            f" AND NOT is_variant_null(try_variant_get({column}, {_text('$.' + name)}, 'variant'))"
            f" AND try_variant_get({column}, {_text('$.' + name)}, {_text(kind)}) IS NULL"
        )
        for name, kind in declared.items()
    }


def split_misfits(
    records: DataFrame, declared: Mapping[str, str], column: str = "raw_data"
) -> tuple[DataFrame, DataFrame]:
    """(records that fit, records that do not, with every reason). Text that reads as a number fits a
    number, as a cast would take it; missing and null fields fit."""
    return quarantine_split(records, type_rules(declared, column))


def drift_report(
    records: DataFrame, declared: Mapping[str, str], column: str = "raw_data"
) -> DataFrame:
    """field, kind, rows, declared, drifted: a type is drifted if the field has several types beside VOID,
    and unknown if ``declared`` is null."""
    found = landed_types(records, column)
    pairs = [F.struct(F.lit(n).alias("field"), F.lit(k).alias("declared")) for n, k in declared.items()]
    known = records.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    kinds = found.where("kind <> 'VOID'").groupBy("field").agg((F.count("*") > 1).alias("drifted"))
    out = found.join(known, "field", "left").join(kinds, "field", "left")
    return out.select("field", "kind", "rows", "declared", F.coalesce("drifted", F.lit(False)).alias("drifted"))
