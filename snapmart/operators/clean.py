"""Normalising, required fields, derived columns, contracts and quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schemas
from snapmart.functions import as_double, coalesce_names, is_missing, safe_long, to_stamp, whole_number

REASONS = "_reasons"


def _stamp(value) -> Column:
    col = value if isinstance(value, Column) else F.lit(value)
    return col.cast("timestamp_ntz")


def _landed(df: DataFrame, fields: Mapping[str, str]) -> list[Column]:
    """Rename landed fields to columns; a field absent from the input becomes null text."""
    cols, present = [], set(df.columns)
    for name, field in fields.items():
        col = F.col(field) if field in present else F.lit(None).cast("string")
        if name in schemas.MEASURES:
            col = as_double(col)
        elif name == "year":
            col = whole_number(col)
        elif name != "country_code":
            col = col.cast("string")
        cols.append(col.alias(name))
    return cols


def _falsy(df: DataFrame, field: str) -> Column:
    return is_missing(df, field) if field in df.columns else F.lit(True)


def normalise_records(
    df: DataFrame,
    extracted_at,
    descriptions: DataFrame | None = None,
    parse_code: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Landed records to typed fact columns; rows without year or usable code are left out.

    With ``parse_code=False`` any code that is not missing is kept, and cast where it can be.
    """
    code = F.when(~_falsy(df, "countryCode"), safe_long(F.col("countryCode")))
    ok = ~_falsy(df, "year") & (code.isNotNull() if parse_code else ~_falsy(df, "countryCode"))
    out = df.filter(ok).select(
        *_landed(df, schemas.RECORD_FIELDS), _stamp(extracted_at).alias("extracted_at"), *keep
    )
    out = out.withColumn("country_code", safe_long(F.col("country_code")))
    if descriptions is None:
        return out
    from snapmart.operators.lookups import describe_types

    return describe_types(out, descriptions)


def normalise_countries(
    df: DataFrame, extracted_at, numeric_only: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Landed countries to dimension rows.

    ``numeric_only`` wants a name and a numeric code, so 'all' goes; without it any code that
    is not null is kept as text.
    """
    cols = _landed(df, schemas.COUNTRY_FIELDS)
    if not numeric_only:
        return df.filter(F.col("countryCode").isNotNull()).select(
            *cols, _stamp(extracted_at).alias("extracted_at"), *keep
        ).withColumn("country_code", F.col("country_code").cast("string"))
    ok = (
        ~_falsy(df, "countryCode")
        & ~_falsy(df, "countryName")
        & safe_long(F.col("countryCode")).isNotNull()
    )
    return (
        df.filter(ok)
        .select(*cols, _stamp(extracted_at).alias("extracted_at"), *keep)
        .withColumn("country_code", safe_long(F.col("country_code")))
    )


def coalesce_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """One column per entry from whichever of its names the input has; other columns stay."""
    used = {n for names in aliases.values() for n in names} | set(aliases)
    rest = [c for c in df.columns if c not in used]
    return df.select(*rest, *[coalesce_names(df, n).alias(c) for c, n in aliases.items()])


def require_fields(df: DataFrame, columns: Sequence[str] = tuple(schemas.FACT_KEY)) -> DataFrame:
    for name in columns:
        df = df.filter(~is_missing(df, name))
    return df


def require_country_fields(df: DataFrame) -> DataFrame:
    return require_fields(df, ["country_code", "country_name"])


def default_record_type(df: DataFrame, default: str = "unknown") -> DataFrame:
    """Null types become ``default``; a typed read cannot tell an absent field from a null."""
    return df.withColumn("record_type", F.coalesce("record_type", F.lit(default)))


def stamp_transformed(df: DataFrame, at) -> DataFrame:
    return df.withColumn("transformed_at", _stamp(at))


def carbon_pct(df: DataFrame) -> DataFrame:
    """Carbon share of value in percent, where value is positive and carbon known."""
    share = F.round(F.col("carbon") / F.col("value") * 100, 2)
    ok = F.col("carbon").isNotNull() & (F.col("value") > 0)
    return df.withColumn("carbon_pct_of_total", F.when(ok, share))


def scale_round(col: Column, unit: float = 1e6, places: int = 2) -> Column:
    return F.round(col / F.lit(unit), places)


def schema_changes(old: T.StructType, new: T.StructType) -> list[tuple[str, str]]:
    """(column, change) pairs; change is added, missing or the pair of types."""
    before = {f.name: f.dataType.simpleString() for f in old}
    after = {f.name: f.dataType.simpleString() for f in new}
    changes = [(n, "added") for n in after if n not in before]
    changes += [(n, "missing") for n in before if n not in after]
    changes += [
        (n, f"{before[n]} -> {after[n]}") for n in before if n in after and before[n] != after[n]
    ]
    return changes


def schema_evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name with new columns added; columns both sides have keep the old type.

    A value that does not fit the old type turns null here, so run ``contract_enforce`` on
    ``new`` first where such rows must be kept aside.
    """
    kinds = {f.name: f.dataType for f in old.schema}
    fitted = new.select(
        *[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in new.columns]
    )
    return old.unionByName(fitted, allowMissingColumns=True)


def quarantine_split(
    df: DataFrame, rules: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) by named rules that are true for bad rows; bad rows list every reason.

    Both sides are filters over one projection. To write them in one pass use ``flag_reasons``
    with ``tables.write_zones``.
    """
    flagged = flag_reasons(df, rules)
    good = flagged.filter(F.size(REASONS) == 0).drop(REASONS)
    return good, flagged.filter(F.size(REASONS) > 0)


def flag_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    hits = F.array(*[F.when(rule, F.lit(reason)) for reason, rule in rules.items()])
    return df.withColumn(REASONS, F.filter(hits, lambda r: r.isNotNull()))


def contract_rules(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """One rule per declared type and per declared not-null column."""
    rules = {}
    for field in schema:
        if field.name not in df.columns:
            if not field.nullable:
                rules[f"{field.name}: column missing"] = F.lit(True)
            continue
        col = F.col(field.name)
        if df.schema[field.name].dataType != field.dataType:
            label = f"{field.name}: not {field.dataType.simpleString()}"
            rules[label] = col.isNotNull() & col.try_cast(field.dataType).isNull()
        if not field.nullable:
            rules[f"{field.name}: null"] = col.isNull()
    return rules


def contract_enforce(
    df: DataFrame, schema: T.StructType, mode: str = "split"
) -> tuple[DataFrame, DataFrame]:
    """(rows typed as declared, rows breaking the contract with reasons).

    ``mode='fail'`` counts the breaches in one aggregate and raises if there are any.
    """
    good, bad = quarantine_split(df, contract_rules(df, schema))
    kinds = {f.name: f.dataType for f in schema}
    missing = [F.lit(None).cast(k).alias(n) for n, k in kinds.items() if n not in df.columns]
    typed = good.select(
        *[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns],
        *missing,
    )
    if mode == "fail":
        breaches = bad.count()
        if breaches:
            raise ValueError(f"{breaches} rows break the declared schema")
    return typed, bad


def column_lengths(limits: Mapping[str, int]) -> dict[str, Column]:
    """Rules for text longer than a declared length."""
    return {f"{n}: longer than {k}": F.length(n) > k for n, k in limits.items()}


def normalise_stamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_stamp(F.col(c)) for c in columns})
