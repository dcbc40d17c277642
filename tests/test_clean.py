from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.functions import boundary_diff, is_missing, safe_long
from snapmart.operators import clean
from tests.conftest import rows

AT = datetime(2024, 1, 31, 6)
RECORD = "countryCode string, countryName string, year string, record string, value string"


def facts(spark, data):
    return spark.createDataFrame(data, "country_code long, year long, record_type string")


def test_missing_is_null_zero_or_empty(spark):
    df = spark.createDataFrame(
        [(None, None, None), (0, "", False), (1, " ", True)], "n long, s string, b boolean"
    )
    found = df.select(*[is_missing(df, c).alias(c) for c in df.columns])
    assert [tuple(r) for r in found.collect()] == [(True,) * 3, (True,) * 3, (False,) * 3]


def test_nan_is_not_missing(spark):
    df = spark.createDataFrame([(float("nan"),)], "x double")
    assert df.select(is_missing(df, "x")).first()[0] is False


@pytest.mark.parametrize(
    "text, number", [("12", 12), (" 12 ", 12), ("12.7", None), ("all", None), ("", None), ("0", 0)]
)
def test_safe_long(spark, text, number):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(safe_long(F.col("c"))).first()[0] == number


def test_boundary_diff_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 59), datetime(2024, 1, 1, 0, 1, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    a, b = F.col("a"), F.col("b")
    found = df.select(boundary_diff("minute", a, b), boundary_diff("second", a, b),
                      boundary_diff("hour", a, b), boundary_diff("minute", b, a))
    assert tuple(found.first()) == (1, 2, 0, -1)


def test_rows_without_key_fields_go(spark):
    df = facts(spark, [(1, 2024, "EF"), (None, 2024, "EF"), (2, None, "EF")])
    assert rows(clean.require_fields(df)) == [(1, 2024, "EF")]


def test_missing_type_dropped(spark):
    df = facts(spark, [(1, 2024, "EF"), (2, 2024, None), (3, 2024, ""), (0, 2024, "EF")])
    assert rows(clean.require_fields(df), "country_code") == [(1,)]


def test_codes_one_and_three_remain(spark):
    df = facts(spark, [(1, 2024, "EF"), (None, 2024, "EF"), (2, None, "EF"), (3, 2023, "EF")])
    assert rows(clean.require_fields(df), "country_code") == [(1,), (3,)]


def test_missing_type_becomes_unknown(spark):
    df = facts(spark, [(1, 2024, None), (2, 2024, "EF")])
    assert rows(clean.default_record_type(df), "record_type") == [("EF",), ("unknown",)]


@pytest.mark.parametrize(
    "carbon, value, share",
    [(100.0, 400.0, 25.0), (0.0, 4.0, 0.0), (1.0, 0.0, None), (1.0, -4.0, None),
     (None, 4.0, None), (1.0, None, None), (1.0, 3.0, 33.33)],
)
def test_carbon_pct(spark, carbon, value, share):
    df = spark.createDataFrame([(carbon, value)], "carbon double, value double")
    assert clean.carbon_pct(df).first().carbon_pct_of_total == share


def test_normalise_records(spark):
    df = spark.createDataFrame(
        [("1", "A", "2024", "EF", "1.5"), ("all", "B", "2024", "EF", "1"),
         ("2", "C", None, "EF", "1"), (None, "D", "2024", "EF", "1"),
         (" 12 ", "E", "2024", "EF", "n/a"), ("12.7", "F", "2024", "EF", "1")], RECORD,
    )
    found = clean.normalise_records(df, AT)
    assert rows(found, "country_code", "year", "value") == [(1, 2024, 1.5), (12, 2024, None)]
    assert found.first().extracted_at == AT
    loose = clean.normalise_records(df, AT, parse_code=False)
    assert loose.count() == 4


def test_descriptions_join(spark):
    df = spark.createDataFrame([("1", "A", "2024", "EF", "1"), ("1", "A", "2024", "X", "1")], RECORD)
    types = spark.createDataFrame([("EF", "Footprint")], "record_type string, description string")
    found = clean.normalise_records(df, AT, types)
    assert rows(found, "record_type_description") == [("Footprint",), ("X",)]


def test_normalise_countries(spark):
    df = spark.createDataFrame(
        [("1", "A"), ("all", "World"), ("2", None), ("3", ""), (None, "B")],
        "countryCode string, countryName string",
    )
    assert rows(clean.normalise_countries(df, AT), "country_code") == [(1,)]
    assert clean.normalise_countries(df, AT, numeric_only=False).count() == 4


def test_aliases(spark):
    df = spark.createDataFrame(
        [("a", None, 1), (None, "b", 2)], "record_type string, record string, x int"
    )
    found = clean.coalesce_aliases(
        df, {"record_type": ["record_type", "record"], "carbon": ["carbon", "c"]}
    )
    assert rows(found, "x", "record_type", "carbon") == [(1, "a", None), (2, "b", None)]


def test_split_keeps_every_row_with_reasons(spark):
    df = facts(spark, [(1, 2024, "EF"), (0, 2024, "EF"), (0, 1800, "EF")])
    rules = {"code": F.col("country_code") == 0, "year": F.col("year") < 1960}
    good, bad = clean.quarantine_split(df, rules)
    assert good.count() + bad.count() == df.count()
    assert rows(bad.select("_reasons")) == [(["code", "year"],), (["code"],)]


def test_rule_that_is_null_does_not_hold(spark):
    df = facts(spark, [(None, 2024, "EF")])
    good, bad = clean.quarantine_split(df, {"code": F.col("country_code") == 0})
    assert (good.count(), bad.count()) == (1, 0)


def test_contract(spark):
    df = spark.createDataFrame(
        [("1", "A"), ("x", "B"), (None, "C"), ("4", None)],
        "country_code string, country_name string",
    )
    good, bad = clean.contract_enforce(df, schemas.COUNTRIES)
    assert rows(good, "country_code") == [(1,)]
    assert good.schema["country_code"].dataType == schemas.LONG
    assert {r.name for r in schemas.COUNTRIES} <= set(good.columns)
    assert bad.count() == 3
    with pytest.raises(ValueError, match="3 rows"):
        clean.contract_enforce(df, schemas.COUNTRIES, mode="fail")


def test_schema_evolve_and_changes(spark):
    old = spark.createDataFrame([(1, "a")], "id long, s string")
    new = spark.createDataFrame([("2", 1.5), ("x", 2.5)], "id string, extra double")
    found = clean.schema_evolve(old, new)
    assert rows(found, "id", "s", "extra") == [(1, "a", None), (2, None, 1.5), (None, None, 2.5)]
    assert clean.schema_changes(old.schema, new.schema) == [
        ("extra", "added"), ("s", "missing"), ("id", "bigint -> string"),
    ]


def test_length_rules(spark):
    df = spark.createDataFrame([("GBR",), ("GB",), (None,)], "iso_alpha2 string")
    _, bad = clean.quarantine_split(df, clean.column_lengths({"iso_alpha2": 2}))
    assert rows(bad, "iso_alpha2") == [("GBR",)]
