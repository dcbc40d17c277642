"""Every registered query against its SQL, and the rules the registry keeps."""

import re
from pathlib import Path

import pytest

from snapmart.catalog import QUERIES, SQL
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    problem = compare(df, con, SQL[name]) if name in SQL else None
    assert problem is None, f"{name}: {problem}"


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_sql_keeps_whole_tables():
    """No row caps but the top ten, no sampling."""
    for name, text in SQL.items():
        found = re.findall(r"\bLIMIT\b|\bSAMPLE\b|TABLESAMPLE", text, re.I)
        assert not found or name == "top_emitters", name


@needs_data
def test_entry_gives_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
