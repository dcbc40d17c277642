"""Run registered queries next to their SQL in DuckDB and compare rows.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (value + 0.0)
    return value


def _sortable(row):
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=_sortable)


SPARK_OF = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def compare(df, con, text: str) -> str | None:
    """None if both give the same columns, types and rows, otherwise what differs."""
    result = con.execute(text)
    names = [d[0] for d in result.description]
    kinds = {d[0]: SPARK_OF.get(str(d[1]), str(d[1])) for d in result.description}
    expected = _rows(result.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    found = _rows([tuple(r) for r in df.collect()], df.columns)
    if len(found) != len(expected):
        return f"{len(found)} rows vs {len(expected)}"
    bad = [(a, b) for a, b in zip(found, expected) if a != b]
    if bad:
        return f"{len(bad)} of {len(found)} rows differ ({sorted(names)}), first {bad[0][0]} vs {bad[0][1]}"
    types = {n: (k, kinds[n]) for n, k in df.dtypes if k != kinds[n]}
    if types:
        return f"types {types}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry

    from snapmart.session import build_session

    sf = argv[0]
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__checkpoint__dir=os.environ.get("SNAPMART_SCRATCH", ""),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, texts = duck(sf), entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        started = time.monotonic()
        try:
            df = queries[name](spark, sf)
            if name in texts:
                problem = compare(df, con, texts[name])
            else:
                problem = None
                print(name, df.collect()[:3])
        except Exception as error:  # reported per query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        took = time.monotonic() - started
        print(f"{'ok  ' if problem is None else 'FAIL'} {took:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
