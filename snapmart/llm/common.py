"""Small helpers of the operators: row keys, stored tables, rows in blocks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.session import scratch_path

#: ASCII white space, as the word rule has it: a word is a run of anything else.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, label: str, few: bool = False) -> DataFrame:
    """``df`` written to a new table in the shared folder and read again: lineage ends here.

    ``few`` is for small tables made from small ones: an eighth as many tasks write them, and as
    many files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    if few:
        df = df.coalesce(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*columns: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that name a row by its values; equal rows share them, nulls have one."""
    mark = F.concat_ws("", *[F.when(c.isNull(), "n").otherwise("v") for c in columns])
    return F.xxhash64(mark, *columns), F.xxhash64(F.lit("second"), mark, *columns)


def first_rows(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs``, all columns, with one row for each root of ``found`` (k1, k2, id, root):
    that of the smallest id (nulls last), of equal ids the one with the smaller key."""
    place = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    best = found.groupBy("root").agg(F.min(place).alias("best")).select("best.k1", "best.k2")
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    k1, k2 = row_key(F.col(f"row.{id_col}"), F.col(f"row.{text_col}").cast("string"))
    kept = row.select("row", k1.alias("k1"), k2.alias("k2")).join(best, ["k1", "k2"])
    return kept.dropDuplicates(["k1", "k2"]).select("row.*")


def slabs(texts: list[bytes], most: int = 300_000):
    """(from, to) of runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    start = held = 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > most:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def utf8(column: pa.Array) -> list[bytes]:
    """Bytes of each text; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
