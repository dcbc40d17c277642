"""Near-duplicates by 64-bit SimHash fingerprints that differ in at most three bits.

Candidates come from deletion variants: a fingerprint is cut into two segments of 32 bits; of two
fingerprints at distance three or less one segment differs in one bit at most. So every segment is
indexed 32 times, each time with another bit as a wildcard, and fingerprints that meet under an
equal variant are verified. Only different fingerprints are indexed; copies hang on theirs.

A task gets at most ``crowd`` fingerprints of one variant and emits a spanning forest of the links
it finds, not the pairs. A variant with more is cut again: the other segment into halves of 16
bits, each with one wildcard, then those into halves of 8. Then no more than 11 bits are free, so
2,048 fingerprints at most share a variant, and the way is exact at every size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import documents, first_rows, row_key, stored, utf8
from snapmart.llm.components import components

WORDS = 3
DISTANCE = 3
SEED = 42
CROWD = 2048


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of the shingles of ``words`` words; 0 without words."""
    found = text.lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1
    starts = np.cumsum(lengths) - lengths
    n = max(1, len(found) - words + 1)
    ends = (starts + lengths - 1)[min(words, len(found)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends, strict=True)),
        dtype="<u8", count=n,
    )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, words) for t in utf8(batch.column("text"))]
            yield pa.record_batch(
                [batch.column("k1"), batch.column("k2"), batch.column("id"),
                 pa.array(np.array(prints, dtype=np.uint64).view(np.int64))],
                names=["k1", "k2", "id", "print"],
            )

    return run


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """k1, k2 (row key), id and print of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    k1, k2 = row_key(F.col("id"), F.col("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.select(k1.alias("k1"), k2.alias("k2"), "id", "text").mapInArrow(
        _fingerprints(words), f"k1 long, k2 long, id {id_type}, print long"
    )


def _variants(rows: DataFrame, width: int) -> DataFrame:
    """Rows (keys, rest, print) with one more key: a half of the lowest ``2 * width`` bits of
    ``rest`` with one wildcard. What is left of ``rest`` is the other half."""
    mask = F.lit((1 << width) - 1)
    halves = F.array(
        F.struct(F.lit(0).alias("half"), F.col("rest").bitwiseAND(mask).alias("own"),
                 F.shiftrightunsigned("rest", width).bitwiseAND(mask).alias("rest")),
        F.struct(F.lit(1).alias("half"),
                 F.shiftrightunsigned("rest", width).bitwiseAND(mask).alias("own"),
                 F.col("rest").bitwiseAND(mask).alias("rest")),
    )
    split = rows.select("key", "print", F.explode(halves).alias("h")).select(
        "key", "print", "h.half", "h.own", F.col("h.rest").alias("rest")
    )
    wild = split.withColumn("wild", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    kept = F.expr("own & ~shiftleft(1L, wild)")
    place = F.col("half") * F.lit(width) + F.col("wild")
    key = F.shiftleft(place.cast("long"), 32).bitwiseOR(kept)
    # The first key is a number of 38 bits; deeper ones are hashed together with the one above.
    # The links of a key are verified, so a clash of hashes costs time only.
    whole = F.when(F.col("key").isNull(), key).otherwise(F.xxhash64("key", key))
    return wild.select(whole.alias("key"), "rest", "print")


def _forest(prints: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join all fingerprints of one variant that hang together."""
    open_, out = prints, []
    while len(open_) > 1:
        front, open_ = [open_[0]], open_[1:]
        while front and len(open_):
            one = front.pop()
            near = np.bitwise_count(open_ ^ one) <= distance
            if near.any():
                got, open_ = open_[near], open_[~near]
                out.append((np.full(len(got), one), got))
                front.extend(got)
    return out


def _links(distance: int):
    """Links among the fingerprints of each variant; the input is sorted by variant."""

    def solve(key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([begin, [len(key)]]))
        two = begin[size == 2]
        x, y = prints[two], prints[two + 1]
        near = np.bitwise_count(x ^ y) <= distance
        pairs = [(x[near], y[near])]
        for b, n in zip(begin[size > 2], size[size > 2], strict=True):
            pairs += _forest(prints[b : b + n], distance)
        a = np.concatenate([p[0] for p in pairs]).view(np.int64)
        b = np.concatenate([p[1] for p in pairs]).view(np.int64)
        return pa.record_batch([np.maximum(a, b), np.minimum(a, b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, prints = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        for batch in batches:
            key = np.concatenate([key, np.asarray(batch.column("key"))])
            prints = np.concatenate([prints, np.asarray(batch.column("print")).view(np.uint64)])
            if not len(key):
                continue
            # The last variant may go on in the next batch.
            cut = int(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[-1])
            if cut:
                yield solve(key[:cut], prints[:cut])
            key, prints = key[cut:], prints[cut:]
        if len(key):
            yield solve(key, prints)

    return run


def links(prints: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that join every two fingerprints (column ``print``, each once) of at most
    ``distance`` differing bits, directly or through others of the same variant."""
    # Each fingerprint becomes 64 rows in its task, so they are dealt out evenly before.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = prints.repartition(tasks, "print").select(
        F.lit(None).cast("long").alias("key"), F.col("print").alias("rest"), "print"
    )
    if distance > 3:
        raise ValueError("two segments with one wildcard each cover three bits at most")
    out = None
    for width in (32, 16, 8):
        rows = _variants(rows, width)
        last = width == 8
        sizes = rows.groupBy("key").count().where("count > 1")
        many = F.lit(False) if last else F.col("count") > crowd
        sizes = stored(sizes.select("key", many.alias("crowded")), "variants")
        # A merge join at every size: broadcasting a small index would only hide how it grows.
        rows = rows.join(sizes.hint("merge"), "key")
        if not last:
            rows = stored(rows, "variant-rows")
        found = (
            rows.where("not crowded").select("key", "print")
            .repartition("key").sortWithinPartitions("key")
            .mapInArrow(_links(distance), "a long, b long")
        )
        out = found if out is None else out.union(found)
        if last or sizes.where("crowded").isEmpty():
            return out
        rows = rows.where("crowded").select("key", "rest", "print")
    return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = WORDS, distance: int = DISTANCE, crowd: int = CROWD,
) -> DataFrame:
    """Fingerprint and component of every row.

    Returns k1, k2 (row key), id, print (long), fingerprint (16 hex digits), component_id, the
    smallest id of the rows that are reachable over links of at most ``distance`` bits, and root,
    a fingerprint that names the component even if it has no id. A text
    without words, null included, has fingerprint zero, linked like any other; a row that is there
    twice is in its own component twice; null ids are no smallest id unless there is no other;
    other columns are not looked at; an empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    kinds = stored(rows.groupBy("print").agg(F.min("id").alias("id")), "fingerprint-kinds")
    roots = components(links(kinds, distance, crowd))
    groups = kinds.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "id", F.coalesce("root", "print").alias("root")
    )
    least = groups.groupBy("root").agg(F.min("id").alias("component_id"))
    named = groups.join(least, "root").select("print", "root", "component_id")
    return rows.join(stored(named, "components"), "print").select(
        "k1", "k2", "id", "print", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id", "root",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns, with one row for each component: that of the smallest id
    (nulls last), of equal ids the one with the smaller key."""
    found = stored(near_duplicates(docs, id_col, text_col, **how), "near-duplicates")
    return first_rows(docs, found, id_col, text_col)


def op4_simhash_deletion_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "fingerprint", "component_id"
    )
