"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows are dealt by hash into parts. How many rows of each part go to each shard is drawn exactly: part
after part takes its numbers from what room the shards have left, which is a multivariate
hypergeometric draw. Each part is permuted and cut by its numbers; each shard is permuted again
after the exchange. Every arrangement of the rows is then equally likely (as far as the hash is a
random order), and shard sizes are exact.

Only keys are permuted; the rows themselves move once, to their shard and slot. Parts and the
pieces of a shard hold ``part_rows`` rows on average, so their number grows with the table. The
driver draws one row of ``shards`` numbers per part and sees no other data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.llm.common import documents, row_key, stored

SHARDS = 16
PART_ROWS = 20_000
SEED = 11


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes at most one apart."""
    return np.full(shards, rows // shards) + (np.arange(shards) < rows % shards)


def communication_matrix(parts: list[int], shards: int, seed: int) -> np.ndarray:
    """How many rows of each part go to each shard."""
    rng = np.random.default_rng(seed)
    room = shard_sizes(sum(parts), shards)
    out = np.zeros((len(parts), shards), dtype=np.int64)
    for i, rows in enumerate(parts):
        out[i] = _draw(rng, room, rows)
        room = room - out[i]
    return out


def _draw(rng: np.random.Generator, room: np.ndarray, rows: int) -> np.ndarray:
    """Multivariate hypergeometric draw of ``rows`` places out of the shards' room."""
    total = int(room.sum())
    if total < 10**9:  # numpy's own draw goes no further
        return rng.multivariate_hypergeometric(room, rows, method="marginals")
    places = rng.choice(total, rows, replace=False, shuffle=False)
    shard = np.searchsorted(np.cumsum(room), places, side="right")
    return np.bincount(shard, minlength=len(room))


def assignment(keys: DataFrame, shards: int, seed: int, part_rows: int) -> DataFrame:
    """k1, k2, shard and slot for each row of ``keys`` (k1, k2, repeats allowed)."""
    total = keys.count()
    pieces = max(1, -(-total // part_rows))
    part = F.pmod(F.xxhash64("k1", "k2", F.lit(seed)), F.lit(pieces)).alias("part")
    dealt = stored(keys.select("k1", "k2", part), "shard-parts")
    sizes = {r["part"]: r["count"] for r in dealt.groupBy("part").count().collect()}
    matrix = communication_matrix([sizes.get(i, 0) for i in range(pieces)], shards, seed)
    bounds = keys.sparkSession.createDataFrame(
        [(i, row) for i, row in enumerate(np.cumsum(matrix, axis=1).tolist())],
        "part long, bounds array<long>",
    )
    local = Window.partitionBy("part").orderBy(F.xxhash64("k1", "k2", F.lit(seed + 1)), "k1", "k2")
    placed = dealt.withColumn("place", F.row_number().over(local).cast("long") - 1).join(bounds, "part")
    shard = F.size(F.filter("bounds", lambda b: b <= F.col("place")))
    order = F.xxhash64("part", "place", F.lit(seed + 2))
    placed = placed.select("k1", "k2", "part", "place", shard.alias("shard"), order.alias("order"))
    # The second permutation: a shard's pieces are ranges of its order, numbered by running sums.
    each = max(1, -(-pieces // shards))
    piece = F.shiftright(F.shiftrightunsigned("order", 33) * each, 31)
    placed = stored(placed.withColumn("piece", piece), "shard-places")
    counts = placed.groupBy("shard", "piece").count()
    ahead = Window.partitionBy("shard").orderBy("piece")
    starts = counts.select(
        F.col("shard").alias("s"), F.col("piece").alias("p"),
        (F.sum("count").over(ahead) - F.col("count")).alias("start"),
    )
    # The order is compared as an unsigned number, as the pieces are.
    within = Window.partitionBy("shard", "piece").orderBy(
        F.shiftrightunsigned("order", 1), "order", "part", "place"
    )
    ranked = placed.withColumn("rank", F.row_number().over(within).cast("long") - 1)
    joined = ranked.join(stored(starts, "shard-starts", few=True), (F.col("shard") == F.col("s")) & (F.col("piece") == F.col("p")))
    return joined.select("k1", "k2", "shard", (F.col("start") + F.col("rank")).alias("slot"))


def shuffle_to_shards(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, part_rows: int = PART_ROWS
) -> DataFrame:
    """``row`` (struct of all columns), shard (0 to shards - 1) and slot (from 0, without gaps).

    Shards hold equally many rows, at most one apart. Equal rows, nulls, empty and long texts are
    rows like any other; fewer rows than shards leave the last shards empty; an empty table gives
    an empty result. The same rows with the same seed always get the same places, whatever the
    files or tasks they come from. Columns of map type are not supported.
    """
    columns = [docs[c] for c in docs.columns]
    k1, k2 = row_key(*columns)
    rows = docs.select(F.struct(*columns).alias("row"), k1.alias("k1"), k2.alias("k2"))
    places = stored(assignment(rows.select("k1", "k2"), shards, seed, part_rows), "shard-slots")
    # Equal rows have equal keys: the row moves once and meets all places drawn for its key.
    return rows.dropDuplicates(["k1", "k2"]).join(places, ["k1", "k2"]).select("row", "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write shuffled rows as Parquet, a folder for each shard, files in the order of slots."""
    spread = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    spread.select("row.*", "shard", "slot").write.partitionBy("shard").parquet(path)


def op5_hypergeometric_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return shuffle_to_shards(documents(spark, sf_dir)).select(
        "row.doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
