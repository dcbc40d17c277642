"""Exact top-k by integer inner product with MaxScore, shard by shard.

A dimension is a term and its values over the vectors of a shard are its postings, with the least and
the largest contribution a query can get from them. For a query, terms are ordered by how much they can
change a score. Non-essential are the last ones that cannot lift a vector to the threshold if
all others give it their least; the threshold is the k-th best score known. The postings of the essential
terms are traversed for all vectors of a block, then the others are probed for the vectors that their
bounds still leave competitive. The threshold rises from block to block, and the split moves with it.

Vectors are dealt to shards by a written number. Each query is searched in one shard, its home, first;
its k-th best score there is the threshold it takes to all others, and shards are merged at the end.
Queries go to shards in rows; the query set is the stated one and is never broadcast. A shard's vectors come first in its task, then its
queries in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.llm.common import stored

SCALE = 1024
TOP = 10
CHUNK = 8  # terms probed between two looks at the bounds
BLOCK = 4096  # vectors between two moves of the threshold
#: Components in a shard: 64 MB of 64-bit numbers at most, held three times while it is built. Fewer
#: shards than ``SHARDS`` are made only of fewer than ``MIN_SHARD_CELLS`` each.
MIN_SHARD_CELLS, MAX_SHARD_CELLS, SHARDS = 131_072, 8_388_608, 64
NO_ID = np.iinfo(np.int64).max


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, null for vectors that take no part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(F.coalesce(whole, F.lit(False)), values)


class Shard:
    """Postings of one shard: values by dimension, and the least and greatest of each.

    ``traversed`` and ``probed`` count the postings looked at.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.postings = np.ascontiguousarray(vectors[order].T)
        self.low = self.postings.min(axis=1, initial=np.iinfo(np.int64).max)
        self.high = self.postings.max(axis=1, initial=np.iinfo(np.int64).min)
        self.traversed = self.probed = 0

    def top(
        self, own: int, query: np.ndarray, k: int, threshold: int | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors other than ``own``, of those that reach the threshold."""
        terms = min(len(query), len(self.postings))
        ends = np.stack([query[:terms] * self.low[:terms], query[:terms] * self.high[:terms]])
        least, most = ends.min(axis=0), ends.max(axis=0)
        order = np.argsort(least - most, kind="stable")
        weights, least, most = query[:terms][order], least[order], most[order]
        left = np.concatenate([np.cumsum(most[::-1])[::-1], [0]])
        # The best score of a vector that gets the least from the first terms; never rising.
        without = np.concatenate([[0], np.cumsum(least)]) + left
        best_ids, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for start in range(0, len(self.ids), BLOCK):
            stop = min(start + BLOCK, len(self.ids))
            at = terms
            if threshold is not None:
                at = min(terms, int(np.searchsorted(-without, -threshold, side="right")))
                if at == 0:
                    break  # not even the most of every term is enough
            score = weights[:at] @ self.postings[order[:at], start:stop]
            self.traversed += at * (stop - start)
            good = self.ids[start:stop] != own
            if threshold is not None:
                good &= score + left[at] >= threshold
            live, score = start + np.flatnonzero(good), score[good]
            while at < terms and len(live):
                some = slice(at, at + CHUNK)
                score = score + weights[some] @ self.postings[np.ix_(order[some], live)]
                self.probed += len(order[some]) * len(live)
                at = min(at + CHUNK, terms)
                good = score + left[at] >= threshold
                live, score = live[good], score[good]
            best_ids, best = np.append(best_ids, self.ids[live]), np.append(best, score)
            first = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[first], best[first]
            if len(best) == k and (threshold is None or best[-1] > threshold):
                threshold = int(best[-1])
        return best_ids, best


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(column), max(width, int(lengths.max(initial=0)))), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, vectors, shard = None, [], [], None
        for batch in batches:
            number = np.asarray(batch.column("shard"))
            is_query = batch.column("is_query").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(number * 2 + is_query)) + 1
            for low, high in zip([0, *edges], [*edges, len(number)], strict=True):
                if low == high:
                    continue
                if number[low] != current:
                    current, ids, vectors, shard = number[low], [], [], None
                part = batch.slice(low, high - low)
                own = part.column("id").fill_null(NO_ID).to_numpy()
                matrix = _matrix(part.column("vector"), 0)
                if not is_query[low]:
                    ids.append(own)
                    vectors.append(matrix)
                    continue
                if shard is None:
                    if not ids:
                        continue  # a shard without vectors
                    width = max(v.shape[1] for v in vectors)
                    vectors = [np.pad(v, ((0, 0), (0, width - v.shape[1]))) for v in vectors]
                    shard = Shard(np.concatenate(ids), np.concatenate(vectors))
                known = part.column("threshold").to_pylist()
                found = [
                    shard.top(o, q, k, t) for o, q, t in zip(own, matrix, known, strict=True)
                ]
                times = [len(f[0]) for f in found]
                id_ = np.concatenate([f[0] for f in found])
                yield pa.record_batch(
                    [pa.array(np.repeat(own, times)),
                     pa.array(np.repeat(part.column("form").to_numpy(), times)),
                     pa.array(id_, mask=id_ == NO_ID),
                     pa.array(np.concatenate([f[1] for f in found]))],
                    names=["query_id", "form", "vec_id", "score"],
                )

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = TOP, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best vectors for each query.

    Scores are inner products of components rounded down after scaling; ties go to the smaller id,
    null ids last. Rows with the id of a query are its own and no candidates for it. Vectors that
    are null or hold a null or non-finite component take no part on either side; shorter vectors
    count as padded with zeros, empty ones score 0; a candidate that is there twice is found twice.
    Query rows equal in id and vector are one query; vectors that share an id are queries of their
    own, each with its ranks. Other columns are not looked at; empty tables give an empty result.
    Scores must fit 64 bits.
    """

    def shape(df: DataFrame) -> DataFrame:
        df = df.select(df[id_col].cast("long").alias("id"), quantised(df[vector_col], scale).alias("vector"))
        return df.where("vector IS NOT NULL")

    rows = stored(shape(vectors).withColumn("n", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    cells = size["n"] * max(size["width"] or 1, 1)
    each = min(max(-(-cells // SHARDS), MIN_SHARD_CELLS), MAX_SHARD_CELLS)
    shards = max(1, -(-cells // each))
    nothing = F.lit(None).cast("long")
    dealt = rows.select(
        F.pmod(F.xxhash64("n"), F.lit(shards)).cast("int").alias("shard"),
        F.lit(False).alias("is_query"), "id", "vector",
        F.lit(0).cast("long").alias("form"), nothing.alias("threshold"),
    )
    asked = shape(queries).where("id IS NOT NULL").dropDuplicates(["id", "vector"])
    form = F.xxhash64("vector")
    home = F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int")
    asked = stored(asked.select("id", "vector", form.alias("form"), home.alias("home")), "queries")

    def searched(known: DataFrame, numbers: Column) -> DataFrame:
        """The k best of each query in each shard of ``numbers``."""
        everywhere = known.select(
            F.explode(numbers).alias("shard"), F.lit(True).alias("is_query"), "id", "vector",
            "form", "threshold",
        )
        together = dealt.union(everywhere).repartition("shard").sortWithinPartitions("shard", "is_query")
        return together.mapInArrow(_search(k), "query_id long, form long, vec_id long, score long")

    found = searched(asked.withColumn("threshold", nothing), F.array("home"))
    if shards > 1:
        found = stored(found, "home-shards", few=True)
        full = found.groupBy(F.col("query_id").alias("id"), "form").agg(
            F.when(F.count("*") >= k, F.min("score")).alias("threshold")
        )
        known = asked.join(full, ["id", "form"], "left")
        others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda n: n != F.col("home"))
        found = found.union(searched(known, others))
    order = Window.partitionBy("query_id", "form").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last()
    )
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8_maxscore_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(rows, rows.where("vec_id % 100 = 0"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM s) AS r
WHERE rank <= 10"""
