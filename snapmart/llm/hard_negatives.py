"""Hard negatives by exact inner products, over lists that clustered anchors share.

Anchors of one label are clustered by angle. In every shard of the candidates a group of anchors of
one cluster sorts the candidates once, by a bound that holds for all its members: a candidate's norm
times the cosine of its angle to the centre less the widest angle of a member. Each member walks that
list, longest bound first, and stops when the bound times its own norm is below all that it still
needs, so what it found is certified.

There are two walks. The first finds the best rows of an anchor's own label, its positives; the second
walks the rows of other labels and keeps the best in the window of scores that each positive allows.
Answers of the shards are merged by rank.

Candidates are dealt to shards by a number written with them, equal rows too, and a shard is sized by
its cells. Anchors, the stated query set, go to every shard in rows and stay in groups of a fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.llm.common import stored
from snapmart.llm.topk_search import quantised

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, WHOLE = 30, 90, 100  # a negative's score lies between these shares of the positive's
ANCHOR_EVERY, FLIP_EVERY, LABELS = 100, 7, 10
CLUSTERS = 64
FIT_ANCHORS, FIT_CELLS = 4_096, 1_000_000  # the centres are fitted on so many anchors at most
SHARD_CELLS = 4_000_000  # 32 MB of a shard's components
MIN_SHARD_ROWS, SHARDS = 1_024, 64
MEMBERS, STEP = 256, 512  # anchors that share a list, and candidates between two looks at the bound
NO_ID = np.iinfo(np.int64).max
EXACT = 2.0**53


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as rows, shorter ones padded with zeros."""
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(column), max(width, int(lengths.max(initial=0)))), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def widened(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, max(0, width - vectors.shape[1]))))


# Clusters of anchors. -------------------------------------------------------------------------


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


def centres(vectors: np.ndarray, clusters: int = CLUSTERS, rounds: int = 10) -> np.ndarray:
    """Unit centres of spherical k-means, seeded with rows spread over the input."""
    rows = _unit(vectors)
    if not len(rows):
        return np.zeros((1, 1))
    at = rows[np.linspace(0, len(rows) - 1, min(clusters, len(rows))).astype(int)]
    for _ in range(rounds):
        nearest = (rows @ at.T).argmax(axis=1)
        sums = np.zeros_like(at)
        np.add.at(sums, nearest, rows)
        at = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), at)
    return at


def fitted_centres(anchors: DataFrame, clusters: int) -> np.ndarray:
    """Centres fitted on a bounded sample of the anchors, those with the smallest hashes.

    Which centres there are changes the order of the walks only, never what they find.
    """
    longest = anchors.agg(F.max(F.size("vector"))).first()[0] or 1
    most = max(1, min(FIT_ANCHORS, FIT_CELLS // longest))
    some = anchors.orderBy(F.xxhash64(F.lit("fit"), "id"), "id").limit(most).select("vector")
    return centres(matrix(pa.array([r["vector"] for r in some.collect()], pa.list_(pa.int64()))), clusters)


def _assign(at: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = matrix(batch.column("vector"), at.shape[1])
        nearest = (rows @ widened(at, rows.shape[1]).T).argmax(axis=1)
        yield pa.record_batch(
            [batch.column("id"), batch.column("label"), pa.array(nearest.astype(np.int32)), batch.column("vector")],
            names=["id", "label", "cluster", "vector"],
        )


# Walks. ---------------------------------------------------------------------------------------


class Candidates:
    """The rows of one shard: ids, labels, vectors and norms."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors.astype(np.float64)
        self.norms = np.linalg.norm(self.vectors, axis=1)
        self.largest = float(np.abs(self.vectors).max(initial=0))

    def walk_order(self, members: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidates ``some`` and their bounds for a member of norm 1, longest bound first."""
        units = _unit(members)
        centre = _unit(units.sum(axis=0, keepdims=True))[0]
        widest = np.arccos(np.clip(units @ centre, -1, 1)).max(initial=0)
        norms = self.norms[some]
        cosine = np.divide(self.vectors[some] @ centre, norms, out=np.ones(len(some)), where=norms > 0)
        angle = np.arccos(np.clip(cosine, -1, 1))
        # The slack covers rounding of norms and angles.
        bound = norms * np.cos(np.maximum(0, angle - widest)) + 1e-6 * norms
        order = np.argsort(-bound, kind="stable")
        return some[order], bound[order]

    def scores(self, members: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Integer inner products; in floating point where that is exact."""
        if self.largest * float(np.abs(members).max(initial=0)) * members.shape[1] < EXACT:
            return (members @ self.vectors[some].T).astype(np.int64)
        return members.astype(np.int64) @ self.vectors[some].astype(np.int64).T


class Best:
    """The first ``k`` rows by score, then id, among those with a score from ``low`` to ``high``."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def needs(self) -> float:
        """A row with a smaller score changes nothing."""
        if len(self.scores) == self.k:
            return float(self.scores[-1])
        return -np.inf if self.low is None else float(self.low)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.needs
        if self.high is not None:
            good &= scores <= self.high
        if good.any():
            ids = np.concatenate([self.ids, ids[good]])
            scores = np.concatenate([self.scores, scores[good]])
            first = np.lexsort((ids, -scores))[: self.k]
            self.ids, self.scores = ids[first], scores[first]


def walk(
    shard: Candidates, ids: np.ndarray, members: np.ndarray, some: np.ndarray, wanted: list[list[Best]]
) -> int:
    """Fill ``wanted``, a list for each member, from the candidates ``some``; returns the steps.

    A member leaves when the bound of what is left is below all it needs.
    """
    width = max(members.shape[1], shard.vectors.shape[1])
    if shard.vectors.shape[1] < width:
        shard.vectors = widened(shard.vectors, width)
    members = widened(members, width).astype(np.float64)
    norms = np.linalg.norm(members, axis=1)
    order, bound = shard.walk_order(members, some)
    live, steps = np.arange(len(members)), 0
    for at in range(0, len(order), STEP):
        needs = np.array([min((b.needs for b in wanted[m]), default=np.inf) for m in live])
        live = live[bound[at] * norms[live] >= needs]
        if not len(live):
            break
        part = order[at : at + STEP]
        steps += len(live) * len(part)
        scores = shard.scores(members[live], part)
        for m, row in zip(live.tolist(), scores, strict=True):
            other = shard.ids[part] != ids[m]
            for best in wanted[m]:
                best.add(shard.ids[part][other], row[other])
    return steps


def _window(positive: int, low: int, high: int, whole: int) -> tuple[int, int]:
    """Least and greatest score with low * positive <= whole * score <= high * positive."""
    return -(-low * positive // whole), high * positive // whole


def _positives(k: int, shard: Candidates, label: int, rows: pa.Table) -> Iterator[list]:
    ids = rows["id"].to_numpy()
    wanted = [[Best(k)] for _ in ids]
    same = np.flatnonzero(shard.labels == label)
    walk(shard, ids, matrix(rows["vector"].combine_chunks()), same, wanted)
    for own, (best,) in zip(ids.tolist(), wanted, strict=True):
        for id_, score in zip(best.ids.tolist(), best.scores.tolist(), strict=True):
            yield [own, None, id_, score, None, None]


def _negatives(
    k: int, window: Callable[[int], tuple[int, int]], shard: Candidates, label: int, rows: pa.Table
) -> Iterator[list]:
    ids, positives = rows["id"].to_numpy(), rows["positives"].to_pylist()
    # Positives of one score have one window.
    kinds = [sorted({p["score"] for p in own}) for own in positives]
    wanted = [[Best(k, *window(s)) for s in own] for own in kinds]
    others = np.flatnonzero(shard.labels != label)
    walk(shard, ids, matrix(rows["vector"].combine_chunks()), others, wanted)
    for own, known, scores, bests in zip(ids.tolist(), positives, kinds, wanted, strict=True):
        for number, p in enumerate(known):
            best = bests[scores.index(p["score"])]
            for id_, score in zip(best.ids.tolist(), best.scores.tolist(), strict=True):
                yield [own, number, p["id"], p["score"], id_, score]


def _search(solve: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shard by shard: candidates first, then anchors by label and cluster, in groups."""
    current, parts, shard = None, [], None
    group: list[pa.RecordBatch] = []
    names = ["anchor_id", "number", "positive_id", "positive_score", "negative_id", "negative_score"]

    def solved() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(group)
        found = list(solve(shard, rows["label"][0].as_py(), rows))
        group.clear()
        if found:
            columns = [[None if x == NO_ID else x for x in c] for c in zip(*found, strict=True)]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    def loaded() -> Candidates:
        vectors = [matrix(p.column("vector")) for p in parts]
        width = max(v.shape[1] for v in vectors)
        ids = np.concatenate([p.column("id").fill_null(NO_ID).to_numpy() for p in parts])
        labels = np.concatenate([p.column("label").to_numpy() for p in parts])
        return Candidates(ids, labels, np.concatenate([widened(v, width) for v in vectors]))

    for batch in batches:
        place = np.stack([np.asarray(batch.column(c).cast(pa.int64())) for c in ("shard", "is_anchor", "label", "cluster")])
        place[2:, place[1] == 0] = 0  # candidates of a shard stay together
        edges = np.flatnonzero((np.diff(place, axis=1) != 0).any(axis=0)) + 1
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
            if low == high:
                continue
            key = tuple(place[:, low].tolist())
            if group and key != current:
                yield from solved()
            if current is None or key[0] != current[0]:
                parts, shard = [], None
            current = key
            rows = batch.slice(low, high - low)
            if not key[1]:
                parts.append(rows)
                continue
            if shard is None:
                if not parts:
                    continue  # a shard without candidates
                shard, parts = loaded(), []
            while rows.num_rows:
                room = MEMBERS - sum(g.num_rows for g in group)
                group.append(rows.slice(0, room))
                rows = rows.slice(room)
                if sum(g.num_rows for g in group) == MEMBERS:
                    yield from solved()
    if group:
        yield from solved()


def _walked(rows: DataFrame, anchors: DataFrame, shards: int, solve: Callable) -> DataFrame:
    """Every shard of ``rows`` with all ``anchors`` (id, label, cluster, vector, positives)."""
    dealt = rows.select(
        F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("is_anchor"),
        "id", "label", F.lit(0).alias("cluster"), "vector",
    )
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("is_anchor"),
        "id", "label", "cluster", "vector", "positives",
    )
    together = dealt.unionByName(asked, allowMissingColumns=True).repartition("shard")
    return together.sortWithinPartitions("shard", "is_anchor", "label", "cluster").mapInArrow(
        partial(_search, solve),
        "anchor_id long, number long, positive_id long, positive_score long, negative_id long, negative_score long",
    )


def _first(df: DataFrame, by: list[str], score: str, id_: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(id_).asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, whole: int = WHOLE, scale: int = SCALE, clusters: int = CLUSTERS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product with the anchor, of components rounded down after scaling; higher
    scores come first, ties by smaller id, null ids last. An anchor's positives are its first rows of
    the same label, its negatives for each of them the first rows of other labels with
    low * positive_score <= whole * negative_score <= high * positive_score.

    Rows with a null label or vector, or a null or non-finite component, take no part on either side.
    Labels are whole numbers. Rows with the id of an anchor are its own and no candidates for it;
    anchors with a null id take no part; of several anchors of one id the least by label and vector
    stays. A candidate that is there twice is found twice; a positive that is there twice has its
    negatives twice. Shorter vectors count as padded with zeros. Anchors without a positive, or with
    no row in a window, have no rows; other columns are not looked at; empty tables give an empty
    result. Scores must fit 64 bits.
    """

    def shape(df: DataFrame) -> DataFrame:
        df = df.select(
            df[id_col].cast("long").alias("id"), df[label_col].cast("long").alias("label"),
            quantised(df[vector_col], scale).alias("vector"),
        )
        return df.where("vector IS NOT NULL AND label IS NOT NULL")

    # The number is written with the row: a task that runs again deals the same way.
    rows = stored(shape(vectors).withColumn("place", F.monotonically_increasing_id()), "candidates")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.size("vector").cast("long")).alias("cells")).first()
    by_rows = min(SHARDS, -(-size["n"] // MIN_SHARD_ROWS))
    shards = max(1, by_rows, -(-(size["cells"] or 0) // SHARD_CELLS))
    asked = shape(anchors).where("id IS NOT NULL").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("a"))
    asked = stored(asked.select("id", "a.label", "a.vector"), "anchors")
    clustered = stored(
        asked.mapInArrow(
            partial(_assign, fitted_centres(asked, clusters)), "id long, label long, cluster int, vector array<long>"
        ),
        "clustered-anchors",
    )

    known = F.array().cast("array<struct<id:bigint,score:bigint>>")
    near = _walked(rows, clustered.withColumn("positives", known), shards, partial(_positives, positives))
    near = _first(near, ["anchor_id"], "positive_score", "positive_id", positives)
    found = near.groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("positives")
    )  # at most ``positives`` of them
    ready = stored(clustered.join(found, "id"), "anchors-with-positives")

    window = partial(_window, low=low, high=high, whole=whole)
    far = _walked(rows, ready, shards, partial(_negatives, negatives, window))
    # Positives that are equal rows are told apart by their number among them.
    far = _first(far, ["anchor_id", "number"], "negative_score", "negative_id", negatives)
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    flipped = F.when(rows["vec_id"] % FLIP_EVERY == 0, (rows["label"] + 1) % LABELS).otherwise(rows["label"])
    rows = rows.withColumn("label", flipped)
    return hard_negatives(rows, rows.where(F.col("vec_id") % ANCHOR_EVERY == 0))


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v AS a JOIN v AS c ON a.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (
      PARTITION BY anchor_id ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s WHERE same) AS x
  WHERE rank <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (
    PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score) AS r
WHERE rank <= 10"""
