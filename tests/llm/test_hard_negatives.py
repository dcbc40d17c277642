"""Hard negatives against sorting all rows for every anchor."""

import math
import random

import numpy as np
import pytest

from snapmart.llm import hard_negatives as H

COLUMNS = "vec_id long, embedding array<float>, label int, shard string, id string, place string, score string"


def vectors(seed: int, n: int, dim: int = 8, labels: int = 3) -> list[tuple]:
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(labels, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        rows.append((i, (middle[label] + rng.normal(size=dim)).astype(np.float32).tolist(), label, "a", "b", "c", "d"))
    return rows


def whole(v) -> list[int] | None:
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * float(np.float32(x))) for x in v]


def product(a, b) -> int:
    return sum(x * y for x, y in zip(a, b))


def plain(rows, every: int = 10, positives: int = 5, negatives: int = 10) -> list[tuple]:
    known = [(r[0], r[2], whole(r[1])) for r in rows if r[2] is not None and whole(r[1]) is not None]
    anchors: dict = {}
    for i, label, v in known:
        if i is not None and i % every == 0 and (i not in anchors or (label, v) < anchors[i]):
            anchors[i] = (label, v)
    out = []
    for a, (label, v) in anchors.items():
        scored = sorted(((-product(v, w), i is None, i or 0, i, lab) for i, lab, w in known if i != a))
        for p in [s for s in scored if s[4] == label][:positives]:
            fit = [s for s in scored if s[4] != label and -30 * p[0] <= -100 * s[0] <= -90 * p[0]]
            out += [(a, p[3], k, s[3], -p[0], -s[0]) for k, s in enumerate(fit[:negatives], 1)]
    return out


def mined(spark, rows, every: int = 10, **how) -> list[tuple]:
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    return [tuple(r) for r in H.hard_negatives(df, df.where(f"vec_id % {every} = 0"), **how).collect()]


def same(found, want) -> bool:
    return sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("clusters, shard_rows, step", [(64, 1024, 512), (1, 40, 7), (3, 15, 1)])
def test_agrees_with_sorting_everything(spark, monkeypatch, clusters, shard_rows, step):
    """Whatever the clusters, shards and steps."""
    monkeypatch.setattr(H, "MIN_SHARD_ROWS", shard_rows)
    monkeypatch.setattr(H, "STEP", step)
    rows = vectors(1, 400)
    want = plain(rows)
    assert len(want) > 500
    assert same(mined(spark, rows, clusters=clusters), want)


def test_awkward_rows(spark):
    """Nulls, non-finite components, ties, repeated rows, short and empty vectors, one frequent row."""
    rows, rest = vectors(2, 120), ("a", "b", "c", "d")
    rows += [(200, None, 1, *rest), (210, [float("nan")] * 8, 1, *rest), (220, [float("inf")] * 8, 1, *rest),
             (230, [1.0, None], 1, *rest), (240, [1.0] * 8, None, *rest), (None, [1.0] * 8, 1, *rest),
             (None, [0.5] * 8, 2, *rest), (250, [], 1, *rest), (260, [1.0, -1.0], 2, *rest), (270, [0.0] * 8, 0, *rest),
             (30, rows[31][1], 2, *rest)]
    rows += [rows[7]] * 3 + [rows[20]] * 2
    rows += [(1000 + i, rows[5][1], 1, *rest) for i in range(80)]
    assert same(mined(spark, rows), plain(rows))


def test_large_components_are_exact(spark):
    rows = [(i, [float(x) * 300_000 for x in v], lab, *r) for i, v, lab, *r in vectors(3, 60)]
    want = plain(rows)
    assert max(r[4] for r in want) > 2**53
    assert same(mined(spark, rows), want)


def test_empty_tables(spark):
    rows = vectors(4, 30)
    df = spark.createDataFrame(rows, COLUMNS)
    nothing = df.where("vec_id < 0")
    assert H.hard_negatives(nothing, nothing).count() == 0
    assert H.hard_negatives(df, nothing).count() == 0
    assert H.hard_negatives(nothing, df).count() == 0


def test_a_walk_ends_early_and_misses_nothing():
    """Anchors of a narrow cluster stop long before the end of the list."""
    rng, dim = np.random.default_rng(5), 6
    far = np.floor(rng.normal(size=(5000, dim)) * 256)
    near = np.floor((np.eye(dim)[0] * 5 + rng.normal(size=(60, dim)) * 0.05) * 256)
    members = np.floor((np.eye(dim)[0] * 5 + rng.normal(size=(20, dim)) * 0.05) * 256)
    shard = H.Candidates(np.arange(5060), np.zeros(5060, np.int64), np.concatenate([far, near]))
    wanted = [[H.Best(5)] for _ in members]
    steps = H.walk(shard, np.full(20, -1), members, np.arange(5060), wanted)
    assert steps <= 20 * 2 * H.STEP < 20 * 5060 / 4
    for m, (best,) in zip(members, wanted, strict=True):
        scores = (np.concatenate([far, near]) @ m).astype(int)
        first = np.lexsort((np.arange(5060), -scores))[:5]
        assert best.ids.tolist() == first.tolist() and best.scores.tolist() == scores[first].tolist()


def test_windows_are_exact():
    rng = random.Random(6)
    for _ in range(2000):
        p, n = rng.randint(-300, 300), rng.randint(-300, 300)
        low, high = H._window(p, 30, 90, 100)
        assert (low <= n <= high) == (30 * p <= 100 * n <= 90 * p)
