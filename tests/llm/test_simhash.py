"""SimHash near-duplicates against comparing all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from snapmart.llm.components import components
from snapmart.llm.simhash_dedup import fingerprint, keep_one, links, near_duplicates
from tests.llm.helpers import awkward, awkward_rows, empty, words


def plain_print(text) -> int:
    found = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints) -> list[int]:
    """Index of the first member of each print's component."""
    roots = list(range(len(prints)))
    values = np.array(prints, dtype=np.uint64)
    for _ in prints:
        before = list(roots)
        for i, p in enumerate(values):
            near = np.flatnonzero(np.bitwise_count(values ^ p) <= 3)
            least = min(roots[j] for j in near)
            for j in near:
                roots[j] = min(roots[j], least)
        if roots == before:
            return roots
    return roots


@pytest.mark.parametrize("text", ["", None, "One", "a B", "A b\tc\x0bD é É x", "w " * 5000])
def test_fingerprints(text):
    assert fingerprint((text or "").encode()) == plain_print(text)


def clusters(seed: int) -> list[int]:
    rng, out = random.Random(seed), {0, 1, 3, 2**64 - 1}
    for _ in range(5):
        base = rng.getrandbits(64)
        for _ in range(60):
            x = base
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("crowd", [2048, 12, 3])
def test_components_of_dense_clusters(spark, crowd):
    """A small ``crowd`` sends most variants through the deeper cuts."""
    prints = clusters(1)
    signed = [p - (p >> 63 << 64) for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "print long")
    got = {r.node: r.root for r in components(links(frame, 3, crowd)).collect()}
    by = {}
    for s, root in zip(signed, plain_roots(prints), strict=True):
        by.setdefault(root, set()).add(got.get(s, s))
    assert all(len(names) == 1 for names in by.values())
    assert len({min(n) for n in by.values()}) == len(by)


def test_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    frame = spark.createDataFrame([*chain, *star, (7, 7), (1, 0)], "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(frame.limit(0)).count() == 0


def test_awkward_rows(spark):
    rows = awkward_rows()
    found = near_duplicates(awkward(spark)).collect()
    prints = [plain_print(r[1]) for r in rows]
    roots = plain_roots(prints)
    least = {}
    for r, root in zip(rows, roots, strict=True):
        least[root] = min([x for x in (least.get(root), r[0]) if x is not None], default=None)
    want = sorted(((r[0], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, roots, strict=True)), key=repr)
    assert sorted(((r.id, r.fingerprint, r.component_id) for r in found), key=repr) == want
    kept = keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert kept.count() == len(set(roots))
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(
        v for v in least.values() if v is not None
    )


def test_components_without_ids_stay_apart(spark):
    texts = ["alpha beta gamma delta", "one two three four five", "alpha beta gamma delta"]
    frame = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert keep_one(frame).count() == 2
    assert keep_one(frame.withColumn("doc_id", F.lit("x"))).count() == 2


def test_empty_tables(spark):
    assert near_duplicates(empty(spark)).count() == 0
    assert keep_one(empty(spark)).count() == 0


def test_more_than_three_bits_are_refused(spark):
    with pytest.raises(ValueError, match="three bits"):
        links(spark.range(1).select(F.col("id").alias("print")), 4)
