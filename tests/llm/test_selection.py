"""Quality rules, source mixing and sharding."""

import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.llm import mixing, quality, sharding
from tests.llm.helpers import COLUMNS, awkward, awkward_rows, empty, prose, words


def plain_features(text) -> dict:
    text, found = text or "", words(text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    return {
        "n_words": len(found), "word_chars": sum(map(len, found)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def plain_kept(text) -> bool:
    f, found = plain_features(text), words(text or "")
    n = f["n_words"]
    lettered = sum(any(unicodedata.category(c)[0] == "L" for c in w) for w in found)
    return not (
        n < 20 or f["n_repeat_words"] * 100 > n * 30 or f["n_symbols"] > n * 0.5
        or f["n_dup_lines"] > f["n_lines"] * 0.5 or f["word_chars"] < n * 1.5
        or f["word_chars"] > n * 25 or lettered * 100 < n * 30 or len(set(found)) ** 2 * 4 < n
    )


QUALITY_TEXTS = [
    prose(1, 100), prose(1, 12), "\n".join(["same line of words here"] * 9 + [prose(2, 60)]),
    " | ".join(prose(3, 50).split()), "a b " * 30, prose(4, 30) + " " + " ".join(prose(5, 8).split() * 2),
    "x" * 900 + " " + prose(6, 19), "é ü ß " + prose(7, 40) + "\r\n\x0b\x0c\n\n",
    " ".join(str(1000 + i) for i in range(40)), " ".join(f"{i} жук" for i in range(100, 130)),
    " ".join("abcde"[(i * i + i // 7) % 5] * (2 + i * 7 % 3) for i in range(3000)),
]


def test_features_and_verdicts(spark, monkeypatch):
    rows = awkward_rows() + [(100 + i, t, "en", "a", 0) for i, t in enumerate(QUALITY_TEXTS)]
    docs = spark.createDataFrame(rows, COLUMNS)
    order = list(quality.rules({n: F.lit(1) for n in quality.FEATURES}, F.array(F.lit("a"))))
    monkeypatch.setattr(quality, "rule_order", lambda *a: [{"rule": n} for n in order])
    found = quality.judge(docs, report=True).collect()
    assert {"few_letters", "few_kinds"} & {r.failed for r in found}
    for r in found:
        want = plain_features(r.row.text)
        assert {n: r[n] for n in quality.FEATURES} == want
        assert (r.failed is None) == plain_kept(r.row.text), r
        assert r.rules_run == (order.index(r.failed) + 1 if r.failed else len(order))
    lazy = {(r.row.doc_id, r.row.text): r.failed for r in quality.judge(docs).collect()}
    assert lazy == {(r.row.doc_id, r.row.text): r.failed for r in found} or all(
        (lazy[(r.row.doc_id, r.row.text)] is None) == (r.failed is None) for r in found
    )
    kept = quality.keep_good(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert kept.count() == sum(plain_kept(r[1]) for r in awkward_rows())


def test_the_order_of_rules_changes_no_verdict(spark):
    docs = spark.createDataFrame([(t,) for t in QUALITY_TEXTS], "text string")
    names = list(quality.rules({n: F.lit(1) for n in quality.FEATURES}, F.array(F.lit("a"))))
    verdicts = []
    for order in (names, names[::-1]):
        out = docs.select(quality.first_failed(F.col("text"), order).alias("f")).collect()
        verdicts.append([r.f is None for r in out])
    assert verdicts[0] == verdicts[1]


@pytest.mark.parametrize("report", [True, False])
def test_rules_behind_a_rejecting_one_do_not_run(spark, monkeypatch, report):
    """A rule that fails the job when it is looked at, behind one that rejects short texts."""
    docs = spark.createDataFrame([(1, prose(1, 5)), (2, prose(2, 9))], "doc_id long, text string").repartition(2)
    known = quality.rules

    def with_trap(f, found):
        trap = F.raise_error(F.concat(F.lit("looked at "), found[0])).cast("boolean")
        return {**known(f, found), "trap": trap}

    monkeypatch.setattr(quality, "rules", with_trap)
    for names, runs in ((["few_words", "trap"], True), (["trap", "few_words"], False)):
        monkeypatch.setattr(quality, "rule_order", lambda *a, n=names: [{"rule": r} for r in n])
        judged = quality.judge(docs, report=report)
        if runs:
            assert {r.failed for r in judged.collect()} == {"few_words"}
        else:
            with pytest.raises(Exception, match="looked at"):
                judged.collect()


def test_rules_are_ordered_by_rejections_per_cost(spark):
    docs = spark.createDataFrame([("too short",)] * 40 + [(prose(1, 50),)], "text string")
    order = quality.rule_order(docs)
    assert sorted(r["rule"] for r in order) == sorted(quality.rules({n: F.lit(1) for n in quality.FEATURES}, F.array(F.lit("a"))))
    gain = [r["share"] / r["cost"] for r in order]
    assert gain == sorted(gain, reverse=True) and order[0]["share"] > 0.9
    assert quality.keep_good(empty(spark)).count() == 0


def test_a_filter_on_the_verdict_splits_the_text_once(spark):
    """The filter may be pushed down; the words must not be found again for every use."""
    docs = spark.createDataFrame([(prose(1, 50),)], "text string")
    plan = quality.keep_good(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 2


def water(sizes: list[int], weights: list[int], epochs: int) -> list[float]:
    """Raise targets round by round; what is above a cap is shared again."""
    total, caps = sum(sizes), [epochs * s for s in sizes]
    full = set()
    while True:
        left = total - sum(caps[i] for i in full)
        open_ = [i for i in range(len(sizes)) if i not in full]
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > caps[i]}
        if not over:
            return [float(caps[i]) if i in full else share[i] for i in range(len(sizes))]
        full |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1000, 1, 2, 50], [0, 5, 5], [7], [900, 10, 10, 10, 3, 3]])
@pytest.mark.parametrize("epochs", [3, 1])
def test_water_filling(spark, sizes, epochs):
    rows = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, source_size long")
    weight = mixing.cycling("source", (1, 2, 3))
    got = {r.source: r.target for r in mixing.targets(rows, weight, epochs).collect()}
    weights = [1 + i % 3 for i in range(len(sizes))]
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(water(sizes, weights, epochs))


def corpus(spark):
    """One source with most of the words, small ones that reach their cap, and a null one."""
    rows = [(i, prose(i, 5 + i % 40), "en", "big", 0) for i in range(300)]
    rows += [(1000 + i, prose(i, 20), "en", f"s{i % 3}", 0) for i in range(30)]
    rows += [(2000 + i, prose(i, 9), "en", None, 0) for i in range(8)]
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


@pytest.mark.parametrize("range_rows", [20, 100_000])
def test_mix_comes_near_its_targets(spark, range_rows):
    docs = corpus(spark)
    found = mixing.mix(docs, range_rows=range_rows).collect()
    again = mixing.mix(docs.repartition(2), range_rows=range_rows).collect()
    taken = {r.row.doc_id: r.taken for r in found}
    assert taken == {r.row.doc_id: r.taken for r in again}
    by = defaultdict(list)
    for r in found:
        assert r.size == len(words(r.row.text)) and r.taken <= 3 * r.size and r.taken % r.size == 0
        by[r.row.source].append(r)
    assert set(by) == {"big", "s0", "s1", "s2", None}
    for rows in by.values():
        assert rows[0].source_size == sum(r.size for r in rows)
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows) / 2
    assert any(rows[0].target == 3 * rows[0].source_size for rows in by.values())
    repeated = Counter(r.doc_id for r in mixing.mixed(docs, range_rows=range_rows).collect())
    assert repeated == {r.row.doc_id: r.copies for r in found if r.copies}


def test_ranges_do_not_change_the_mix(spark):
    few = {r.row.doc_id: r.taken for r in mixing.mix(corpus(spark), range_rows=10**6).collect()}
    many = {r.row.doc_id: r.taken for r in mixing.mix(corpus(spark), range_rows=7).collect()}
    assert few == many


def test_mix_of_awkward_rows(spark):
    found = mixing.mix(awkward(spark)).collect()
    assert len(found) == len(awkward_rows())
    assert all(r.taken == 0 for r in found if not words(r.row.text))
    assert mixing.mixed(awkward(spark)).columns == awkward(spark).columns
    assert mixing.mix(empty(spark)).count() == 0


def test_communication_matrix_is_exact_and_fair():
    parts = [7, 0, 120, 33]
    total = np.zeros((4, 5))
    for seed in range(400):
        matrix = sharding.communication_matrix(parts, 5, seed)
        assert (matrix.sum(axis=1) == parts).all()
        assert (matrix.sum(axis=0) == sharding.shard_sizes(160, 5)).all()
        total += matrix
    assert np.allclose(total / 400, np.outer(parts, [0.2] * 5), atol=1.0)


def test_draws_beyond_the_bound_of_numpy():
    rng = np.random.default_rng(1)
    drawn = sharding._draw(rng, np.array([10**9, 3 * 10**9]), 4000)
    assert drawn.sum() == 4000 and abs(drawn[0] - 1000) < 150


@pytest.mark.parametrize("part_rows", [3, 20_000])
def test_shards_are_exact_and_reproducible(spark, part_rows):
    docs = awkward(spark)
    found = sharding.shuffle_to_shards(docs, shards=4, part_rows=part_rows).collect()
    sizes = Counter(r.shard for r in found)
    assert len(found) == len(awkward_rows()) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s]))
    assert Counter((r.row.doc_id, r.row.text) for r in found) == Counter((r[0], r[1]) for r in awkward_rows())
    other = sharding.shuffle_to_shards(docs.repartition(7), shards=4, part_rows=part_rows).collect()
    place = lambda rows: sorted((str(r.row), r.shard, r.slot) for r in rows)
    assert place(found) == place(other)


def test_shuffles_are_even(spark):
    """Neighbours in the input must be spread over shards and slots."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"))
    found = sharding.shuffle_to_shards(docs, shards=8, part_rows=300).collect()
    ids = np.array([r.row.doc_id for r in found], dtype=float)
    for value in ([r.shard for r in found], [r.slot for r in found]):
        assert abs(np.corrcoef(ids, value)[0, 1]) < 0.06
    low = Counter(r.shard for r in found if r.row.doc_id < 1000)
    assert all(90 <= n <= 165 for n in low.values())
    assert sharding.shuffle_to_shards(empty(spark)).count() == 0


def test_written_shards(spark, tmp_path):
    sharded = sharding.shuffle_to_shards(spark.createDataFrame(awkward_rows(), COLUMNS), shards=3)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(awkward_rows()) and back.select("shard").distinct().count() == 3
