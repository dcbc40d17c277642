"""Repeated byte strings (suffix arrays) and word windows (FM-index) against plain counting."""

import random

import numpy as np
import pytest

from snapmart.llm import anchors, repeats
from snapmart.llm.fm_dedup import FMIndex, WaveletMatrix, matching_starts, remove_repeated_words
from snapmart.llm.suffix_dedup import remove_repeated_bytes
from tests.llm.helpers import awkward, awkward_rows, empty, plain_bytes, plain_words, prose, sorted_rows

BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def expected(plain, size):
    rows = awkward_rows()
    return sorted_rows((r[0], *x) for r, x in zip(rows, plain([r[1] for r in rows], size), strict=True))


def test_stretches_hold_every_window_once_and_follow_the_content():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 3, 500).astype(np.uint64)
    both = np.concatenate([text, text[100:400]])
    rolling = anchors.Rolling(anchors.mix(both + np.uint64(1)))
    at = np.arange(len(both))
    grams = rolling.slices(at, np.minimum(at + 4, len(both)))
    size, reach = 40, 16
    valid = (at + size <= 500) | ((at >= 500) & (at + size <= 800))
    first, last, anchor = anchors.stretches(grams, valid, reach)
    held = [i for a, b in zip(first, last, strict=True) for i in range(a, b + 1)]
    assert held == list(np.flatnonzero(valid))
    of = {i: t - i for a, b, t in zip(first, last, anchor, strict=True) for i in range(a, b + 1)}
    assert all(0 <= d < reach for d in of.values())
    assert all(of[i] == of[i + 400] for i in range(100, 361))


def test_long_inputs_give_the_same_places_as_short_blocks(monkeypatch):
    hashes = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64)
    whole = anchors.window_places(hashes, 30)
    monkeypatch.setattr(anchors, "BLOCK", 700)
    assert (anchors.window_places(hashes, 30) == whole).all()
    low = np.uint64((1 << anchors.PLACE_BITS) - 1)
    assert all(hashes[p] & ~low == (hashes[i : i + 30] & ~low).min() for i, p in enumerate(whole))


@pytest.mark.parametrize("crowd", [256, 1])
def test_bytes_on_awkward_rows(spark, crowd):
    found = remove_repeated_bytes(awkward(spark), length=60, crowd=crowd)
    assert sorted_rows(found.select(*BYTES).collect()) == expected(plain_bytes, 60)
    for r in found.collect():
        assert r.n_bytes - sum(s.end - s.begin for s in r.spans) == len(r.kept)


@pytest.mark.parametrize("crowd", [256, 1])
def test_words_on_awkward_rows(spark, crowd):
    found = remove_repeated_words(awkward(spark), window=9, crowd=crowd)
    assert sorted_rows(found.select(*WORDS).collect()) == expected(plain_words, 9)


@pytest.mark.parametrize("block", [2_000, 500_000])
def test_random_repetitive_texts(spark, block, monkeypatch):
    """Copies, near copies with edits, shared passages and periods."""
    rng = random.Random(5)
    base = prose(1, 200).split()
    texts = []
    for i in range(60):
        w = list(base) if i % 2 else prose(i, 150).split()
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "edit"
        start = rng.randrange(100)
        texts.append(" ".join([*w, *base[start : start + rng.randint(5, 80)]]))
    texts += ["ab " * 100, "ab " * 50, texts[3], texts[4]]
    monkeypatch.setattr(repeats.repeated_windows, "__defaults__", (4, block))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for crowd in (4, 100):
        got = remove_repeated_bytes(docs, length=70, crowd=crowd).select(*BYTES).collect()
        assert [tuple(r)[1:] for r in sorted(got)] == plain_bytes(texts, 70)
        got = remove_repeated_words(docs, window=12, crowd=crowd).select(*WORDS).collect()
        assert [tuple(r)[1:] for r in sorted(got)] == plain_words(texts, 12)


def test_kept_words_are_the_text_without_the_spans(spark):
    texts = [prose(1, 40), prose(2, 10) + " " + prose(1, 40) + " tail"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(remove_repeated_words(docs, window=10).collect())
    assert (rows[0].kept, rows[1].kept) == ("", prose(2, 10) + " tail")


def test_empty_tables(spark):
    assert remove_repeated_bytes(empty(spark)).count() == 0
    assert remove_repeated_words(empty(spark)).count() == 0


def test_wavelet_matrix_ranks():
    symbols = np.random.default_rng(1).integers(0, 11, 300)
    matrix = WaveletMatrix(symbols)
    for low, high in ((0, 300), (17, 203), (64, 128), (5, 5)):
        for c in range(11):
            a, b = matrix.rank(np.array([c]), np.array([low]), np.array([high]))
            assert b[0] - a[0] == (symbols[low:high] == c).sum()


def test_backward_search_gives_matching_statistics():
    text = np.append(np.random.default_rng(0).integers(1, 4, 200), 0)
    index, line = FMIndex(text, 40), "".join(map(str, text))
    for end in range(5, 200, 7):
        p = end
        while p and sum(line.startswith(line[p - 1 : end], i) for i in range(len(line))) > 1:
            p -= 1
        assert matching_starts(index, text, np.array([end]), np.array([0]))[0] == p
