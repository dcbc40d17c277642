"""Spelling variants against comparing every two words."""

import random
import re
import zlib
from collections import Counter

import pytest

from snapmart.llm import spelling
from tests.llm.helpers import COLUMNS, awkward, awkward_rows, empty


def one_edit(u: str, v: str) -> bool:
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def plain(counts: dict[str, int], lead: int = 2) -> dict[str, tuple]:
    out, forms = {}, {}
    for w, n in counts.items():
        near = [(-counts[v], v) for v in counts if one_edit(w, v)]
        best = min(near, default=None)
        form = best[1] if best and -best[0] >= lead * n else None
        forms[w], out[w] = form, (n, len(near), counts[form] if form else None)
    found = {}
    for w, (n, near, form_n) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        found[w] = (forms[w], root, n, near, form_n)
    return found


def variants_of(spark, counts, **how):
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    rows = spelling.variants(df, **how).collect()
    assert len(rows) == len(counts)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def dense_words(seed: int) -> dict[str, int]:
    """Words of few letters, so that nearly all have near ones, and blocks are large."""
    rng = random.Random(seed)
    words = {"".join(rng.choices("abé", k=rng.randint(5, 7))) for _ in range(260)}
    words |= {"x" * 40, "x" * 41, "x" * 20 + "y" + "x" * 19, "aaaaa", "aaaaaa", "aaaab"}
    return {w: rng.randint(3, 60) for w in sorted(words)}


@pytest.mark.parametrize("crowd", [512, 4])
def test_variants_agree_with_all_pairs(spark, crowd):
    """Blocks that are cut down to one open place give the same as large ones."""
    counts = dense_words(1)
    assert variants_of(spark, counts, crowd=crowd) == plain(counts)


def test_one_first_half_for_a_third_of_all_words(spark):
    rng = random.Random(3)
    words = {"inter" + "".join(rng.choices("abcdefgh", k=5)) for _ in range(200)}
    words |= {"".join(rng.choices("abcdefghij", k=rng.randint(8, 11))) for _ in range(200)}
    counts = {w: rng.randint(3, 99) for w in sorted(words)}
    assert variants_of(spark, counts, crowd=8) == plain(counts)


def test_chains_lead_to_the_last_form_and_ties_to_the_smallest_word(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "zzzzz": 3,
              "zzzzy": 9, "zzzzw": 9, "zzzzé": 9, "ooooo": 5, "ooooi": 9}
    found = variants_of(spark, counts)
    assert found["aaaaa"][:2] == ("aaaab", "bbbbb")
    assert found["zzzzz"] == ("zzzzw", "zzzzw", 3, 3, 9)
    assert found["ooooo"] == (None, "ooooo", 5, 1, None)
    assert found == plain(counts)


def plain_words(rows, every) -> Counter:
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return Counter({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})


@pytest.mark.parametrize("every", [None, 3])
def test_words_of_awkward_rows(spark, every):
    rows = spelling.spelled_words(awkward(spark), typo_every=every).collect()
    want = plain_words([(r[0], r[1]) for r in awkward_rows()], every)
    assert len(want) > 5 and {r["word"]: r["n"] for r in rows} == want


def test_letters_and_cases(spark):
    rows = [(1, "ÀÉÎÕÜ Straße× naïve÷ don't ﬁxed 12abcde34 ABCDE", None, None, 1)] * 3
    found = spelling.spelled_words(spark.createDataFrame(rows, COLUMNS)).collect()
    assert {r["word"] for r in found} == {"ÀÉÎÕÜ", "straße×", "naïve÷", "abcde"}
    assert {r["n"] for r in found if r["word"] == "abcde"} == {6}


def test_empty_table_and_null_words(spark):
    assert spelling.variants(spelling.spelled_words(empty(spark))).count() == 0
    df = spark.createDataFrame([(None, 3), ("abcde", 3)], "word string, n long")
    assert [tuple(r) for r in spelling.variants(df).collect()] == [("abcde", None, "abcde", 3, 0, None)]


def test_counts_of_letters_never_hide_a_near_word():
    rng = random.Random(5)
    for _ in range(200):
        u = "".join(rng.choices("abcdeéüÿ", k=rng.randint(1, 9)))
        at = rng.randrange(len(u))
        for v in (u[:at] + u[at + 1 :], u[:at] + rng.choice("xyzäß") + u[at + 1 :], u[:at] + "q" + u[at:]):
            a, b = spelling.letter_counts([u, v])
            assert ((a - b) ** 2).sum() <= 2
