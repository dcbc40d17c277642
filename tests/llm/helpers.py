"""Small tables with awkward rows, and plain versions of the operators to compare with."""

import hashlib
import random
import re
from collections import Counter

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside; input columns of these names must not disturb them.
CLASHING = ["k1", "k2", "id", "row", "text_", "print", "spans", "shard", "slot", "size", "target",
            "words", "features", "key", "root", "place", "core", "first"]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    parts = ["the", "of", "and", "ing", "er", "at", "on", "re", "ti", "es", "é", "ß"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words))


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, copies."""
    shared = prose(1, 90)
    rows = [
        (1, prose(2, 60) + " " + shared + " " + prose(3, 40), "en", "a", 5),
        (2, shared, "en", "b", 6),
        (3, prose(4, 30) + "\n" + shared + "\t" + prose(5, 3000), "de", None, None),
        (4, None, None, "c", 0), (5, "", "en", "a", 0), (None, None, None, None, None),
        (None, prose(6, 50), "en", "a", 1), (6, " \t\n ", "fr", "b", 3), (7, "one", "en", "a", 3),
        (8, "a " * 700, "en", "b", 1400), (9, "z" * 900, "en", "c", 900),
        (10, prose(7, 120), "es", "a", 1), (10, prose(7, 120), "es", "a", 1),
        (11, prose(7, 120), "es", "b", 1), (12, "x\x00y " * 200, "en", "a", 1),
        (13, "é" * 500 + " ü" * 40, "de", "c", 1),
    ]
    return rows


def awkward(spark, clashing: bool = True):
    df = spark.createDataFrame(awkward_rows(), COLUMNS).repartition(3)
    if clashing:
        df = df.selectExpr("*", *[f"'{i}' AS {n}" for i, n in enumerate(CLASHING)])
    return df


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _covered(units: list, size: int, counts: Counter) -> bytearray:
    marks = bytearray(len(units))
    for i in range(len(units) - size + 1):
        if counts[tuple(units[i : i + size])] > 1:
            marks[i : i + size] = b"\x01" * size
    return marks


def _window_counts(docs: list[list], size: int) -> Counter:
    return Counter(tuple(d[i : i + size]) for d in docs for i in range(len(d) - size + 1))


def plain_bytes(texts, size: int) -> list[tuple]:
    docs = [list((t or "").encode()) for t in texts]
    counts, out = _window_counts(docs, size), []
    for d in docs:
        marks = _covered(d, size, counts)
        kept = bytes(b for b, m in zip(d, marks, strict=True) if not m)
        spans = sum(m and (i == 0 or not marks[i - 1]) for i, m in enumerate(marks))
        out.append((len(d), sum(marks), spans, sha(kept)))
    return out


def plain_words(texts, size: int) -> list[tuple]:
    docs = [(t or "").encode().split() for t in texts]
    counts, out = _window_counts(docs, size), []
    for d in docs:
        marks = _covered(d, size, counts)
        kept = b" ".join(w for w, m in zip(d, marks, strict=True) if not m)
        out.append((len(d), sum(marks), sha(kept)))
    return out


def words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sorted_rows(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)
