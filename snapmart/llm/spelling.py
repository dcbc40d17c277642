"""Grouping spelling variants: words one edit apart, by Gram products of letter counts.

A replaced letter changes the squared distance of two words' letter counts by 2 at most, an inserted
or deleted one by 1. So a block of words of some length and those one longer is multiplied with
NumPy, pairs at a squared distance of 2 or less are kept, and their edits are verified.

A block is more than a length: two words one edit apart agree in the first half of the shorter one or
in what follows it, so a block is the words of a length, and those one longer, that share a half. A
block of more than ``crowd`` words is cut again in the same way, in the half it does not share. In the
end all letters but one place are shared, and a block holds no more words than letters can fill two
places. No pair is lost, none is found twice, and no task holds more than a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import documents, stored

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 5
MIN_COUNT = 3
LEAD = 2  # a form is at least so many times as frequent as its variant
CROWD = 512
CELLS = 64  # letters are counted by their code point modulo this; that can only shrink distances
TYPO_EVERY = 97


def spelled_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, typo_every: int | None = None,
) -> DataFrame:
    """word and n, its occurrences, of the runs of letters in all texts, A to Z lower-cased.

    With ``typo_every`` a run loses one letter where that number divides the CRC of id and run, for
    tests of what corrects it. Null texts have no words; a null id counts as empty text; repeated
    rows count each time; other columns are not looked at; an empty table gives an empty result.
    """
    text = F.translate(docs[text_col].cast("string"), UPPER, LOWER)
    runs = F.regexp_extract_all(text, F.lit(f"([{LETTERS}]+)"), F.lit(1))
    id_ = F.coalesce(docs[id_col].cast("string"), F.lit(""))
    rows = docs.select(id_.alias("id"), F.explode(runs).alias("word"))
    if typo_every:
        crc = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        rows = rows.select("word", crc.alias("crc"))
        shorter = "concat(left(word, int(crc % length(word))), substring(word, int(crc % length(word)) + 2))"
        rows = rows.select(
            F.when(F.col("crc") % typo_every == 0, F.expr(shorter)).otherwise(F.col("word")).alias("word")
        )
    long_enough = rows.where(F.length("word") >= min_chars)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _cut(rows: DataFrame) -> DataFrame:
    """Each row twice, in the blocks that share one more half: (base, pre, suf, own, word, n, key).

    ``base`` is the length of the shorter words of a block, whose words share their first ``pre`` and
    last ``suf`` letters; ``own`` is true for words of that length.
    """
    half = "(base - pre - suf) div 2"
    both = F.expr(
        f"array(named_struct('pre', int(pre + {half}), 'suf', suf),"
        f" named_struct('pre', pre, 'suf', int(base - pre - {half})))"
    )
    cut = rows.select("base", "own", "word", "n", F.explode(both).alias("at"))
    cut = cut.select("base", "at.pre", "at.suf", "own", "word", "n")
    shared = F.expr("concat(left(word, pre), right(word, suf))")
    return cut.withColumn("key", F.concat_ws(":", "base", "pre", "suf", shared))


def _blocks(words: DataFrame) -> DataFrame:
    """Every word among those of its own length and among those one shorter, cut once."""
    lengths = F.expr("array(named_struct('base', length(word), 'own', true),"
                     " named_struct('base', length(word) - 1, 'own', false))")  # fmt: skip
    rows = words.select("word", "n", F.explode(lengths).alias("in")).where("in.base > 0")
    nothing = F.lit(0).cast("int")
    return _cut(rows.select("in.base", nothing.alias("pre"), nothing.alias("suf"), "in.own", "word", "n"))


def letter_counts(words: list[str]) -> np.ndarray:
    """A row of counts by letter for each word."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    cell = np.repeat(np.arange(len(words)) * CELLS, lengths) + letters % CELLS
    return np.bincount(cell, minlength=len(words) * CELLS).reshape(-1, CELLS).astype(np.float64)


def near_pairs(words: list[str], counts: np.ndarray, own: int, suf: int) -> list[tuple[int, int]]:
    """Pairs (i, j) one edit apart in a block whose first ``own`` words are the shorter ones.

    A pair that shares both halves is left to the block of the first.
    """
    square = (counts * counts).sum(axis=1)
    gram = counts[:own] @ counts.T
    distance = square[:own, None] + square[None, :] - 2 * gram
    found = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(distance <= 2)), strict=True):
        if j < own and j <= i:
            continue
        u, v = words[i], words[j]
        first = next((k for k, (a, b) in enumerate(zip(u, v)) if a != b), len(u))
        if suf and first >= len(u) - suf:
            continue
        if u[first + (j < own) :] == v[first + 1 :] and u != v:
            found.append((i, j))
    return found


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of every pair in each block; the input is sorted by block, own words first."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
        own, suf = rows["own"].to_numpy(), rows["suf"].to_numpy()
        key = np.array(rows["key"].to_pylist(), dtype=object)
        counts = letter_counts(words)
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        a, b = [], []
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            pairs = near_pairs(words[low:high], counts[low:high], int(own[low:high].sum()), int(suf[low]))
            a += [low + i for i, _ in pairs]
            b += [low + j for _, j in pairs]
        one, other = [*a, *b], [*b, *a]
        return pa.record_batch(
            [pa.array([words[i] for i in one], pa.string()),
             pa.array([words[j] for j in other], pa.string()), pa.array(n[other], pa.int64())],
            names=["word", "near", "near_n"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        # The last block may go on in the next batch.
        key = batch.column("key")
        last = key[batch.num_rows - 1]
        same = pc.index(key, last).as_py()
        if same == 0 and held[0].column("key")[0].as_py() == last.as_py():
            continue
        rows = pa.Table.from_batches(held)
        cut = rows.num_rows - (batch.num_rows - same)
        if cut:
            yield solve(rows.slice(0, cut))
        held = rows.slice(cut).to_batches()
    if held:
        yield solve(pa.Table.from_batches(held))


def pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, near, near_n) of every two words one edit apart, in both directions, each once."""
    rows, out = _blocks(words), None
    while True:
        # Counted before the shuffle; a block needs a shorter word and any other.
        sizes = rows.groupBy("key").agg(
            F.count("*").alias("all"), F.count_if("own").alias("shorter"),
            F.max(F.expr("base - pre - suf > 1")).alias("cuts"),
        )
        sizes = sizes.where("`all` > 1 AND shorter > 0").select(
            "key", (F.col("cuts") & (F.col("all") > crowd)).alias("crowded")
        )
        rows = stored(rows.join(stored(sizes, "spelling-sizes").hint("merge"), "key"), "spelling-blocks")
        found = (
            rows.where("NOT crowded").select("key", "own", "suf", "word", "n")
            .repartition("key").sortWithinPartitions("key", F.desc("own"))
            .mapInArrow(_pairs, "word string, near string, near_n long")
        )
        out = found if out is None else out.union(found)
        crowded = rows.where("crowded").drop("key", "crowded")
        if crowded.isEmpty():
            return out
        rows = _cut(crowded)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form reached from each word that has one; chains are halved per round."""
    current = stored(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(
            current.join(on, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        current = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return current


def variants(words: DataFrame, lead: int = LEAD, crowd: int = CROWD) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n; each word once).

    Words are near if they differ by one inserted, deleted or replaced code point. The form of a word
    is its near word of the largest n (ties: the smallest in code-point order) if that is at least
    ``lead`` times its own n, else null; root is the last word reached over forms, the word itself
    without one. ``lead`` is 2 or more, so forms never turn in a circle. Null words take no part;
    an empty table gives an empty result.
    """
    if lead < 2:
        raise ValueError("a form must be more frequent than its variant")
    words = words.where("word IS NOT NULL")
    # Least by negated count, then by bytes, which order texts like their code points.
    near = pairs(words, crowd).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    best_n = -F.col("best.less")
    form = F.when(best_n >= lead * F.col("n"), F.struct(F.col("best.near").alias("word"), best_n.alias("n")))
    forms = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("f")
        ).select("word", F.col("f.word").alias("form"), "n", "n_near", F.col("f.n").alias("form_n")),
        "spelling-forms",
    )
    return forms.join(_roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelled_words(documents(spark, sf_dir), typo_every=TYPO_EVERY)
    return variants(stored(words, "spelling-words"))


OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)),
r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents) AS s
  GROUP BY ALL),
b AS (
  SELECT run, c, list_prepend(4294967295, flatten(list_transform(
    string_split(concat(id, ':', run), ''), lambda x: CASE WHEN unicode(x) < 128
      THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) AS BIGINT) - 64] END))) AS bytes
  FROM r),
h AS (
  SELECT run, c, xor(list_reduce(bytes,
    lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INTEGER) + 1])), 4294967295) AS h
  FROM b, crc),
v AS (
  SELECT CASE WHEN h % 97 = 0 THEN concat(substr(run, 1, CAST(h % length(run) AS INTEGER)),
    substr(run, CAST(h % length(run) AS INTEGER) + 2)) ELSE run END AS word, c FROM h),
w AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM v WHERE length(word) >= 5
  GROUP BY word HAVING sum(c) >= 3),
x AS (
  SELECT word, n, i, concat(substr(word, 1, i), substr(word, i + 2)) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w) AS s),
e AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM x AS a JOIN x AS b USING (i, rest)
  WHERE length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT x.word, w.word, w.n FROM x JOIN w ON x.rest = w.word
  UNION SELECT w.word, x.word, x.n FROM x JOIN w ON x.rest = w.word),
f AS (
  SELECT word, count(*) AS n_near, min({'less': -near_n, 'near': near}) AS best
  FROM e GROUP BY word),
g AS (
  SELECT word, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
    CASE WHEN -best.less >= 2 * n THEN best.near END AS form,
    CASE WHEN -best.less >= 2 * n THEN -best.less END AS form_n
  FROM w LEFT JOIN f USING (word)),
p AS (
  SELECT word, word AS top FROM w
  UNION ALL SELECT p.word, g.form FROM p JOIN g ON p.top = g.word WHERE g.form IS NOT NULL)
SELECT g.word, form, top AS root, n, n_near, CAST(form_n AS BIGINT) AS form_n
FROM g JOIN p ON p.word = g.word
WHERE top IN (SELECT word FROM g WHERE form IS NULL)"""
