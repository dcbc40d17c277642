"""Quality rules as a cascade that stops at the first rule a document fails.

On a sample every rule is timed, net of what an empty job takes, and the share it rejects is counted.
Rules then run by rejections per cost, highest first, in one CASE expression: a document that fails a
rule never pays for the later ones. The order changes the cost and the name of the rule that is
reported, never the verdict, which is that no rule rejects. All of it is Spark's own expressions; no
text is shuffled.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import SPACE, documents, stored

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Symbols per word; more lenient than the usual 0.1, since marked-up prose should stay.
MAX_SYMBOLS = 0.5
MAX_DUP_LINES = 0.5
#: Mean word length.
WORD_LENGTHS = (1.5, 25.0)
#: Least share of words with a letter.
MIN_LETTER_PERCENT = 30
#: Least number of different words as a multiple of the root of all words. Prose has 5 and more at any
#: length up to books; word lists and filler that say little again and again have less than 1.
MIN_RICHNESS = 0.5
#: Rows of the sample on which rules are ordered; only the order depends on it.
SAMPLE_ROWS = 2_000
#: Seconds below which a difference of two jobs' times says nothing.
LEAST_COST = 0.001

FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"([^{SPACE}]+)"), F.lit(1))


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))


def _window_hashes(words: Column, window: int) -> Column:
    starts = F.when(
        F.size(words) >= window, F.sequence(F.lit(1), F.size(words) - F.lit(window - 1))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, window)))


def _covered(hashes: Column, window: int) -> Column:
    """Places covered by windows whose hash stands in the array twice or more."""

    def twice(pairs: Column) -> Column:
        """Starts of those windows: equal hashes stand side by side in the sorted pairs."""

        def marked(p: Column, k: Column) -> Column:
            hash_of = p.getField("h")
            near = F.coalesce(F.get(pairs, k - 1).getField("h") == hash_of, F.lit(False))
            near = near | F.coalesce(F.get(pairs, k + 1).getField("h") == hash_of, F.lit(False))
            return F.when(near, p.getField("i"))

        return F.array_sort(F.filter(F.transform(pairs, marked), lambda i: i.isNotNull()))

    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.aggregate(
        let(F.array_sort(pairs), twice),
        F.struct(F.lit(0).alias("covered"), F.lit(0).alias("end")),
        lambda s, i: F.struct(
            (s["covered"] + window - F.greatest(s["end"] - i, F.lit(0))).alias("covered"),
            (i + window).alias("end"),
        ),
        lambda s: s["covered"],
    )


def _repeat_words(words: Column, window: int) -> Column:
    return let(
        _window_hashes(words, window),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            _covered(h, window)
        ),
    )


def _features(text: Column, words: Column, lines: Column, window: int) -> dict[str, Column]:
    found = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words, window),
    }
    return {name: value.cast("long") for name, value in found.items()}


def rules(f: dict[str, Column], words: Column) -> dict[str, Column]:
    """Name and rejecting condition of each rule; ``f`` has the features by name.

    The last two look at the words themselves, when the cascade reaches them.
    """
    low, high = WORD_LENGTHS
    lettered = F.size(F.filter(words, lambda w: w.rlike(r"\p{L}")))
    different = F.size(F.array_distinct(words)).cast("long")
    return {
        "few_words": f["n_words"] < MIN_WORDS,
        "repeated_words": f["n_repeat_words"] * 100 > f["n_words"] * MAX_REPEATED_PERCENT,
        "symbols": f["n_symbols"] > f["n_words"] * MAX_SYMBOLS,
        "repeated_lines": f["n_dup_lines"] > f["n_lines"] * MAX_DUP_LINES,
        "word_lengths": (f["word_chars"] < f["n_words"] * low)
        | (f["word_chars"] > f["n_words"] * high),
        "few_letters": lettered * 100 < f["n_words"] * MIN_LETTER_PERCENT,
        "few_kinds": different * different < f["n_words"] * MIN_RICHNESS**2,
    }


def rule_order(docs: DataFrame, text_col: str = "text", rows: int = SAMPLE_ROWS) -> list[dict]:
    """Rules with their cost (seconds) and rejected share on a sample, best first.

    ``rows`` bounds the sample; nothing but the order depends on it.
    """
    total = docs.count()
    taken = docs.select(text_col).sample(fraction=min(1.0, rows / max(total, 1)), seed=7)
    sample = stored(taken, "rule-sample").coalesce(1)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    prepared = sample.select(text.alias("t"), words_of(text).alias("w"), _lines(text).alias("l"))
    found = _features(F.col("t"), F.col("w"), F.col("l"), REPEAT_WINDOW)

    def timed(condition: Column) -> tuple[float, float]:
        query = prepared.agg(F.avg(condition.cast("int")).alias("share"))
        query.first()  # compiled before it is timed
        took = []
        for _ in range(2):
            started = time.perf_counter()
            share = query.first()["share"] or 0.0
            took.append(time.perf_counter() - started)
        return min(took), share

    # Reads the same texts and judges nothing: what every job takes.
    empty, _ = timed(F.length("t") < 0)
    out = []
    for name, condition in rules(found, F.col("w")).items():
        cost, share = timed(condition)
        out.append({"rule": name, "cost": max(cost - empty, LEAST_COST), "share": share})
    return sorted(out, key=lambda r: -r["share"] / r["cost"])


def cascade(order: list[str], conditions: dict[str, Column]) -> Column:
    """Name of the first rule that rejects, null if none does."""
    out = F
    for name in order:
        out = out.when(conditions[name], F.lit(name))
    return out.otherwise(F.lit(None).cast("string"))


def first_failed(text: Column, order: list[str]) -> Column:
    """The cascade over the raw text, as one expression.

    Words and lines are bound inside it: a filter on the result may be moved below any projection
    and still splits the text once.
    """
    return let(
        words_of(text),
        lambda words: let(
            _lines(text),
            lambda lines: cascade(
                order, rules(_features(text, words, lines, REPEAT_WINDOW), words)
            ),
        ),
    )


def all_features(text: Column, order: list[str]) -> Column:
    """Struct of all features, ``failed`` and ``rules_run``; bound as in ``first_failed``.

    The features are computed for every row, the rules beyond them only as far as the cascade goes.
    """
    place = F.create_map(*[F.lit(x) for i, name in enumerate(order) for x in (name, i + 1)])

    def with_verdict(f: Column, words: Column) -> Column:
        known = {n: f[n] for n in FEATURES}

        def verdict(failed: Column) -> Column:
            run = F.when(failed.isNull(), F.lit(len(order))).otherwise(place[failed])
            return F.struct(
                *[v.alias(n) for n, v in known.items()], failed.alias("failed"),
                run.cast("int").alias("rules_run"),
            )

        return let(cascade(order, rules(known, words)), verdict)

    def features(words: Column, lines: Column) -> Column:
        found = _features(text, words, lines, REPEAT_WINDOW)
        known = F.struct(*[v.alias(n) for n, v in found.items()])
        return let(known, lambda f: with_verdict(f, words))

    return let(words_of(text), lambda words: let(_lines(text), lambda lines: features(words, lines)))


def judge(docs: DataFrame, text_col: str = "text", report: bool = False) -> DataFrame:
    """``row`` (struct of all columns) and ``failed``, the first rule that rejects it or null.

    With ``report`` the features are computed for all rows and returned as columns, with
    ``rules_run``, the number of rules looked at; the rules that need more than features still run
    only where no earlier one rejects. Otherwise each feature, too, is computed when the cascade
    reaches its rule. A null or empty text has no words and
    fails ``few_words``; every row is judged alone, so repeated rows, ties and null ids change
    nothing; an empty table gives an empty result; a text of any length is judged whole.
    """
    order = [r["rule"] for r in rule_order(docs, text_col)]
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    if report:
        return docs.select(row, all_features(text, order).alias("found")).select("row", "found.*")
    return docs.select(row, first_failed(text, order).alias("failed"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, all columns, that no rule rejects."""
    return judge(docs, text_col).where("failed IS NULL").select("row.*")


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(documents(spark, sf_dir), report=True)
    base = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    )
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), F.col("failed").isNull().alias("kept"),
    )


OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
x AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d) AS s),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM x) AS y
  WHERE c > 1),
p AS (SELECT rid, count(DISTINCT q) AS n
  FROM (SELECT rid, unnest(range(i, i + 8)) AS q FROM r) AS z GROUP BY rid),
f AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_lettered,
    len(list_distinct(w)) AS n_different
  FROM d LEFT JOIN p USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR n_symbols > n_words * 0.5
    OR n_dup_lines > n_lines * 0.5 OR word_chars < n_words * 1.5 OR word_chars > n_words * 25
    OR 100 * n_lettered < 30 * n_words OR n_different * n_different < n_words * 0.25)
    AS kept
FROM f"""
