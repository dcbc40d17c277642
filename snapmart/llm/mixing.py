"""Mixing sources to target weights, with repetitions up to a maximum number of epochs.

Targets come from capped water-filling: a source whose share by weight is above ``epochs`` times
its size stops there, and the rest is shared by weight among the others until none is above. A
source then repeats whole as often as its target allows, and a seeded part of its documents once
more: documents are put in the order of a hash, and the part ends where the words taken come
nearest to the target.

Sources may be of any size. The running sum of a source is never taken in one task: the order is
cut into ranges of the hash, the sums of the ranges tell in which range the part ends, and only the
documents of that range are summed one by one. Ranges grow in number with the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.llm.common import SPACE, documents, stored

EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-7"
#: Documents a range of the hash holds on average.
RANGE_ROWS = 1_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def cycling(source: str, weights: tuple[int, ...]) -> Column:
    """Weights in turn to the sources by code point, null last; for one row per source."""
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    return F.get(F.array(*[F.lit(w) for w in weights]), place % len(weights)).cast("long")


def targets(sizes: DataFrame, weight: Column, epochs: int = EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size) with the target of each source.

    Sources fill up in the order of cap by weight. The level at which the water stands is found
    from running sums over that order, so no loop is needed. Works on one row per source.
    """
    by_level = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("whole", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(after))
    )
    # The level if all sources before this one are full and this one and the later ones are not.
    level = (F.col("whole") - F.col("full")) / F.col("open")
    rows = rows.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    all_levels = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", F.first("level", ignorenulls=True).over(all_levels))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return rows.select("source", "source_size", "weight", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def _goals(narrow: DataFrame, epochs: int, weights: tuple[int, ...], range_rows: int) -> DataFrame:
    """Per source: source_size, target, ranges, whole epochs and the words of the part (need)."""
    totals = stored(
        narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")),
        "source-sizes", few=True,
    )
    ranges = totals.select(
        F.col("source").alias("s"),
        F.greatest(F.ceil(F.col("n") / range_rows), F.lit(1)).cast("long").alias("ranges"),
    )
    goals = targets(totals.select("source", "source_size"), cycling("source", weights), epochs)
    goals = goals.join(ranges, F.col("source").eqNullSafe(F.col("s")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(rate), F.lit(epochs)).cast("long")
    need = F.col("target") - F.col("whole") * F.col("source_size")
    return goals.withColumn("whole", whole).select(
        F.col("source").alias("s"), "source_size", "target", "ranges", "whole",
        F.when(F.col("whole") < epochs, need).otherwise(0.0).alias("need"),
    )


def _range(place: Column, ranges: Column) -> Column:
    """Which of so many equal ranges of the hash, a hexadecimal text, a place lies in."""
    return F.shiftright(F.conv(F.substring(place, 1, 6), 16, 10).cast("long") * ranges, 24)


def _cuts(narrow: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source the last place of its part, as a range and a place in it."""
    rows = narrow.join(goals, F.col("source").eqNullSafe(F.col("s"))).where("need > 0")
    rows = rows.select("s", "need", "size", "place", _range(F.col("place"), F.col("ranges")).alias("r"))
    sums = rows.groupBy("s", "need", "r").agg(F.sum("size").alias("range_size"))
    upto = F.sum("range_size").over(Window.partitionBy("s").orderBy("r"))
    last = sums.withColumn("before", upto - F.col("range_size")).where(
        (F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col("range_size"))
    )
    last = last.select(F.col("s").alias("s2"), F.col("r").alias("r2"), F.col("need").alias("n2"), "before")
    last = stored(last, "cut-ranges", few=True)
    inside = rows.join(last, F.col("s").eqNullSafe(F.col("s2")) & (F.col("r") == F.col("r2")))
    # Within the range, places in order; rows of one place are drawn together.
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("s", "r").orderBy("place"))
    ends = inside.select("s", "need", "r", "place", upto.alias("upto"))
    start = last.select("s2", "n2", "r2", F.lit("").alias("place"), F.col("before").alias("upto"))
    best = F.min(F.struct(F.abs(F.col("upto") - F.col("need")).alias("off"), "place"))
    return (
        ends.union(start).groupBy("s", "r").agg(best.alias("best"))
        .select(F.col("s").alias("s2"), F.col("r").alias("cut_range"),
                F.col("best.place").alias("cut_place"))
    )


def mix(
    docs: DataFrame, source_col: str = "source", text_col: str = "text",
    id_col: str = "doc_id", epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS,
    seed: str = SEED, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``row`` (struct of all columns), size, source_size, target, copies and taken of each row.

    copies says how often the mix holds the document, taken is size times copies. Null sources
    are one source; null or empty texts have size 0, so that none of their words is taken; rows of
    equal id and text are drawn together; the same input always gives the same mix; an empty table
    gives an empty result.
    """
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = F.col(f"row.{text_col}").cast("string")
    order = F.md5(
        F.concat_ws(
            "|", F.lit(seed), F.coalesce(F.col(f"row.{id_col}").cast("string"), F.lit("")),
            F.md5(F.coalesce(text, F.lit(""))),
        )
    )
    row = row.select(
        "row", F.col(f"row.{source_col}").alias("source"), n_words(text).alias("size"),
        order.alias("place"),
    )
    narrow = stored(row.select("source", "size", "place"), "mix-sizes")
    goals = stored(_goals(narrow, epochs, weights, range_rows), "mix-goals", few=True)
    cuts = goals.join(_cuts(narrow, goals), F.col("s").eqNullSafe(F.col("s2")), "left").drop("s2")
    drawn = row.join(stored(cuts, "mix-cuts", few=True), F.col("source").eqNullSafe(F.col("s")))
    at = _range(F.col("place"), F.col("ranges"))
    again = (at < F.col("cut_range")) | (
        (at == F.col("cut_range")) & (F.col("place") <= F.col("cut_place"))
    )
    copies = F.col("whole") + F.coalesce(again, F.lit(False)).cast("long")
    return drawn.select(
        "row", "size", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix holds it."""
    drawn = mix(docs, **how).where("copies > 0")
    return drawn.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select(
        "row.doc_id", "size", "source_size", "target", "taken"
    )


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS size,
    md5(concat_ws('|', 'mix-7', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, ''))))
      AS place
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS BIGINT) AS cap,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, sum(source_size) OVER () AS whole,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_
  FROM s),
v AS (
  SELECT *, CAST(whole - full_ AS DOUBLE) / CAST(open_ AS DOUBLE) AS level FROM l),
w AS (
  SELECT *, (SELECT level FROM v WHERE level * weight <= cap
    ORDER BY cap / weight, source NULLS LAST LIMIT 1) AS water FROM v),
t AS (
  SELECT source, source_size,
    least(CAST(cap AS DOUBLE), coalesce(water * weight, CAST(cap AS DOUBLE))) AS target FROM w),
g AS (
  SELECT *, CASE WHEN whole < 3 THEN target - whole * source_size ELSE 0 END AS need FROM (
    SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END
      AS whole FROM t) AS a),
c AS (
  SELECT d.source, place, sum(size) OVER (PARTITION BY d.source ORDER BY place) AS upto, need
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
  UNION ALL SELECT source, '', 0, need FROM g),
b AS (
  SELECT source, min({'off': abs(upto - need), 'place': place}) AS best FROM c
  WHERE need > 0 GROUP BY source)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN best IS NOT NULL AND place <= best.place THEN 1 ELSE 0 END)
    AS BIGINT) AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source"""
