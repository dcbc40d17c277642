"""Transcripts into chat turns: a hidden Markov model over lines recovers who speaks.

A line is observed through features: its speaker marker, whether it is blank, follows a blank line,
its length, and how it ends. A marker is a known word for a role, or any short name before a mark;
what tells such a name's role is its rank among the names that recur in the transcript. The hidden state is a role and whether the line opens a turn or goes on.
Viterbi finds the likeliest states of a whole transcript; turns are then rendered in one canonical
form. The tables of the model are counted on a bounded sample of transcripts whose roles are known.

A transcript of any length is cut into segments of ``SEGMENT`` turns. A segment is reduced to the
best score from each state before it to each state at its end. ``WIDTH`` of these small tables make
one of the next level, until one group is left; then the states at the cuts are settled level by
level downwards, and every segment is decoded between its own. The score is that of one pass over
the whole, and no row holds more than a segment's text or ``WIDTH`` tables.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.llm.common import stored

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # 2 * role opens a turn, 2 * role + 1 goes on with it
SEGMENT = 256
#: Tables combined at a time, and blocks whose order is told in one window.
WIDTH = 32
#: Names a transcript knows as speakers: those that recur, by first line; later ones count as lone.
SPEAKERS = 8
#: Conversations the tables are counted on, those with the smallest hashes.
FIT_CONVERSATIONS = 500

#: Words that name a speaker, by role.
NAMES = {
    "system": ("system", "sys", "instructions"),
    "user": ("user", "usr", "human", "customer", "q", "question", "me"),
    "assistant": ("assistant", "ai", "bot", "model", "a", "answer", "agent"),
}
_NAME_ROLE = {name: i for i, role in enumerate(ROLES) for name in NAMES[role]}
_MARKER = re.compile(
    r"\s{0,8}(?:[#*<>\[|(]{0,4}\s?)(" + "|".join(sorted(_NAME_ROLE, key=len, reverse=True))
    + r")(?:[\])*|>]{1,4}:?|\s?[:>])(?:\*\*)?\s?",
    re.IGNORECASE,
)
#: One to three words before a mark that a space or the line's end follows.
_SPEAKER = re.compile(
    r"\s{0,8}[#*<\[|(]{0,4}\s?([^\W\d_][\w.'-]{0,20}(?: [\w.'-]{1,20}){0,2})"
    r"(?:[\])*|>]{1,4}:?|\s?[:>])(?:\*\*)?(?=\s|$)\s?"
)
# Marker: a role or none. Name: none, a lone one, the first that recurs, the second, a later one. Then
# blank, after a blank line, length, ending. Marker and name share a table: a turn with neither is rare.
RANKS = 5
FEATURES = ((len(ROLES) + 1) * RANKS, 2, 2, 6, 4)


def speaker(line: str, known: bool = True) -> str | None:
    """The name before a line's mark, lower case; not one that tells its role, if ``known``."""
    found = None if known and _MARKER.match(line) else _SPEAKER.match(line)
    return found.group(1).lower() if found else None


def marker(line: str, names: Sequence[str] = (), known: bool = True) -> tuple[int, int, int]:
    """The features of the marker and the name, and the length to drop if the line opens a turn.

    A lone name may be text ("Note: ..."), so it is kept.
    """
    found = _MARKER.match(line) if known else None
    if found:
        return _NAME_ROLE[found.group(1).lower()], 0, found.end()
    found = _SPEAKER.match(line)
    if not found:
        return len(ROLES), 0, 0
    name = found.group(1).lower()
    if name not in names:
        return len(ROLES), 1, 0
    return len(ROLES), 2 + min(2, names.index(name)), found.end()


def recurring(lines: list[str], known: bool = True) -> list[str]:
    """Names that stand before more than one line, by first line."""
    counts = Counter(n for n in (speaker(x, known) for x in lines) if n is not None)
    return [n for n, times in counts.items() if times > 1][:SPEAKERS]


def features(line: str, before: str | None, names: Sequence[str] = (), known: bool = True) -> list[int]:
    role, name, drop = marker(line, names, known)
    rest = line[drop:]
    end = rest.rstrip()[-1:]
    return [
        role,
        name,
        int(not line.strip()),
        int(before is not None and not before.strip()),
        min(5, len(rest).bit_length() // 2),
        0 if not end else 1 if end == "?" else 2 if end in ".!" else 3,
    ]


def shown_by(line: str, before: str | None, names: Sequence[str] = (), known: bool = True) -> list[int]:
    """Row of each of the model's tables that a line looks up."""
    role, name, *rest = features(line, before, names, known)
    return [role * RANKS + name, *rest]


@dataclass
class Model:
    """Log probabilities."""

    start: np.ndarray
    step: np.ndarray
    shows: list[np.ndarray]  # state x value of each feature

    def emissions(self, lines: list[str], before: str | None, names: Sequence[str] = ()) -> np.ndarray:
        seen = np.array([shown_by(x, b, names) for x, b in zip(lines, [before, *lines])])
        return sum(table[:, seen[:, i]].T for i, table in enumerate(self.shows))


def fit(transcripts: list[list[tuple[str, list[str]]]]) -> Model:
    """Tables from transcripts given as (role, lines) turns; counts are smoothed.

    Each transcript counts twice, the second time as if no name told its role, so the ranks of
    names nobody has listed get their weight too.
    """
    start = np.ones(STATES)
    step = np.ones((STATES, STATES))
    shows = [np.ones((STATES, n)) for n in FEATURES]
    for turns, known in ((t, k) for t in transcripts for k in (True, False)):
        names = recurring([x for _, lines in turns for x in lines], known)
        state, before = None, None
        for role, lines in turns:
            for i, line in enumerate(lines):
                now = 2 * ROLES.index(role) + (i > 0)
                if state is None:
                    start[now] += 1
                else:
                    step[state, now] += 1
                for table, value in zip(shows, shown_by(line, before, names, known), strict=True):
                    table[now, value] += 1
                state, before = now, line
    # A turn can only go on as what it is, and a transcript begins with an opening line.
    for s in range(STATES):
        for t in range(1, STATES, 2):
            if s // 2 != t // 2:
                step[s, t] = 1e-9
    start[1::2] = 1e-9
    scaled = [np.log(t / t.sum(axis=1, keepdims=True)) for t in (start[None], step, *shows)]
    return Model(scaled[0][0], scaled[1], scaled[2:])


def segment_table(model: Model, shown: np.ndarray) -> np.ndarray:
    """Best score from each state before the lines to each state at the last one."""
    best = np.full((STATES, STATES), -np.inf)
    np.fill_diagonal(best, 0.0)
    for row in shown:
        best = (best[:, :, None] + model.step[None]).max(axis=1) + row
    return best


def viterbi(model: Model, shown: np.ndarray, first: np.ndarray, last: int | None) -> list[int]:
    """Likeliest states; ``first`` scores the states of the first line, ``last`` fixes the end."""
    best, back = first + shown[0], []
    for row in shown[1:]:
        scores = best[:, None] + model.step
        back.append(scores.argmax(axis=0))
        best = scores.max(axis=0) + row
    path = [int(best.argmax()) if last is None else last]
    for pointers in reversed(back):
        path.append(int(pointers[path[-1]]))
    return path[::-1]


def product(tables: list[np.ndarray]) -> np.ndarray:
    """One table for several that follow each other."""
    best = tables[0]
    for table in tables[1:]:
        best = (best[:, :, None] + table[None]).max(axis=1)
    return best


def cuts(
    model: Model, tables: list[np.ndarray], enter: int | None = None, leave: int | None = None
) -> list[int]:
    """State at the end of each segment. Without ``enter``, the state before, the first table
    starts from ``model.start``; ``leave`` fixes the last."""
    best, back = tables[0].max(axis=0) if enter is None else tables[0][enter], []
    for table in tables[1:]:
        scores = best[:, None] + table
        back.append(scores.argmax(axis=0))
        best = scores.max(axis=0)
    path = [int(best.argmax()) if leave is None else leave]
    for pointers in reversed(back):
        path.append(int(pointers[path[-1]]))
    return path[::-1]


def rendered(turns: list[tuple[str, str]]) -> str:
    """The canonical form of (role, text) turns."""
    return "<|end|>\n".join(f"<|{role}|>\n{text}\n" for role, text in turns)


def turns_of(lines: list[str], states: list[int], names: Sequence[str] = ()) -> list[tuple[int, str, bool]]:
    """(role, text, goes on from before) of the turns; markers and blank edges are dropped."""
    out: list[tuple[int, list[str], bool]] = []
    for line, state in zip(lines, states, strict=True):
        opens = state % 2 == 0
        if opens or not out:
            drop = marker(line, names)[2] if opens else 0
            out.append((state // 2, [line[drop:]], not opens))
        else:
            out[-1][1].append(line)
    return [(role, "\n".join(text).strip("\n"), more) for role, text, more in out]


def _tables(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, before, names in zip(*(batch.column(n).to_pylist() for n in ("text", "before", "names"))):
                shown = model.emissions((text or "").split("\n"), before, names or ())
                if before is None:
                    table = segment_table(model, shown[1:])
                    out.append((model.start + shown[0])[:, None] + table)
                else:
                    out.append(segment_table(model, shown))
            flat = [t.ravel().tolist() for t in out]
            yield pa.record_batch(
                [batch.column("id"), batch.column("segment"), pa.array(flat, pa.list_(pa.float64()))],
                names=["id", "segment", "table"],
            )

    return run


def _grids(row: pa.Scalar) -> list[np.ndarray]:
    return [np.array(t["table"]).reshape(STATES, STATES) for t in row.as_py()]


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = [product(_grids(row)).ravel().tolist() for row in batch.column("tables")]
        yield pa.record_batch(
            [batch.column("id"), batch.column("segment"), pa.array(flat, pa.list_(pa.float64()))],
            names=["id", "segment", "table"],
        )


def _cuts(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("enter").to_pylist(), batch.column("leave").to_pylist())
            out = [cuts(model, _grids(row), *side) for row, side in zip(batch.column("tables"), sides)]
            yield pa.record_batch(
                [batch.column("id"), batch.column("segment"), pa.array(out, pa.list_(pa.int32()))],
                names=["id", "segment", "ends"],
            )

    return run


def _speakers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per name and segment: its number of lines and the first of them."""
    for batch in batches:
        out: list[tuple] = []
        for key, segment, text in zip(*(batch.column(n).to_pylist() for n in ("id", "segment", "text"))):
            seen: dict[str, list[int]] = {}
            for at, line in enumerate((text or "").split("\n")):
                name = speaker(line)
                if name is not None:
                    seen.setdefault(name, [0, at])[0] += 1
            out += [(key, segment, name, n, at) for name, (n, at) in seen.items()]
        keys, segments, names, counts, first = zip(*out) if out else ((),) * 5
        yield pa.record_batch(
            [pa.array(keys, batch.schema.field("id").type), pa.array(segments, pa.int64()),
             pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(first, pa.int64())],
            names=["id", "segment", "name", "n", "line"],
        )


def rendering(turns: str, segment: str) -> Column:
    """``rendered`` as an expression; the texts of a transcript's segments, one behind the other,
    are its canonical form, even where a turn goes on in the next segment."""

    def one(t: Column, i: Column) -> Column:
        first = (F.col(segment) == 0) & (i == 0)
        opening = F.concat(
            F.when(first, F.lit("")).otherwise(F.lit("<|end|>\n")), F.lit("<|"), t["role"], F.lit("|>\n")
        )
        return F.concat(F.when(t["goes_on"], F.lit("")).otherwise(opening), t["text"], F.lit("\n"))

    return F.array_join(F.transform(turns, one), "")


_TURN = pa.struct([("role", pa.string()), ("text", pa.string()), ("goes_on", pa.bool_())])


def _decode(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = ("text", "before", "names", "enter", "leave")
            for text, before, names, enter, leave in zip(*(batch.column(n).to_pylist() for n in columns)):
                lines = (text or "").split("\n")
                shown = model.emissions(lines, before, names or ())
                first = model.start if enter is None else model.step[enter]
                states = viterbi(model, shown, first, leave)
                out.append([
                    {"role": ROLES[role], "text": said, "goes_on": more}
                    for role, said, more in turns_of(lines, states, names or ())
                ])
            yield pa.record_batch(
                [batch.column("id"), batch.column("segment"), pa.array(out, pa.list_(_TURN))],
                names=["id", "segment", "turns"],
            )

    return run


def speakers(segments: DataFrame) -> DataFrame:
    """The recurring names of transcripts: id and names, at most ``SPEAKERS``, by first line."""
    kind = segments.schema["id"].dataType.simpleString()
    found = segments.select("id", "segment", "text").mapInArrow(
        _speakers, f"id {kind}, segment long, name string, n long, line long"
    )
    first = F.min(F.struct("segment", "line")).alias("first")
    found = found.groupBy("id", "name").agg(F.sum("n").alias("n"), first).where("n > 1")
    order = F.row_number().over(Window.partitionBy("id").orderBy("first", "name"))
    found = found.withColumn("at", order).where(F.col("at") <= SPEAKERS)
    return found.groupBy(F.col("id").alias("named_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("names")
    )


def _sides(groups: DataFrame, ends: DataFrame | None) -> DataFrame:
    """Rows of id and segment with the states before (``enter``) and at the end (``leave``)."""
    if ends is None:
        nothing = F.lit(None).cast("int")
        return groups.withColumn("enter", nothing).withColumn("leave", nothing)
    at = ends.select(F.col("id").alias("cut_id"), F.col("segment").alias("cut_segment"), "leave")
    after = ends.select(
        F.col("id").alias("after_id"), (F.col("segment") + 1).alias("after_segment"), F.col("leave").alias("enter")
    )
    return groups.join(
        at, (F.col("id") == F.col("cut_id")) & (F.col("segment") == F.col("cut_segment")), "left"
    ).join(
        after, (F.col("id") == F.col("after_id")) & (F.col("segment") == F.col("after_segment")), "left"
    ).drop("cut_id", "cut_segment", "after_id", "after_segment")


def _grouped(tables: DataFrame, width: int) -> DataFrame:
    group = F.floor(F.col("segment") / width).cast("long").alias("segment")
    row = F.struct(F.col("segment"), F.col("table"))
    return tables.select("id", group, row.alias("row")).groupBy("id", "segment").agg(
        F.array_sort(F.collect_list("row")).alias("tables")
    )


def segment_ends(tables: DataFrame, model: Model, width: int = WIDTH) -> DataFrame:
    """The likeliest state at the end of each segment: id, segment, leave."""
    kind = tables.schema["id"].dataType.simpleString()
    levels = [stored(tables, "segment-tables")]
    largest = levels[0].agg(F.max("segment")).first()[0] or 0
    while largest >= width:
        shape = f"id {kind}, segment long, table array<double>"
        levels.append(stored(_grouped(levels[-1], width).mapInArrow(_products, shape), "segment-tables"))
        largest //= width
    ends = None
    for level in reversed(levels):
        groups = _sides(_grouped(level, width), ends).select("id", "segment", "tables", "enter", "leave")
        found = groups.mapInArrow(_cuts(model), f"id {kind}, segment long, ends array<int>")
        found = found.select("id", F.col("segment").alias("parent"), F.posexplode("ends").alias("at", "leave"))
        segment = (F.col("parent") * width + F.col("at")).alias("segment")
        ends = stored(found.select("id", segment, "leave"), "segment-ends")
    return ends


def parse_segments(segments: DataFrame, model: Model, width: int = WIDTH) -> DataFrame:
    """Turns of transcripts given as rows id, segment (0, 1, ... without gaps), text and before,
    the last line of the segment before (null in segment 0).

    Returns id, segment and turns, an array of (role, text, goes_on); goes_on marks a turn that
    began in an earlier segment. A null or empty text is one empty line.
    """
    segments = stored(segments, "segments")
    kind = segments.schema["id"].dataType.simpleString()
    named = speakers(segments)
    segments = segments.join(named, F.col("id") == F.col("named_id"), "left").select(
        "id", "segment", "text", "before", "names"
    )
    segments = stored(segments, "named-segments")
    several = segments.where("segment > 0").select("id").distinct()
    long_ = segments.join(stored(several, "long-transcripts"), "id")
    tables = long_.select("id", "segment", "text", "before", "names").mapInArrow(
        _tables(model), f"id {kind}, segment long, table array<double>"
    )
    placed = _sides(segments, segment_ends(tables, model, width))
    return placed.select("id", "segment", "text", "before", "names", "enter", "leave").mapInArrow(
        _decode(model),
        f"id {kind}, segment long, turns array<struct<role: string, text: string, goes_on: boolean>>",
    )


#: Ways in which transcripts of the table name the speakers: system, user, assistant.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("[system] ", "[user] ", "[assistant] "),
    ("### Instructions: ", "### Human: ", "### Assistant: "),
    ("SYS> ", "Q: ", "A: "),
    ("**system** ", "**Customer**: ", "**Agent**: "),
)


def _marked(role: Column, key: Column, styles: Sequence[Sequence[str]] = STYLES) -> Column:
    """The marker of a turn in its conversation's style; one turn in eight has none."""
    style = F.pmod(F.xxhash64(F.lit("style"), key), F.lit(len(styles)))
    known = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES)), role), F.lit(2))
    names = F.array(*[F.array(*map(F.lit, s)) for s in styles])
    return F.get(F.get(names, style), known.cast("int") - 1)


def transcripts(
    turns: DataFrame, segment: int = SEGMENT, styles: Sequence[Sequence[str]] = STYLES
) -> DataFrame:
    """Raw transcripts (id, segment, text, before) of a table of conv_id, turn, role and text.

    Turns stand in their order behind speaker markers in the style of their conversation, one in
    eight without. A row that is there twice is one turn. Rows without conversation or turn number
    are conversations of their own; unknown roles get the user's marker; null texts are empty.
    """
    rows = turns.select("conv_id", "turn", "role", F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct()
    alone = F.col("conv_id").isNull() | F.col("turn").isNull()
    other = F.concat(F.lit("row-"), F.hex(F.xxhash64("conv_id", "turn", "role", "text")))
    key = F.when(alone, other).otherwise(F.col("conv_id").cast("string"))
    bare = F.pmod(F.xxhash64(F.lit("bare"), "conv_id", "turn"), F.lit(8)) == 0
    said = F.concat(F.when(bare, F.lit("")).otherwise(_marked(F.col("role"), key, styles)), "text")
    block = F.when(alone, F.lit(0)).otherwise(F.floor(F.col("turn") / segment)).cast("long")
    parts = rows.select(key.alias("id"), block.alias("block"), F.struct(F.col("turn"), said.alias("said")).alias("t"))
    texts = parts.groupBy("id", "block").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    texts = texts.select("id", "block", F.array_join(F.transform("ts", lambda t: t["said"]), "\n").alias("text"))
    # Turn numbers may have gaps; segments are numbered without.
    texts = stored(texts.withColumn("end", F.substring_index("text", "\n", -1)), "transcripts")
    group = F.floor(F.col("block") / WIDTH)
    near = Window.partitionBy("id", "group").orderBy("block")
    blocks = texts.select("id", "block", "end", group.alias("group"))
    groups = blocks.groupBy("id", "group").agg(
        F.count("*").alias("n"), F.max_by("end", "block").alias("last")
    )
    far = Window.partitionBy("id").orderBy("group")
    groups = groups.select(
        F.col("id").alias("group_id"), F.col("group").alias("of_group"), F.lag("last").over(far).alias("last"),
        F.coalesce(F.sum("n").over(far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
    )
    placed = blocks.select(
        "id", "block", "group", F.lag("end").over(near).alias("in_group"), (F.row_number().over(near) - 1).alias("at")
    ).join(groups, (F.col("id") == F.col("group_id")) & (F.col("group") == F.col("of_group")))
    numbered = stored(
        placed.select(
            F.col("id").alias("end_id"), F.col("block").alias("end_block"),
            (F.col("earlier") + F.col("at")).cast("long").alias("segment"),
            F.when(F.col("at") > 0, F.col("in_group")).otherwise(F.col("last")).alias("before"),
        ),
        "transcript-ends",
    )
    return texts.join(numbered, (F.col("id") == F.col("end_id")) & (F.col("block") == F.col("end_block"))).select(
        "id", "segment", "text", "before"
    )


def fitted(turns: DataFrame, conversations: int = FIT_CONVERSATIONS, salt: str = "fit") -> Model:
    """Tables counted on the ``conversations`` whose ids have the smallest hashes, as marked in
    their transcripts; a conversation counts up to ``SEGMENT`` turns."""
    ids = turns.where("conv_id IS NOT NULL").select("conv_id").distinct()
    ids = ids.orderBy(F.xxhash64(F.lit(salt), "conv_id"), "conv_id").limit(conversations)
    known = turns.where(F.col("role").isin(*ROLES) & (F.col("turn") < SEGMENT) & (F.col("turn") >= 0))
    known = known.join(F.broadcast(ids), "conv_id").select("conv_id", "turn", "role", "text").distinct()
    bare = F.pmod(F.xxhash64(F.lit("bare"), "conv_id", "turn"), F.lit(8)) == 0
    marker = F.when(bare, F.lit("")).otherwise(_marked(F.col("role"), F.col("conv_id").cast("string")))
    said = F.concat(marker, F.coalesce("text", F.lit("")))
    rows = known.select("conv_id", "turn", "role", said.alias("said")).collect()
    by: dict[object, list] = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"], r["role"], r["said"])):
        by.setdefault(r["conv_id"], []).append((r["role"], r["said"].split("\n")))
    return fit(list(by.values()))


def op7_transcript_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recovered turns of every conversation: conv_id, segment, roles and the canonical text."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = parse_segments(transcripts(turns), fitted(turns))
    return found.select(
        F.col("id").alias("conv_id"), "segment", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["role"]), ",").alias("roles"),
        rendering("turns", "segment").alias("rendered"),
    )
