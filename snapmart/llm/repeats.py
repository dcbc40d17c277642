"""Windows of a fixed number of tokens that start at more than one place of a corpus.

The work is exact and linear in the corpus; only hashes and positions of it are shuffled:

1. Each document is cut into stretches of window starts by content-chosen anchors
   (``anchors.py``). A row per stretch carries the hash of the core, the tokens that all windows
   of the anchor share, and the hash of the whole stretch with its windows.
2. Cores found once are dropped: their windows cannot repeat.
3. Whole stretches found more than once: all their windows repeat. Copies collapse here, whatever
   their number.
4. The other stretches beside them share the core and differ near an end. One context of each
   kind is fetched and handed to ``resolve``, which finds the single windows that repeat.
5. A core with more than ``crowd`` different contexts is cut finer: the windows of a context whose
   places before the anchor differ by less than ``width`` share more than the core, and the part they
   share is a core of their own, for which steps 2 to 4 are done again with a smaller width. At width 1
   a core is a whole window, so the cutting ends, and no group of more than ``crowd`` contexts ever
   meets in one task.

The result is exact, up to collisions of 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.anchors import Rolling, mix, stretches
from snapmart.llm.common import row_key, slabs, stored, utf8

SPAN = "k1 long, k2 long, first int, last int"
FINER = 8  # a crowded core is cut into so many ranges of windows at a time


@dataclass(frozen=True)
class Unit:
    """What a token is: ``size`` tokens make a window, anchors lie in its first ``reach``."""

    size: int
    reach: int
    gram: int  # tokens under one rolling hash
    tokens: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]  # 64-bit tokens, counts


def byte_tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    return data.astype(np.uint64) + np.uint64(1), np.array([len(t) for t in texts])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space."""
    word = np.concatenate([[False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[::2], edge[1::2]


def word_tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    starts, ends = word_bounds(data)
    rolling = Rolling(mix(data.astype(np.uint64) + np.uint64(1)))
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return rolling.slices(starts, ends), np.diff(np.searchsorted(starts, begins))


def _stretch_rows(unit: Unit):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            keys = [np.asarray(batch.column(k)) for k in ("k1", "k2")]
            for low, high in slabs(texts):
                tokens, counts = unit.tokens(texts[low:high])
                n = len(tokens)
                if n < unit.size:
                    continue
                ends = np.cumsum(counts)
                valid = np.arange(n) + unit.size <= np.repeat(ends, counts)
                spread = mix(tokens)
                one, two = Rolling(spread), Rolling(spread, 1)
                at = np.arange(n)
                grams = one.slices(at, np.minimum(at + unit.gram, n))
                first, last, anchor = stretches(grams, valid, unit.reach)
                core = one.slices(anchor, anchor + unit.size - unit.reach + 1)
                whole = two.slices(first, last + unit.size)
                doc = np.searchsorted(ends, first, side="right")
                begin = (ends - counts)[doc]
                yield pa.record_batch(
                    [keys[0][low + doc], keys[1][low + doc], (first - begin).astype(np.int32),
                     (last - begin).astype(np.int32), (anchor - begin).astype(np.int32),
                     core.view(np.int64), whole.view(np.int64)],
                    names=["k1", "k2", "first", "last", "anchor", "core", "whole"],
                )

    return parse


def _fetch(unit: Unit):
    """Token contents of the wanted stretches of each document."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            wanted = batch.column("wanted")
            for low, high in slabs(texts):
                tokens, counts = unit.tokens(texts[low:high])
                begin = np.cumsum(counts) - counts
                lists = wanted.slice(low, high - low)
                flat = lists.flatten()
                doc = np.repeat(np.arange(high - low), lists.value_lengths().to_numpy())
                f = {n: np.asarray(flat.field(n)) for n in ("first", "last", "anchor")}
                narrow = tokens.astype(np.uint8) if unit.tokens is byte_tokens else tokens
                held = [
                    narrow[b + s : b + e + unit.size].tobytes()
                    for b, s, e in zip(begin[doc], f["first"], f["last"], strict=True)
                ]
                yield pa.record_batch(
                    [np.asarray(batch.column(k))[low + doc] for k in ("k1", "k2")]
                    + [pa.array(f["first"]), pa.array(f["last"] - f["first"] + 1),
                       pa.array(f["anchor"] - f["first"]), flat.field("core"),
                       flat.field("single"), flat.field("crowded"),
                       pa.array(held, pa.binary())],
                    names=["k1", "k2", "first", "starts", "left", "core", "single", "crowded",
                           "content"],
                )

    return fetch


def unpack(content: list[bytes], kind) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(content), dtype=kind)
    return data, np.array([len(c) for c in content]) // np.dtype(kind).itemsize


def _finer_rows(unit: Unit, kind, width: int):
    """Parts of crowded contexts: windows whose places before the anchor fall into one range of
    ``width``. Their core is what all windows of the range have in common."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = batch.column("content").to_pylist()
            for low, high in slabs(content):
                data, counts = unpack(content[low:high], kind)
                tokens = mix(data.astype(np.uint64))
                one, two = Rolling(tokens), Rolling(tokens, 1)
                starts, left = (np.asarray(batch.column(c))[low:high].astype(np.int64) for c in ("starts", "left"))
                owner = np.repeat(np.arange(high - low), starts)
                step = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
                group = (left[owner] - step) // width
                begins, ends = runs_of(owner, group)
                own, first, last, group = owner[begins], step[begins], step[ends], group[begins]
                begin = (np.cumsum(counts) - counts)[own]
                anchor = begin + left[own]
                shared = one.slices(anchor - group * width, anchor - (group + 1) * width + 1 + unit.size)
                core = mix(shared ^ mix(group.astype(np.uint64) + np.uint64(width << 20)))
                whole = two.slices(begin + first, begin + last + unit.size)
                base = np.asarray(batch.column("first"))[low + own]
                yield pa.record_batch(
                    [np.asarray(batch.column(k))[low + own] for k in ("k1", "k2")]
                    + [base, (base + first).astype(np.int32), (base + last).astype(np.int32),
                       (left[own] - first).astype(np.int32), core.view(np.int64), whole.view(np.int64),
                       pa.array(batch.column("single").to_numpy(zero_copy_only=False)[low + own])],
                    names=["k1", "k2", "base", "first", "last", "left", "core", "whole", "single"],
                )

    return cut


def _slice(unit: Unit, kind):
    """Contents of the wanted parts of contexts."""
    item = np.dtype(kind).itemsize

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, base = batch.column("wanted"), np.asarray(batch.column("base"))
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            flat, content = lists.flatten(), batch.column("content").to_pylist()
            f = {n: np.asarray(flat.field(n)) for n in ("first", "last")}
            held = [
                content[o][(s - b) * item : (e - b + unit.size) * item]
                for o, b, s, e in zip(owner, base[owner], f["first"], f["last"], strict=True)
            ]
            yield pa.record_batch(
                [np.asarray(batch.column(k))[owner] for k in ("k1", "k2")]
                + [pa.array(f["first"]), pa.array(f["last"] - f["first"] + 1), flat.field("left"),
                   flat.field("core"), flat.field("single"), flat.field("crowded"), pa.array(held, pa.binary())],
                names=["k1", "k2", "first", "starts", "left", "core", "single", "crowded", "content"],
            )

    return parts


def runs_of(owner: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of one owner and group."""
    changed = (owner[1:] != owner[:-1]) | (group[1:] != group[:-1])
    return np.flatnonzero(np.concatenate([[True], changed])), np.flatnonzero(np.concatenate([changed, [True]]))


def runs(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true flags of one owner."""
    changed = np.concatenate([[True], owner[1:] != owner[:-1], [True]])
    on = np.concatenate([[False], flags, [False]])
    begins = np.flatnonzero(flags & (~on[:-2] | changed[:-1]))
    ends = np.flatnonzero(flags & (~on[2:] | changed[1:]))
    return begins, ends


def _resolved(resolve, kind, unit: Unit, block: int):
    """Feed whole cores, sorted by core, to ``resolve`` in blocks of about ``block`` bytes."""

    def answer(table: pa.Table) -> pa.RecordBatch:
        starts = np.asarray(table["starts"])
        content = table["content"].to_pylist()
        repeated = resolve(
            content, np.asarray(table["core"]), np.asarray(table["left"]), starts, unit.size
        )
        owner = np.repeat(np.arange(len(starts)), starts)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
        single = np.asarray(table["single"])
        begins, ends = runs(repeated & single[owner], owner)
        first = np.asarray(table["first"])[owner]
        return pa.record_batch(
            [np.asarray(table[k])[owner[begins]] for k in ("k1", "k2")]
            + [(first + step)[begins].astype(np.int32), (first + step)[ends].astype(np.int32)],
            names=["k1", "k2", "first", "last"],
        )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                core = np.asarray(batch.column("core"))
                if held and size > block:
                    # A core ends where the next begins; what follows it starts a new block.
                    last = np.asarray(held[-1].column("core"))[-1]
                    cut = int(np.searchsorted(core != last, True))
                    if cut < len(core):
                        held.append(batch.slice(0, cut))
                        yield answer(pa.Table.from_batches(held).combine_chunks())
                        held, size, batch = [], 0, batch.slice(cut)
                held.append(batch)
                size += batch.column("content").nbytes
        if held:
            yield answer(pa.Table.from_batches(held).combine_chunks())

    return blocks


def repeated_windows(
    docs: DataFrame, unit: Unit, resolve, crowd: int = 256, block: int = 500_000
) -> DataFrame:
    """Ranges of window starts (first .. last, in tokens) that repeat, by row key.

    ``docs`` has k1, k2 and text. Rows are judged as given: a row that is there twice repeats
    itself. Ranges of one document do not overlap.
    """
    kind = np.uint8 if unit.tokens is byte_tokens else np.uint64
    found = docs.mapInArrow(
        _stretch_rows(unit), SPAN + ", anchor int, core long, whole long"
    )
    found = stored(found, "stretches")
    # Stored, so that both sides of the join have fresh exchanges and a hot core can be split.
    cores = stored(found.groupBy("core").count().where("count > 1").select("core"), "cores")
    shared = stored(found.join(cores, "core", "left_semi"), "shared-cores")

    place = F.struct("k1", "k2", "first", "last", "anchor")
    kinds = shared.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(place).alias("at"))
    kinds = stored(kinds, "stretch-kinds")
    copies = shared.join(kinds.where("n > 1").select("core", "whole"), ["core", "whole"], "left_semi")

    mixed = kinds.groupBy("core").agg(F.count("*").alias("m")).where("m > 1")
    edges = kinds.join(stored(mixed, "mixed-cores", few=True), "core").select(
        "at.k1", "at.k2",
        F.struct("at.first", "at.last", "at.anchor", "core",
                 (F.col("n") == 1).alias("single"), (F.col("m") > crowd).alias("crowded"))
        .alias("stretch"),
    )
    wanted = edges.groupBy("k1", "k2").agg(F.collect_list("stretch").alias("wanted"))
    contexts = docs.join(wanted, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).mapInArrow(
        _fetch(unit),
        "k1 long, k2 long, first int, starts int, left int, core long, single boolean,"
        " crowded boolean, content binary",
    )
    contexts = stored(contexts, "edge-contexts")
    out, width = copies.select("k1", "k2", "first", "last"), unit.reach
    while True:
        usual = contexts.where("not crowded").repartition("core").sortWithinPartitions("core")
        out = out.union(usual.mapInArrow(_resolved(resolve, kind, unit, block), SPAN))
        if contexts.where("crowded").isEmpty():
            return out
        width = max(1, width // FINER)
        again, contexts = _cut_finer(contexts.where("crowded"), unit, kind, width, crowd)
        out = out.union(again)


def _cut_finer(contexts: DataFrame, unit: Unit, kind, width: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """(ranges of windows that repeat, contexts that are still to be told apart) of crowded contexts."""
    parts = stored(
        contexts.mapInArrow(
            _finer_rows(unit, kind, width),
            "k1 long, k2 long, base int, first int, last int, left int, core long, whole long, single boolean",
        ),
        "context-parts",
    )
    cores = stored(parts.groupBy("core").count().where("count > 1").select("core"), "part-cores")
    # A merge join can cut a hot core's rows; after a broadcast they would stay together.
    shared = stored(parts.join(cores.hint("merge"), "core", "left_semi"), "shared-parts")
    place = F.struct("k1", "k2", "base", "first", "last", "left", "single")
    kinds = shared.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(place).alias("at"))
    kinds = stored(kinds, "part-kinds")
    twice = kinds.where("n > 1").select("core", "whole").hint("merge")
    copies = shared.where("single").join(twice, ["core", "whole"], "left_semi").select("k1", "k2", "first", "last")
    mixed = kinds.groupBy("core").agg(F.count("*").alias("m")).where("m > 1")
    wanted = kinds.join(stored(mixed, "mixed-parts", few=True), "core").select(
        "at.k1", "at.k2", "at.base",
        F.struct("at.first", "at.last", "at.left", "core",
                 (F.col("at.single") & (F.col("n") == 1)).alias("single"),
                 (F.lit(width > 1) & (F.col("m") > crowd)).alias("crowded")).alias("part"),
    ).groupBy("k1", "k2", "base").agg(F.collect_list("part").alias("wanted"))
    # A context has no more parts than windows.
    held = contexts.select("k1", "k2", F.col("first").alias("base"), "core", "content")
    rows = held.join(wanted, ["k1", "k2", "base"]).dropDuplicates(["k1", "k2", "base"])
    return copies, stored(
        rows.select("k1", "k2", "base", "content", "wanted").mapInArrow(
            _slice(unit, kind),
            "k1 long, k2 long, first int, starts int, left int, core long, single boolean,"
            " crowded boolean, content binary",
        ),
        "part-contexts",
    )


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text`` and the key of each row."""
    k1, k2 = row_key(F.col("id"), F.col("text"))
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select(
        k1.alias("k1"), k2.alias("k2"), "id", "text"
    )


def with_ranges(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Each row with the list ``spans`` of its ranges (null if it has none)."""
    lists = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    return rows.join(lists, ["k1", "k2"], "left")


def merged(spans: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """Token ranges (begin, end) covered by windows starting in the given ranges, joined."""
    out: list[list[int]] = []
    for s in sorted(spans or [], key=lambda x: (x["first"], x["last"])):
        if out and s["first"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["last"] + size)
        else:
            out.append([s["first"], s["last"] + size])
    return [(a, b) for a, b in out]
