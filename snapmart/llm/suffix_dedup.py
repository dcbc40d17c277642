"""Removal of repeated byte strings by prefix-free parsing and suffix arrays.

Rolling-hash triggers cut the text into phrases. A suffix of the text is a suffix of a phrase (the
dictionary part) and what follows the next trigger (the parse part). Per shard the suffixes of the
dictionary phrases are sorted, the parse suffixes are sorted, and both ranks together give the
corpus order of all suffixes of the shard; neighbours in that order tell which strings repeat.

Shards are made by content (``repeats.py``): suffixes that agree on ``length`` bytes share the bytes
around their trigger and so the shard, and only the repetitive part of the corpus gets there, one
copy of each context. That is what keeps the arrays short: they are built per block of a shard and
never for a whole corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from snapmart.llm.common import documents, utf8
from snapmart.llm.repeats import (
    Unit, byte_tokens, keyed, merged, repeated_windows, unpack, with_ranges,
)

LENGTH = 400
REACH = 200


def _strings(data: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Slices as fixed-width byte strings, padded with the value 0 that no token has."""
    width = int(lengths.max(initial=0)) or 1
    padded = np.concatenate([data, np.zeros(width, dtype=np.uint8)])
    grid = np.lib.stride_tricks.sliding_window_view(padded, width)[at]
    grid[np.arange(width) >= lengths[:, None]] = 0
    return grid


def _order(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the rows and the common prefix of each with the one before it."""
    order = np.argsort(np.ascontiguousarray(grid).view(f"S{grid.shape[1]}").ravel(), kind="stable")
    differ = grid[order[1:]] != grid[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), grid.shape[1])
    return order, np.concatenate([[0], common])


class _RangeMin:
    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (half := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[: len(last) - half], last[half:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest of values[low : high] for each pair; high > low."""
        out = np.empty(len(low), dtype=self.levels[0].dtype)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = level == k
            table = self.levels[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        return out


def suffix_order_repeats(content, core, left, starts, size: int) -> np.ndarray:
    """For each window start of each context, does its window start in another context too?

    content: tokens from the first start to the end of the last window; left: tokens before the
    trigger; starts: how many windows begin here.
    """
    data, counts = unpack(content, np.uint8)
    begin = np.cumsum(counts) - counts
    core_id = np.unique(core, return_inverse=True)[1]

    # Parse suffixes: what follows the trigger, in order, with common prefixes of neighbours.
    tail = counts - left
    order, common = _order(_strings(data, begin + left, tail))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    least = _RangeMin(common.astype(np.int64))
    # Dictionary suffixes: the part of the phrase before the trigger, in order, equal ones alike.
    owner = np.repeat(np.arange(len(starts)), starts)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    ahead = left[owner] - step
    grid = _strings(data, begin[owner] + step, ahead)
    order, common = _order(grid)
    same = (ahead[order[1:]] == ahead[order[:-1]]) & (common[1:] >= ahead[order[1:]])
    phrase = np.empty(len(owner), dtype=np.int64)
    phrase[order] = np.concatenate([[0], np.cumsum(~same)])

    # Corpus order: by dictionary suffix, then by parse suffix.
    order = np.lexsort((rank[owner], phrase, core_id[owner]))
    a, b = order[:-1], order[1:]
    near = (phrase[a] == phrase[b]) & (core_id[owner[a]] == core_id[owner[b]])
    ra, rb = rank[owner[a[near]]], rank[owner[b[near]]]
    shared = least(ra + 1, rb + 1) if len(ra) else np.zeros(0, dtype=np.int64)
    # A context that ends is padded; its padding must not count as agreement.
    shared = np.minimum(shared, np.minimum(tail[owner[a[near]]], tail[owner[b[near]]]))
    agree = ahead[a[near]] + shared >= size
    repeated = np.zeros(len(owner), dtype=bool)
    repeated[a[near][agree]] = True
    repeated[b[near][agree]] = True
    return repeated


def repeated_bytes(docs: DataFrame, length: int = LENGTH, reach: int = REACH, crowd: int = 256):
    """Ranges of starts of ``length``-byte strings that start at more than one place.

    ``docs`` has k1, k2, text; returns k1, k2, first, last.
    """
    unit = Unit(length, min(reach, length // 2), 8, byte_tokens)
    return repeated_windows(docs, unit, suffix_order_repeats, crowd)


def _cut(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            spans_of = batch.column("spans").to_pylist()
            for text, spans in zip(utf8(batch.column("text")), spans_of, strict=True):
                spans = merged(spans, length)
                kept, at = [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]]) if spans else text
                rows.append((len(text), len(text) - len(kept), len(spans), kept, spans))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.record_batch(
                [batch.column("id"), pa.array(columns[0], pa.int64()),
                 pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in columns[3]], pa.string()),
                 pa.array([[{"begin": a, "end": b} for a, b in s] for s in columns[4]],
                          pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array(columns[3], pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"],
            )

    return cut


def remove_repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    crowd: int = 256,
) -> DataFrame:
    """One row per document without every byte that a repeated ``length``-byte string covers.

    Returns the id, n_bytes, n_removed, n_spans, kept_sha256, spans (byte ranges removed) and kept
    (the remaining bytes; a cut may fall inside a character). Strings are judged on the input;
    overlapping occurrences count. A null text is an empty one, an empty text has no strings, a row
    that is there twice repeats itself, null ids are kept, other columns are not looked at, and an
    empty table gives an empty result.
    """
    rows = keyed(docs, id_col, text_col)
    spans = repeated_bytes(rows.select("k1", "k2", "text"), length, crowd=crowd)
    id_type = docs.schema[id_col].dataType.simpleString()
    out = with_ranges(rows, spans).mapInArrow(
        _cut(length),
        f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
        " spans array<struct<begin: long, end: long>>, kept binary",
    )
    return out.withColumnRenamed("id", id_col)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
