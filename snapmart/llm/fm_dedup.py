"""Removal of repeated word windows with an FM-index per shard.

A shard's index is the Burrows-Wheeler transform of its contexts in a wavelet matrix: bit planes
packed into 64-bit words with a count per word. Documents' contexts are streamed against it:
backward search gives, for an end, how far to the left the text still occurs twice (its matching
statistic), and every window inside a match of at least the window's length repeats.

Contexts reach the shard that holds all texts they could match (``repeats.py``): windows that agree
share the words around their anchor. An index covers a block of a shard, so its size is bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from snapmart.llm.common import documents, utf8
from snapmart.llm.repeats import (
    Unit, keyed, merged, repeated_windows, unpack, with_ranges, word_tokens,
)

WINDOW = 35
REACH = 16


class WaveletMatrix:
    """How often a symbol stands before a place, one packed bit plane per bit of the symbols."""

    def __init__(self, symbols: np.ndarray):
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        self.planes, self.before, self.zeros = [], [], []
        for bit in range(self.bits - 1, -1, -1):
            plane = (symbols >> bit) & 1
            packed = np.packbits(plane.astype(np.uint8), bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            self.planes.append(words)
            counts = np.bitwise_count(words).astype(np.int64)
            self.before.append(np.cumsum(counts) - counts)
            self.zeros.append(len(symbols) - int(plane.sum()))
            symbols = np.concatenate([symbols[plane == 0], symbols[plane == 1]])

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Occurrences of each symbol among those that stand between low and high.

        Returned as a pair (from, to) of places in the last plane's order.
        """
        for k, bit in enumerate(range(self.bits - 1, -1, -1)):
            one = (symbol >> bit) & 1 == 1
            low, high = self._step(k, one, low), self._step(k, one, high)
        return low, high

    def _step(self, k: int, one: np.ndarray, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        ones = self.before[k][word] + np.bitwise_count(self.planes[k][word] & mask)
        return np.where(one, self.zeros[k] + ones, place - ones)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of the text sorted by what follows them, to at least ``depth`` symbols."""
    rank = text.astype(np.int64)
    reached = 1
    while True:
        ahead = np.zeros(len(rank), dtype=np.int64)
        ahead[:-reached] = rank[reached:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + ahead
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
        reached *= 2
        if reached >= min(depth, len(text)) or rank.max() == len(text) - 1:
            return order


class FMIndex:
    def __init__(self, text: np.ndarray, depth: int):
        order = suffix_array(text, depth)
        self.n = len(text)
        self.matrix = WaveletMatrix(text[order - 1])
        # A symbol's occurrences end up side by side in the last plane; their place there.
        zero = np.zeros(int(text.max()) + 1, dtype=np.int64)
        self.base, _ = self.matrix.rank(np.arange(len(zero)), zero, zero)
        counts = np.bincount(text, minlength=len(zero))
        self.smaller = np.cumsum(counts) - counts

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Interval of symbol + match from the interval of each match."""
        low, high = self.matrix.rank(symbol, low, high)
        shift = self.smaller[symbol] - self.base[symbol]
        return low + shift, high + shift


def matching_starts(index: FMIndex, text: np.ndarray, end: np.ndarray, stop: np.ndarray):
    """Leftmost place p >= stop such that text[p : end] occurs at least twice, for each end."""
    at = end.copy()
    live = np.flatnonzero(at > stop)
    low, high = np.zeros(len(end), dtype=np.int64), np.full(len(end), index.n)
    while len(live):
        a, b = index.extend(text[at[live] - 1], low[live], high[live])
        good = b - a >= 2
        live = live[good]
        low[live], high[live] = a[good], b[good]
        at[live] -= 1
        live = live[at[live] > stop[live]]
    return at


def fm_repeats(content, core, left, starts, size: int) -> np.ndarray:
    """For each window start of each context, does its window occur in another context too?"""
    data, counts = unpack(content, np.uint64)
    words, ids = np.unique(data, return_inverse=True)
    # A separator, 0, behind every context.
    begin = np.cumsum(counts + 1) - counts - 1
    text = np.zeros(len(data) + len(counts), dtype=np.int64)
    place = np.arange(len(data)) + np.repeat(np.arange(len(counts)), counts)
    text[place] = ids + 1
    index = FMIndex(text, size + 1)

    owner = np.repeat(np.arange(len(starts)), starts)
    offset = np.cumsum(starts) - starts
    repeated = np.zeros(len(owner), dtype=bool)
    # No window reaches to the left of a place where the common part stops occurring twice.
    bound = matching_starts(index, text, begin + size, begin) - begin
    current = starts.astype(np.int64) - 1
    live = np.flatnonzero(current >= bound)
    while len(live):
        start = current[live]
        reached = matching_starts(
            index, text, begin[live] + start + size, begin[live] + bound[live]
        ) - begin[live]
        hit = reached <= start
        for context, low, high in zip(live[hit], reached[hit], start[hit], strict=True):
            repeated[offset[context] + low : offset[context] + high + 1] = True
        current[live] = np.where(hit, reached - 1, start - 1)
        live = live[current[live] >= bound[live]]
    return repeated


def repeated_word_windows(
    docs: DataFrame, window: int = WINDOW, reach: int = REACH, crowd: int = 256
) -> DataFrame:
    """Ranges of starts of ``window``-word windows that start at more than one place.

    ``docs`` has k1, k2, text; returns k1, k2, first, last, counted in words.
    """
    unit = Unit(window, min(reach, max(1, window // 2)), min(2, window), word_tokens)
    return repeated_windows(docs, unit, fm_repeats, crowd)


def _keep(window: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            spans_of = batch.column("spans").to_pylist()
            for text, spans in zip(utf8(batch.column("text")), spans_of, strict=True):
                words = text.split()
                spans = merged(spans, window)
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), b" ".join(kept), spans))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.record_batch(
                [batch.column("id"), pa.array(columns[0], pa.int64()),
                 pa.array(columns[1], pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in columns[2]], pa.string()),
                 pa.array([[{"begin": a, "end": b} for a, b in s] for s in columns[3]],
                          pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array([k.decode() for k in columns[2]], pa.string())],
                names=["id", "n_words", "n_removed", "kept_sha256", "spans", "kept"],
            )

    return keep


def remove_repeated_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    crowd: int = 256,
) -> DataFrame:
    """One row per document without every word that a repeated window covers.

    Returns the id, n_words, n_removed, kept_sha256, spans (word ranges removed) and kept (the kept
    words joined by one space). Windows are judged on the input and never cross documents. A null
    text has no words, documents shorter than a window keep all words, a row that is there twice
    repeats itself, null ids are kept, other columns are not looked at, and an empty table gives an
    empty result.
    """
    rows = keyed(docs, id_col, text_col)
    spans = repeated_word_windows(rows.select("k1", "k2", "text"), window, crowd=crowd)
    id_type = docs.schema[id_col].dataType.simpleString()
    out = with_ranges(rows, spans).mapInArrow(
        _keep(window),
        f"id {id_type}, n_words long, n_removed long, kept_sha256 string,"
        " spans array<struct<begin: long, end: long>>, kept string",
    )
    return out.withColumnRenamed("id", id_col)


def op6_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )
