"""Packing documents into sequences of a fixed number of tokens by the sum-of-squares rule.

A document's tokens end with an end mark. Longer ones than a sequence are cut into whole sequences
and one shorter piece in front. A piece goes into the open sequence after which the sum, over the
residual gaps, of the squared numbers of open sequences with that gap is smallest; a new sequence is
opened if it fits in none. Pieces come longest first, which leaves fewer sequences than any order
tried. Groups of about ``group_rows`` pieces, dealt by hash, are packed side by side, so the work
is linear and no task sees more than a group; each group may leave a few sequences unfilled.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import documents, stored

TOKENS = 1024
END = 2
GROUP_ROWS = 10_000

_encodings: dict[str, object] = {}


def vocabulary() -> str:
    """Ranks of the byte-level BPE vocabulary of 50,257 ids (the same ids as its JSON form)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoding(path: str):
    """The encoder of a file of ranks, built once in each worker.

    Tokens that the JSON form beside the file adds, as ``<|endoftext|>``, are its special tokens.
    """
    if path not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        form, added = Path(path).with_suffix(".json"), {}
        if form.exists():
            tokens = json.loads(form.read_text(encoding="utf-8"))["added_tokens"]
            added = {t["content"]: t["id"] for t in tokens}
        _encodings[path] = tiktoken.Encoding(
            "bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
    return _encodings[path]


def cut(length: int, tokens: int = TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    first = length % tokens or tokens
    if length <= tokens:
        return [(0, length)]
    return [(0, first), *((at, tokens) for at in range(first, length, tokens))]


def _pieces(tokens: int, end: int, path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The added tokens are recognised in texts, as by the JSON form.
        encode = partial(encoding(path).encode, allowed_special="all")
        for batch in batches:
            texts = batch.column("text")
            for low in range(0, batch.num_rows, 500):
                rows = []
                for i in range(low, min(low + 500, batch.num_rows)):
                    ids = np.array(encode(texts[i].as_py() or "") + [end], dtype="<u4")
                    for number, (start, length) in enumerate(cut(len(ids), tokens)):
                        data = ids[start : start + length].tobytes()
                        rows.append((i, number, start, length, zlib.crc32(data), data))
                doc, number, start, length, crc, data = zip(*rows, strict=True)
                yield pa.record_batch(
                    [batch.column("id").take(pa.array(doc)), pa.array(doc, pa.int64()),
                     pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                     pa.array(data if with_ids else [None] * len(data), pa.binary())],
                    names=["id", "salt", "piece", "start", "length", "ids_crc32", "ids"],
                )

    return run


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: int = TOKENS,
    end: int = END, path: str | None = None, with_ids: bool = True,
) -> DataFrame:
    """id, salt, piece, start, length, ids_crc32 and ids (little-endian 32-bit) of every piece.

    ``salt`` tells equal rows of one batch apart. A null or empty text is one piece, the end mark.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(
        _pieces(tokens, end, path or vocabulary(), with_ids),
        f"id {kind}, salt long, piece int, start long, length long, ids_crc32 long, ids binary",
    )


def sum_of_squares(lengths: np.ndarray, tokens: int = TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, taken in the given order."""
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    # The count of gap 0, full sequences, is never used: they are closed.
    counts = np.zeros(tokens + 1, dtype=np.int64)
    open_: list[list[int]] = [[] for _ in range(tokens + 1)]
    used = 0
    never = np.iinfo(np.int64).max
    for i, size in enumerate(lengths.tolist()):
        gaps = counts[size:tokens]
        # Half the change of the sum: the gap loses one sequence, the smaller gap wins one.
        change = np.where(gaps > 0, 2 * (counts[: tokens - size] - gaps) + 2, never)
        if len(change) and gaps[0]:
            change[0] = 1 - 2 * gaps[0]
        best = int(change.argmin()) if len(change) else -1
        if best < 0 or change[best] == never:
            sequence[i], gap, used = used, tokens, used + 1
        else:
            gap = size + best
            sequence[i] = open_[gap].pop()
            counts[gap] -= 1
        offset[i] = tokens - gap
        if gap > size:
            open_[gap - size].append(int(sequence[i]))
            counts[gap - size] += 1
    return sequence, offset


def _packed(tokens: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("length", "descending"), ("order", "ascending"), ("piece", "ascending"), ("salt", "ascending")]
        )
        lengths = np.asarray(table["length"])
        group = np.asarray(table["group"])
        whole = int((lengths >= tokens).sum())
        sequence = np.arange(len(lengths))
        offset = np.zeros(len(lengths), dtype=np.int64)
        sequence[whole:], offset[whole:] = sum_of_squares(lengths[whole:], tokens)
        sequence[whole:] += whole
        return table.append_column("sequence_id", pa.array((group << 32) + sequence)).append_column(
            "offset", pa.array(offset)
        )

    return run


def pack(placed: DataFrame, tokens: int = TOKENS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``placed`` (a stored table of pieces) with sequence_id and offset."""
    groups = max(1, -(-placed.count() // group_rows))
    dealt = placed.withColumn("order", F.xxhash64("id", "ids_crc32", "start", "salt")).withColumn(
        "group", F.pmod(F.xxhash64("order", "piece"), F.lit(groups))
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return dealt.groupBy("group").applyInArrow(
        _packed(tokens), f"{kinds}, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: int = TOKENS,
    end: int = END, path: str | None = None, with_ids: bool = False, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: the id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    A document's pieces are numbered from 0; start counts its tokens before the piece; offset is
    the piece's place in its sequence, without gaps from 0. ``ids`` is null unless ``with_ids``.
    A null or empty text is the end mark alone; equal rows are packed one by one; null ids are
    kept; other columns are not looked at; an empty table gives an empty result.
    """
    found = stored(pieces(docs, id_col, text_col, tokens, end, path, with_ids), "pieces")
    packed = pack(found, tokens, group_rows)
    return packed.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "ids", "sequence_id",
        "offset",
    )


def sequences(docs: DataFrame, **how) -> DataFrame:
    """sequence_id, length and ids (little-endian 32-bit) of each packed sequence."""
    rows = pack_documents(docs, with_ids=True, **how)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda out, p: F.concat(out, p["ids"]))
    return rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir)).drop("ids")
