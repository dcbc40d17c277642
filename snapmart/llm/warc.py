"""WARC archives: one compressed record per page, and a reader that splits files by byte ranges.

Writing: a record is a gzip member of its own. Equal payloads are told by size and SHA-1; the page
with the smallest id is a response, the others are revisits that refer to it. Members go through
Spark's text writer, so any file system, its commits and lost executors are taken care of. That writer
ends each row with a separator, so the separator is the byte 0 that a member under 16 MB ends with
anyway, taken off before; a longer one is followed by an empty member, which ends so too. The files are
plain concatenated gzip members.

Reading: Spark deals byte ranges of the files to tasks, and its text reader scans each range for the
gzip magic and hands over what lies from one magic to the next, whole, to the range it starts in. Magic
may turn up inside a member by chance, so a task decodes: a member that is not at its end goes on after
the next magic, and the first ones of a range that do not decode to WARC headers belong to a member of a
range before. Such pieces, one for many millions of bytes, are put together in a second step by file
and place. Files must not be named .gz, or Spark would unpack each in one task.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
GZIP = 31  # zlib's window and wrapper for gzip
ID = "urn:x-page:"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
BATCH_BYTES = 8_000_000
RECORD = (
    "record_type string, record_id string, refers_to string, target_uri string, date string,"
    " payload_digest string, payload_bytes long, payload binary, headers map<string,string>"
)


# Records. -------------------------------------------------------------------------------------


def member(data: bytes) -> bytes:
    """``data`` as one gzip member."""
    pack = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return pack.compress(data) + pack.flush()


EMPTY = member(b"")


def _row(data: bytes) -> bytes:
    """A member less the byte 0 that the writer ends each row with."""
    packed = member(data)
    return packed[:-1] if packed[-1] == 0 else packed + EMPTY[:-1]


def _uri(text: str) -> str:
    """Without the characters that would end a header."""
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", text)


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A WARC record; fields without a value are left out."""
    lines = [f"{n}: {v}" for n, v in [*fields, ("Content-Length", str(len(block)))] if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def record_id(id_: object) -> str:
    return f"<{ID}{urllib.parse.quote('' if id_ is None else str(id_), safe='')}>"


def page_record(
    id_: object, url: str | None, payload: bytes, digest: str, first: object, revisit: bool, date: str = DATE
) -> bytes:
    """The record of a page; a revisit has the headers of its response but not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(id_)),
        ("WARC-Date", date), ("WARC-Target-URI", None if url is None else _uri(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", record_id(first) if revisit else None),
        ("WARC-Profile", PROFILE if revisit else None), ("Content-Type", HTTP),
    ]
    return record(fields, head.encode() + (b"" if revisit else payload))


# Writing. -------------------------------------------------------------------------------------


def _members(date: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A member per page, after one that describes the file."""
    described = False
    for batch in batches:
        out, held = [], 0
        for row in zip(*(batch.column(c) for c in ("id", "url", "payload", "sha1", "first", "revisit")), strict=True):
            id_, url, payload, sha1, first, revisit = (x.as_py() for x in row)
            if not described:
                name = uuid.uuid5(uuid.NAMESPACE_URL, f"{record_id(id_)}{sha1}")
                fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{name}>"),
                          ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
                out.append(_row(record(fields, b"format: WARC File Format 1.1\r\n")))
                described = True
            digest = base64.b32encode(bytes.fromhex(sha1)).decode()
            out.append(_row(page_record(id_, url, payload, digest, first, revisit, date)))
            held += len(out[-1])
            if held > BATCH_BYTES:
                yield pa.record_batch([pa.array(out, pa.binary())], names=["member"])
                out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(out, pa.binary())], names=["member"])


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = 0, date: str = DATE,
) -> None:
    """Write a record per row into new archives in the folder ``path``.

    Of equal payloads of at least ``least_bytes`` bytes the rows with the smallest id are responses,
    the others revisits of it; smaller payloads are all responses. A null payload is empty. A null id
    is no smallest one unless there is no other, and an empty record id; rows of one id have one
    record id. A null url is left out; control characters and spaces in one are escaped. Other columns
    are not looked at; an empty table gives archives without records.
    """
    payload = F.coalesce(pages[payload_col].cast("string"), F.lit("")).cast("binary")
    if dict(pages.dtypes)[payload_col] == "binary":
        payload = F.coalesce(pages[payload_col], F.lit(b""))
    rows = pages.select(
        pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"sha1": F.sha1("payload"), "n": F.octet_length("payload")})
    # One narrow row per payload that is there again: counted before the shuffle, however often.
    repeated = rows.groupBy("sha1", "n").agg(F.count("*").alias("copies"), F.min("id").alias("first"))
    repeated = repeated.where((F.col("copies") > 1) & (F.col("n") >= least_bytes))
    known = rows.join(repeated.select("sha1", "n", "first", F.lit(True).alias("again")), ["sha1", "n"], "left")
    revisit = F.coalesce("again", F.lit(False)) & ~F.col("id").eqNullSafe(F.col("first"))
    members = known.select("id", "url", "payload", "sha1", "first", revisit.alias("revisit")).mapInArrow(
        partial(_members, date), "member binary"
    )
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


# Reading. -------------------------------------------------------------------------------------


class Damaged(ValueError):
    """Bytes that are no whole WARC record where one must be."""


@dataclass
class Member:
    """A gzip member that is decoded piece by piece."""

    pieces: list[bytes] = field(default_factory=list)
    data: bytearray = field(default_factory=bytearray)
    unpack: object = field(default_factory=lambda: zlib.decompressobj(GZIP))

    def feed(self, piece: bytes) -> bool:
        """Take what follows a magic, or the magic that starts the member; false if it cannot be."""
        self.pieces.append(piece)
        try:
            self.data += self.unpack.decompress(MAGIC + piece)
        except zlib.error:
            return False
        start = bytes(self.data[:5])
        if self.unpack.unused_data.strip(b"\0"):
            return False
        return b"WARC/".startswith(start) if len(start) < 5 and not self.whole else start in (b"WARC/", b"")

    @property
    def whole(self) -> bool:
        return self.unpack.eof


def _http(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    return _fields(head), body


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; of repeated ones the first; folded lines are joined."""
    found: dict[str, str] = {}
    for line in re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")[1:]:
        name, mark, value = line.partition(b":")
        if mark:
            found.setdefault(name.strip().decode("utf-8", "replace").lower(), value.strip().decode("utf-8", "replace"))
    return found


def records(data: bytes, content: bool = True) -> Iterator[tuple]:
    """The records in the bytes of a member, as RECORD has them."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise Damaged("no WARC header")
        fields = _fields(data[at:end])
        length = fields.get("content-length", "")
        if not re.fullmatch("[0-9]+", length):
            raise Damaged("a record without its length")
        block = data[end + 4 : (at := end + 4 + int(length))]
        if data[at : at + 4] != b"\r\n\r\n":
            raise Damaged("a record shorter than it says")
        at += 4
        kind, payload, size = fields.get("warc-type"), block, len(block)
        if fields.get("content-type", "").lower().startswith("application/http"):
            http, payload = _http(block)
            size = len(payload)
            if kind == "revisit":
                told = http.get("content-length", "")
                payload, size = None, int(told) if re.fullmatch("[0-9]+", told) else None
        digest = fields.get("warc-payload-digest")
        if payload is not None and digest is not None and digest.lower().startswith("sha1:"):
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest[5:].upper():
                raise Damaged(f"the payload of {fields.get('warc-record-id')} is not that of its digest")
        yield (
            kind, fields.get("warc-record-id"), fields.get("warc-refers-to"), fields.get("warc-target-uri"),
            fields.get("warc-date"), digest, size, payload if content else None, list(fields.items()),
        )


_TYPES = [pa.string()] * 6 + [pa.int64(), pa.binary(), pa.map_(pa.string(), pa.string())]
_NAMES = [c.split()[0] for c in RECORD.split(", ")]


def _emit(found: list[tuple], left: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Records, and pieces left over as (path, start, number, opens, piece)."""
    n, m = len(found), len(left)
    if n + m:
        columns = [pa.array([*(r[i] for r in found), *([None] * m)], t) for i, t in enumerate(_TYPES)]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        columns += [pa.array([*([None] * n), *(r[i] for r in left)], t) for i, t in enumerate(kinds)]
        yield pa.record_batch(columns, names=[*_NAMES, "path", "start", "number", "opens", "piece"])


class Range:
    """The records that start in one byte range of a file."""

    def __init__(self, path: str, start: int, content: bool, skip: bool):
        self.path, self.start, self.content, self.skip = path, start, content, skip
        self.open: Member | None = None
        self.settled = start == 0  # a start of a member is known, so what follows is too
        self.first, self.number = True, 0
        self.found: list[tuple] = []
        self.left: list[tuple] = []

    def damaged(self, why: str) -> None:
        if not self.skip:
            raise Damaged(f"{self.path}, from byte {self.start}: {why}")

    def add(self, piece: bytes) -> None:
        if self.first and self.start == 0:
            self.first = False
            if piece.strip(b"\0"):
                self.damaged("it does not start with a gzip member")
            return
        waiting = [piece]
        while waiting:
            piece = waiting.pop(0)
            now = self.open or Member()
            good, self.open = now.feed(piece), None
            if not good:
                if self.settled:
                    self.damaged("a member that does not decode")
                else:
                    # Not a start: it belongs to a member of a range before.
                    self._leave([now.pieces[0]], opens=False)
                waiting = [*now.pieces[1:], *waiting]
            elif not now.whole:
                self.open = now
            elif not (now.data or self.settled):
                # An empty member has no header to tell it by; it may stand inside another.
                self._leave(now.pieces, opens=False)
            else:
                self.settled = True
                self.take(now)

    def take(self, whole: Member) -> None:
        try:
            self.found += records(bytes(whole.data), self.content)
        except Damaged as why:
            self.damaged(str(why))

    def _leave(self, pieces: list[bytes], opens: bool) -> None:
        for piece in pieces:
            self.left.append((self.path, self.start, self.number, opens, piece))
            self.number, opens = self.number + 1, False

    def close(self) -> None:
        if self.open:
            # With no header seen yet it may be a start or go on with a member of a range before.
            self._leave(self.open.pieces, opens=self.settled or len(self.open.data) >= 5)
            self.open = None


def _scan(content: bool, skip: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges come one after the other, each in order."""
    now, held = None, 0
    for batch in batches:
        for piece, path, start in zip(*(batch.column(c) for c in ("piece", "path", "start")), strict=True):
            place, data = (path.as_py(), start.as_py()), piece.as_py()
            if now is None or (now.path, now.start) != place:
                if now is not None:
                    now.close()
                    yield from _emit(now.found, now.left)
                now, held = Range(*place, content, skip), 0
            now.add(data)
            held += len(data)
            if held > BATCH_BYTES:
                yield from _emit(now.found, now.left)
                now.found, now.left, held = [], [], 0
    if now is not None:
        now.close()
        yield from _emit(now.found, now.left)


def _stitch(content: bool, skip: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of several ranges; the pieces come sorted by file and place."""
    now = Range("", 0, content, skip)

    def close() -> None:
        if now.open:
            now.damaged("a member that does not end")
            now.open = None

    for batch in batches:
        for path, opens, piece in zip(*(batch.column(c).to_pylist() for c in ("path", "opens", "piece")), strict=True):
            if opens or now.path != path:
                close()
            now.path, now.first = path, False
            now.add(piece)
        yield from _emit(now.found, [])
        now.found = []
    close()


def read_warc(spark: SparkSession, path: str, content: bool = True, damaged: str = "fail") -> DataFrame:
    """The records of the archives in ``path``, as RECORD has them.

    payload is what follows the HTTP headers of a response, null for a revisit, the whole block for
    other types; payload_bytes is its size, for a revisit the one its HTTP headers tell. ``content``
    false leaves payload null. Payloads are compared with their SHA-1 digests. Members may hold several
    records, and zeros may stand between them. What is no whole record fails the job, or is left out with
    ``damaged='skip'``; so does an archive stored within a member if a range starts in it.
    """
    if damaged not in ("fail", "skip"):
        raise ValueError("damaged is fail or skip")
    lines = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    pieces = lines.select(
        F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    skip = damaged == "skip"
    scheme = f"{RECORD}, path string, start long, number long, opens boolean, piece binary"
    scanned = pieces.mapInArrow(partial(_scan, content, skip), scheme)
    # The archives are scanned again for the few pieces left over, rather than written once more.
    left = scanned.where("path IS NOT NULL").select("path", "start", "number", "opens", "piece")
    joined = left.repartition("path").sortWithinPartitions("path", "start", "number").mapInArrow(
        partial(_stitch, content, skip), scheme
    )
    return scanned.where("path IS NULL").union(joined).select(*_NAMES)


def op12_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    pages = read_warc(spark, path, content=False).where(F.col("record_type").isin("response", "revisit"))

    def page(name: str):
        return F.expr(f"try_cast(substring({name}, {len(ID) + 2}, length({name}) - {len(ID) + 2}) AS long)")

    return pages.select(
        page("record_id").alias("page_id"), "payload_bytes",
        F.expr("substring(payload_digest, 6)").alias("payload_digest"), "record_type",
        page("refers_to").alias("refers_to"), "target_uri",
    )


OP12_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
d AS (
  SELECT page_id, url, strlen(h) AS n, sha1(h) AS hex, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST(concat('0x', substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5)) AS BIGINT)
      >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to,
  url AS target_uri
FROM d"""
