"""Archives: written and read back, cut at every place, and archives of other makers."""

import base64
import gzip
import hashlib
import random
from collections import Counter
from pathlib import Path

import pytest

from snapmart.llm import warc

COLUMNS = "page_id long, url string, html string, id string, first string, sha1 string, payload string"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def pages() -> list[tuple]:
    rng = random.Random(1)
    rest = ("a", "b", "c", "d")
    rows = [(i, f"http://x.example/{i}", "".join(rng.choices("abc <p>é\r\n", k=rng.randint(0, 900))), *rest) for i in range(60)]
    rows += [(100 + i, "http://x.example/same", "the same page", *rest) for i in range(40)]
    rows += [(7, None, "the same page", *rest), (300, "http://x/\r\nWARC-Type: x y", None, *rest), (301, "é", "", *rest),
             (None, "u", "the same page", *rest), (None, "u", "only here", *rest), (None, "u", "only here", *rest),
             (400, "long", "".join(rng.choices("0123456789", k=300_000)), *rest), rows[3], rows[3]]
    return rows


def plain(rows, least: int = 0) -> Counter:
    first: dict = {}
    for r in rows:
        html = r[2] or ""
        if r[0] is not None and (html not in first or first[html] > r[0]):
            first[html] = r[0]
    out = Counter()
    for r in rows:
        data = (r[2] or "").encode()
        known = first.get(r[2] or "")
        again = len(data) >= least and known is not None and r[0] != known
        out[r[0], len(data), digest(data), "revisit" if again else "response", known if again else None] += 1
    return out


def number(record_id):
    return int(record_id[len(warc.ID) + 1 : -1]) if record_id and len(record_id) > len(warc.ID) + 2 else None


def found(df) -> Counter:
    rows = [r for r in df.collect() if r["record_type"] in ("response", "revisit")]
    return Counter((number(r["record_id"]), r["payload_bytes"], r["payload_digest"][5:], r["record_type"], number(r["refers_to"])) for r in rows)


def cut(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture(autouse=True)
def splits(spark):
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("least", [0, 14])
def test_round_trip(spark, path, least):
    rows = pages()
    warc.write_warc(spark.createDataFrame(rows, COLUMNS).repartition(3), f"{path}/w", least_bytes=least)
    for size in (64 << 20, 3000):
        cut(spark, size)
        df = warc.read_warc(spark, f"{path}/w")
        assert found(df) == plain(rows, least)
    read = {number(r["record_id"]): r for r in df.where("record_type = 'response'").collect()}
    for r in rows[:60] + [r for r in rows if r[0] == 400]:
        if r[0] in read and r[0] != 7:  # two pages have this id
            assert read[r[0]]["payload"] == r[2].encode()
            assert read[r[0]]["target_uri"] == r[1]
    if least:  # the empty pages are responses
        assert read[300]["target_uri"] == "http://x/%0D%0AWARC-Type:%20x%20y"


def test_files_are_plain_gzip_members(spark, path):
    warc.write_warc(spark.createDataFrame(pages(), COLUMNS).coalesce(1), f"{path}/w")
    (file,) = Path(f"{path}/w").glob("part-*")
    data = gzip.decompress(file.read_bytes())
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and data.endswith(b"\r\n\r\n")
    assert len(list(warc.records(data))) == len(pages()) + 1


def test_members_of_any_length_end_the_same_way():
    for data in (b"", b"x", bytes(1 << 24), bytes((1 << 24) + 5)):
        row = warc._row(data) + b"\0"
        assert gzip.decompress(row) == data


def archive(blocks: list[bytes], level: int = 0) -> bytes:
    """A member per block; level 0 stores bytes as they are."""
    return b"".join(
        gzip.compress(warc.record([("WARC-Type", "resource"), ("WARC-Record-ID", f"<urn:{i}>")], b), level, mtime=0)
        for i, b in enumerate(blocks)
    )


def false_starts(seed: int) -> list[bytes]:
    """Blocks full of what looks like the start of a member."""
    rng = random.Random(seed)
    tricks = [warc.MAGIC, warc.MAGIC + b"\0" * 7, gzip.compress(b"no header", mtime=0), warc.MAGIC + b"\xff", b"\x1f\x8b", warc.EMPTY]
    return [b"".join(rng.choice(tricks) + rng.randbytes(rng.randint(0, 40)) for _ in range(rng.randint(0, 30))) for _ in range(16)]


@pytest.mark.parametrize("size", [101, 500, 4096])
def test_magic_inside_members(spark, path, size):
    """Chance magic is no record, whatever range it falls in, and members may span many ranges."""
    blocks = false_starts(size)
    Path(f"{path}/a.warc").write_bytes(archive(blocks))
    Path(f"{path}/b.warc").write_bytes(archive(blocks[:3], 9) + b"\0" * 9 + archive(blocks[3:5]))
    cut(spark, size)
    rows = warc.read_warc(spark, path).collect()
    assert Counter(bytes(r["payload"]) for r in rows) == Counter(blocks + blocks[:5])
    assert rows[0]["headers"]["warc-type"] == "resource"


def test_damage_fails_the_job_or_is_left_out(spark, path):
    blocks = [b"one" * 50, b"two" * 50, b"three" * 50]
    whole = archive(blocks, 9)
    Path(f"{path}/a.warc").write_bytes(whole[:-20])
    with pytest.raises(Exception, match="a member that does not end"):
        warc.read_warc(spark, path).collect()
    kept = warc.read_warc(spark, path, damaged="skip").collect()
    assert [bytes(r["payload"]) for r in kept] == blocks[:2]
    with pytest.raises(ValueError, match="damaged"):
        warc.read_warc(spark, path, damaged="maybe")


def test_wrong_digests_are_found(spark, path):
    bad = warc.record([("WARC-Type", "resource"), ("WARC-Payload-Digest", "sha1:" + digest(b"other"))], b"this")
    Path(f"{path}/a.warc").write_bytes(gzip.compress(bad))
    with pytest.raises(Exception, match="not that of its digest"):
        warc.read_warc(spark, path).collect()
    assert warc.read_warc(spark, path, damaged="skip").count() == 0


def test_several_records_in_a_member_and_no_payload(spark, path):
    two = warc.record([("WARC-Type", "a")], b"x") + warc.record([("WARC-Type", "b")], b"")
    Path(f"{path}/a.warc").write_bytes(gzip.compress(two))
    rows = warc.read_warc(spark, path, content=False).collect()
    assert [(r["record_type"], r["payload_bytes"], r["payload"]) for r in rows] == [("a", 1, None), ("b", 0, None)]


def test_binary_payloads_and_empty_tables(spark, path):
    rows = [(1, "u", bytearray(range(256)) * 9), (2, "u", None), (3, "v", bytearray(range(256)) * 9)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html binary"), f"{path}/w")
    read = {number(r["record_id"]): r for r in warc.read_warc(spark, f"{path}/w").where("record_type <> 'warcinfo'").collect()}
    assert bytes(read[1]["payload"]) == bytes(rows[0][2]) and read[2]["payload_bytes"] == 0
    assert (number(read[3]["refers_to"]), read[3]["payload"], read[3]["payload_bytes"]) == (1, None, 2304)
    warc.write_warc(spark.createDataFrame([], COLUMNS), f"{path}/e")
    assert warc.read_warc(spark, f"{path}/e").count() == 0
