"""Several writers, versions, change feeds, compaction."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.operators import merge as M
from snapmart.tables import changes, compact, store, versions
from tests.conftest import rows
from tests.test_tables import AT, LONGS, frame, table


def during(monkeypatch, action):
    """Let another writer work between the read and the commit of the next one."""
    real, once = store.commit, []

    def commit(*args, **options):
        if not once:
            once.append(True)
            action()
        return real(*args, **options)

    monkeypatch.setattr(store, "commit", commit)


def test_two_merges_into_one_partition_keep_both_rows(spark, path, monkeypatch):
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0), (1, 2021, 1.0)), t)
    during(monkeypatch, lambda: store.load_merge(frame(spark, (2, 2020, 2.0)), t))
    counts = store.load_merge(frame(spark, (1, 2020, 9.0), (3, 2020, 3.0)), t)
    assert counts == {"inserted": 1, "updated": 1, "unchanged": 1}
    assert rows(store.read_table(spark, t)) == [(1, 2020, 9.0), (1, 2021, 1.0), (2, 2020, 2.0), (3, 2020, 3.0)]
    # the folder of the refused attempt is gone
    used = {f.split("/")[0] for v in versions.versions(spark, t.path) for f in v.folders}
    assert {n for n in os.listdir(t.path) if n.startswith("g=")} == used


def test_merges_into_different_partitions_do_not_meet(spark, path, monkeypatch):
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0), (1, 2021, 1.0)), t)
    during(monkeypatch, lambda: store.load_merge(frame(spark, (2, 2021, 2.0)), t))
    runs, real = [], M.merge_upsert
    store.apply_merge(spark, t, frame(spark, (1, 2020, 9.0)), lambda *a, **o: runs.append(1) or real(*a, **o), key=t.key)
    assert len(runs) == 1  # carried over, not run again
    assert rows(store.read_table(spark, t)) == [(1, 2020, 9.0), (1, 2021, 1.0), (2, 2021, 2.0)]


def test_appends_meet_any_other_write(spark, path, monkeypatch):
    schema = T.StructType([*LONGS.fields]).add("_loaded_at", "timestamp_ntz")
    t = store.Table(f"{path}/raw", schema, ["id", "year"], "year")
    store.load_append(frame(spark, (1, 2020, 1.0)), t, AT)
    during(monkeypatch, lambda: store.load_append(frame(spark, (2, 2020, 1.0)), t, AT))
    store.load_append(frame(spark, (3, 2020, 1.0)), t, AT)
    assert rows(store.read_table(spark, t), "id") == [(1,), (2,), (3,)]


def test_a_writer_that_always_loses_gives_up(spark, path, monkeypatch):
    t = table(path, None)
    store.load_replace(frame(spark, (1, 2020, 1.0)), t)
    real = store.commit

    def commit(*args, **options):
        real(spark, t.path, [], versions.REPLACE, partitions=None)
        real(spark, t.path, store.write(frame(spark, (0, 0, 0.0)), t, store.generation(spark, t)), versions.APPEND)
        return real(*args, **options)

    monkeypatch.setattr(store, "commit", commit)
    with pytest.raises(versions.Conflict):
        store.load_merge(frame(spark, (1, 2020, 2.0)), t)


def test_replace_of_a_known_version(spark, path):
    t = table(path)
    base = store.load_replace(frame(spark, (1, 2020, 1.0)), t)
    store.load_merge(frame(spark, (2, 2020, 1.0)), t)
    with pytest.raises(versions.Conflict, match="changed after version 1"):
        store.load_replace(frame(spark, (3, 2020, 1.0)), t, base)
    assert store.read_table(spark, t, version=1).count() == 1


def test_commits_at_the_same_instant(spark, path):
    """Many threads: every commit gets a number of its own and no folder is lost."""
    def one(i):
        for k in range(5):
            versions.commit(spark, f"{path}/t", [f"g={i}-{k}/year=1"], versions.APPEND)

    threads = [threading.Thread(target=one, args=(i,)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    newest = versions.current(spark, f"{path}/t")
    assert newest.number == 30 and sorted(newest.folders) == sorted(f"g={i}-{k}/year=1" for i in range(6) for k in range(5))
    assert not [n for n in os.listdir(f"{path}/t/{versions.MANIFESTS}") if not n.isdigit() and not n.endswith(".crc")]


def test_expiry_spares_writers_that_have_not_committed(spark, path):
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0)), t)
    store.load_replace(frame(spark, (2, 2020, 1.0)), t)
    for name in ("g=00000009-new", "g=00000009-old", "_stage/new", "_stage/old"):
        os.makedirs(f"{t.path}/{name}")
        if name.endswith("old"):
            os.utime(f"{t.path}/{name}", (time.time() - 30 * 3600,) * 2)
    gone = store.expire_versions(spark, t, keep=1)
    assert len(gone) == 3 and {"g=00000009-old", "_stage/old"} < set(gone)
    assert os.path.exists(f"{t.path}/g=00000009-new") and os.path.exists(f"{t.path}/_stage/new")
    assert rows(store.read_table(spark, t), "id") == [(2,)]


def test_pinned_versions_stay(spark, path):
    t = table(path)
    for i in range(4):
        store.load_replace(frame(spark, (i, 2020, 1.0)), t)
    store.expire_versions(spark, t, keep=1, pinned=[2])
    assert rows(store.read_table(spark, t, version=2), "id") == [(1,)]
    assert versions.numbers(spark, t.path) == [4, 2]


# Repeated keys. -------------------------------------------------------------------------------


def test_later_means_later_by_file_and_place(spark, path):
    """Spark packs large files before small ones; the last file by name wins all the same."""
    os.makedirs(f"{path}/in")
    for name, n, value in (("a", 4000, 1.0), ("b", 1, 2.0), ("c", 900, 3.0)):
        with open(f"{path}/in/{name}.json", "w") as out:
            out.writelines(f'{{"id": 1, "year": 2020, "value": {value + i / 1e6}}}\n' for i in range(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = spark.read.schema(LONGS).json(f"{path}/in").where("id > 0")
        t = table(path)
        store.load_merge(df, t)
        assert rows(store.read_table(spark, t), "value") == [(3.0 + 899 / 1e6,)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# Changes. -------------------------------------------------------------------------------------


def test_changes_between_versions(spark, path):
    t = table(path)
    store.load_append(frame(spark, (1, 2020, 1.0), (2, 2020, None)), t, AT)
    store.load_merge(frame(spark, (1, 2020, 1.0), (2, 2020, 5.0), (3, 2021, 3.0)), t)
    store.load_replace(frame(spark, (2, 2020, 5.0), (3, 2021, None)), t)
    names = ["_version", "_change", "id", "value"]
    first = [(1, "insert", 1, 1.0), (1, "insert", 2, None)]
    second = [(2, "insert", 3, 3.0), (2, "update", 2, 5.0)]
    third = [(3, "delete", 1, 1.0), (3, "update", 3, None)]
    assert rows(changes.changes(spark, t), *names) == [*first, *second, *third]
    assert rows(changes.changes(spark, t, 1, 2), *names) == second
    assert changes.changes(spark, t, 3).count() == 0
    assert changes.changes(spark, t, 3).columns == ["id", "year", "value", "_version", "_change"]
    store.expire_versions(spark, t, keep=2)
    assert rows(changes.changes(spark, t, 2), *names) == third
    with pytest.raises(LookupError, match="gone"):
        changes.changes(spark, t, 0)


def test_a_stream_of_changes_has_each_version_once(spark, path):
    t, seen = table(path), []

    def take(df, batch_id):
        seen.extend((batch_id, *r) for r in rows(df, "_version", "_change", "id"))

    def run():
        changes.change_stream(spark, t, take, f"{path}/ck").awaitTermination()

    store.load_replace(frame(spark, (1, 2020, 1.0)), t)
    store.load_merge(frame(spark, (2, 2020, 1.0)), t)
    run()
    run()
    assert seen == [(0, 1, "insert", 1), (0, 2, "insert", 2)]
    store.load_merge(frame(spark, (1, 2020, 4.0)), t)
    run()
    assert seen[2:] == [(1, 3, "update", 1)]


# Compaction. ----------------------------------------------------------------------------------


@pytest.fixture
def grown(spark, path):
    """Forty appends, ids from 0 to 799 in no order, in two years."""
    schema = T.StructType([*LONGS.fields]).add("_loaded_at", "timestamp_ntz")
    t = store.Table(f"{path}/raw", schema, ["id", "year"], "year", ["id"])
    for i in range(20):
        data = [((i * 37 + k * 211) % 800, 2020 + k % 2, float(k)) for k in range(40)]
        store.load_append(frame(spark, *data).coalesce(1), t, AT)
    return t


def test_compaction_keeps_rows_and_makes_files_few(spark, grown):
    before = rows(store.read_table(spark, grown))
    small = sum(f.bytes for f in compact.folders_of(spark, grown)) // 8
    done = compact.compact(spark, grown, target_bytes=small)
    assert done["partitions"] == 2 and done["files_before"] == 40 and 6 <= done["files_after"] <= 12
    assert rows(store.read_table(spark, grown)) == before
    # the feed of changes does not show it, and reading one id opens few files
    assert changes.changes(spark, grown, 20).count() == 0
    found = compact.read_range(spark, grown, 100, 102)
    assert rows(found) == [r for r in before if 100 <= r[0] <= 102]
    assert len(found.inputFiles()) <= 4 < len(store.read_table(spark, grown).inputFiles())


def test_compaction_settles(spark, grown):
    first = compact.compact(spark, grown)
    assert first == {"partitions": 2, "files_before": 40, "files_after": 2}
    assert compact.compact(spark, grown) == {"partitions": 0, "files_before": 0, "files_after": 0}
    store.load_append(frame(spark, (5000, 2020, 1.0)), grown, AT)
    # new folders have no statistics and are read whole
    assert rows(compact.read_range(spark, grown, 5000, 5000), "id") == [(5000,)]
    assert rows(compact.read_range(spark, grown, 6000, 7000), "id") == []
    store.expire_versions(spark, grown, keep=1)
    assert compact.expire_statistics(spark, grown) == []
    assert compact.compact(spark, grown)["files_before"] == 2
    store.expire_versions(spark, grown, keep=1)
    assert len(compact.expire_statistics(spark, grown)) == 1


def test_compaction_yields_to_other_writers(spark, grown, monkeypatch):
    before = store.read_table(spark, grown).count()
    real, once = versions.commit, []

    def commit(spark_, path, added, kind, *args, **options):
        if kind == versions.COMPACT and not once:
            once.append(True)
            store.load_append(frame(spark, (9000, 2020, 1.0)), grown, AT)
        return real(spark_, path, added, kind, *args, **options)

    monkeypatch.setattr(versions, "commit", commit)
    done = compact.compact(spark, grown)
    assert done["files_before"] == 41 and done["files_after"] == 2
    assert store.read_table(spark, grown).count() == before + 1


def test_compaction_of_tables_without_partitions_or_rows(spark, path):
    t = table(path, None)
    assert compact.compact(spark, t)["partitions"] == 0
    for i in range(3):
        store.load_merge(frame(spark, (i, 2020, 1.0)), t)
    store.load_replace(frame(spark, *[(i, 2020, 1.0) for i in range(30)]).repartition(3), t)
    before = rows(store.read_table(spark, t))
    assert compact.compact(spark, t)["files_after"] == 1
    assert rows(store.read_table(spark, t)) == before


def test_evolved_columns_survive_compaction(spark, path):
    t = table(path)
    store.load_replace(frame(spark, (1, 2020, 1.0)), t)
    more = frame(spark, (2, 2020, 5.0)).withColumn("score", F.lit("3A"))
    store.load_append(more, t, AT)
    assert compact.compact(spark, t)["files_after"] == 1
    assert rows(store.read_table(spark, t, evolved=True), "id", "score") == [(1, None), (2, "3A")]
