"""The commit log and the tables published through it."""

import os
import time

import pytest
from pyspark.sql import functions as F

from shoplens.sinks import commits, fs
from shoplens.sinks import segments as S
from shoplens.sinks.commits import CommitConflict, CommitLog
from shoplens.sinks.snapshot import KeyedTable, SnapshotTable


def _kv(spark, rows):
    return spark.createDataFrame(rows, "key string, field string, value string")


class Clock:
    """Real time, set forward by hand."""

    def __init__(self):
        self.ahead = 0.0

    def __call__(self):
        return time.time() + self.ahead


def test_versions_rise_whatever_the_batch_ids(spark, scratch):
    table = SnapshotTable(spark, f"{scratch}/snap_versions")
    assert table.read() is None and table.read(schema="key string").count() == 0
    for batch in range(4):
        table.publish(_kv(spark, [("k", "f", str(10 + batch))]), batch, "checkpoint 1")
    table.publish(_kv(spark, [("k", "f", "replay")]), 3, "checkpoint 1")  # adds nothing
    assert table.read().first().value == "13"
    for batch in range(2):  # a reset checkpoint: batch ids start anew
        table.publish(_kv(spark, [("k", "f", str(100 + batch))]), batch, "checkpoint 2")
    assert table.read().first().value == "101"
    assert [c for c in table.log.epochs()] == list(range(6))
    table.publish(_kv(spark, [("k", "f", "late replay")]), 3, "checkpoint 1")
    assert table.read().first().value == "101"


def test_a_reset_checkpoint_does_not_freeze_readers(spark, scratch):
    """Real streaming queries: the writer is the query's id, new with each
    checkpoint."""
    root = f"{scratch}/snap_reset"
    table = SnapshotTable(spark, f"{root}/out")
    writers = set()

    def publish(batch, batch_id):
        writers.add(commits.writer_of(batch))
        table.publish(batch.agg(F.max("n").alias("n")), batch_id, commits.writer_of(batch))

    def run(checkpoint, n):
        spark.createDataFrame([(n,)], "n int").coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("n int").parquet(f"{root}/in")
        q = stream.writeStream.foreachBatch(publish).option("checkpointLocation", f"{root}/{checkpoint}")
        q.trigger(availableNow=True).start().awaitTermination()
        return table.read().first().n

    assert [run("ck1", n) for n in (1, 2, 3)] == [1, 2, 3]
    assert run("ck2", 100) == 100
    assert len(writers) == 2 and "" not in writers


def test_a_reader_can_finish(spark, scratch):
    """Versions stay for a time after they are replaced, and longer under a
    lease; what nobody names goes."""
    clock = Clock()
    table = SnapshotTable(spark, f"{scratch}/snap_lease", keep_seconds=60, clock=clock)
    table.publish(_kv(spark, [("k", "f", "old")]))
    with table.open(seconds=1e6) as old:
        for i in range(10):
            table.publish(_kv(spark, [("k", "f", str(i))]))
        clock.ahead = 3600
        table.log.expire()
        assert old.first().value == "old"
        assert len(os.listdir(f"{scratch}/snap_lease/data")) >= 11
    orphan = f"{scratch}/snap_lease/data/orphan"  # written, never committed
    os.makedirs(orphan)
    table.log.expire()
    assert [n for n in os.listdir(f"{scratch}/snap_lease/data") if not n.startswith(".")] == [
        table.log.latest().body["data"]["path"].rsplit("/", 1)[1]
    ]
    assert table.log.epochs() == [10] and table.read().first().value == "9"


def test_a_dead_readers_lease_runs_out(spark, scratch):
    clock = Clock()
    log = CommitLog(spark, f"{scratch}/lease_dead", 60, clock)
    log.commit({}, None)
    lease = log.lease(seconds=30)
    lease.__enter__()
    log.commit({}, log.latest())
    clock.ahead = 3600
    log.expire()
    assert log.epochs() == [1]


def test_two_writers_conflict(spark, scratch):
    log = CommitLog(spark, f"{scratch}/conflict")
    start = log.commit({"n": 0}, None)
    log.commit({"n": 1}, start)
    with pytest.raises(CommitConflict):
        log.commit({"n": 2}, start)
    assert log.latest().body == {"n": 1}


def test_a_failed_write_or_commit_changes_nothing(spark, scratch, monkeypatch):
    table = KeyedTable(spark, f"{scratch}/keyed_fail", "k string, n int", ["k"])
    table.upsert(spark.createDataFrame([("a", 1)], "k string, n int"), 0)

    def refuse(*_):
        raise OSError("no")

    with monkeypatch.context() as m:
        m.setattr(fs, "rename", refuse)
        with pytest.raises(OSError):
            table.upsert(spark.createDataFrame([("a", 2)], "k string, n int"), 1)
    assert [r.n for r in table.read().collect()] == [1]
    table.upsert(spark.createDataFrame([("a", 3)], "k string, n int"), 1)  # tried again
    assert [r.n for r in table.read().collect()] == [3]


def test_keyed_table_against_a_dict(spark, scratch):
    """Many small updates, some of null keys, merged on the way."""
    table = KeyedTable(spark, f"{scratch}/keyed", "k string, a int, b string", ["k"], fanout=3)
    want = {}
    for i in range(15):
        rows = [(None if j % 5 == 4 else f"k{(i * j) % 7}", i, None if i % 4 == 0 else f"v{i}") for j in range(5)]
        rows = list({r[0]: r for r in rows}.values())
        table.upsert(spark.createDataFrame(rows, "k string, a int, b string"), i)
        want.update({r[0]: r for r in rows})
        if i in (0, 3, 14):
            assert {r.k: tuple(r) for r in table.read().collect()} == want
    assert len(table.segments()) < 3
    table.upsert(spark.createDataFrame([], "k string, a int, b string"), 15)
    with table.open() as rows:
        assert {r.k: tuple(r) for r in rows.collect()} == want


def test_an_update_writes_its_own_rows(spark, scratch):
    """The bytes of a batch do not follow the number of keys there are, and
    the segments that a reader opens do not follow the number of batches."""
    table = KeyedTable(spark, f"{scratch}/keyed_bytes", "k long, v string", ["k"], fanout=4)
    big = spark.range(200_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table.upsert(big.coalesce(1), 0)
    first = table.segments()[0]
    assert S.size_class(first["bytes"], 4) > 2
    written = 0
    for i in range(1, 30):
        before = {s["path"] for s in table.segments()}
        table.upsert(spark.createDataFrame([(i, "new")], "k long, v string"), i)
        written += sum(s["bytes"] for s in table.segments() if s["path"] not in before)
        assert len(table.segments()) <= 1 + 4
    assert first in table.segments()  # never rewritten for them
    assert written < first["bytes"] / 10
    got = table.read().filter("k < 40")
    assert {r.k for r in got.filter("v = 'new'").collect()} == set(range(1, 30))
    assert table.read().count() == 200_000


def test_merges_give_the_same_in_any_grouping(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 3, 2), ("b", 2, 7), (None, 0, 1), ("a", 2, 9)], f"k string, v int, {S.EPOCH} long")
    for merge in (S.newest(["k"]), lambda r: S.summed(["k"], "v")(r), lambda r: S.least(["k"], "v")(r)):
        whole = sorted(map(tuple, merge(rows).collect()), key=repr)
        halves = merge(rows.filter("v <= 1")).unionByName(merge(rows.filter("v > 1")))
        assert sorted(map(tuple, merge(halves).collect()), key=repr) == whole


def test_size_classes():
    assert [S.size_class(n, 8) for n in (0, 1, S.LEAST_BYTES, S.LEAST_BYTES + 1, 8 * S.LEAST_BYTES, 64 * S.LEAST_BYTES)] == [0, 0, 0, 1, 2, 3]


def test_text_files_appear_whole_or_not_at_all(spark, scratch):
    fs.mkdirs(spark, f"{scratch}/texts")
    path = f"{scratch}/texts/a.json"
    fs.write_text(spark, path, "é 1")
    with pytest.raises(FileExistsError):
        fs.write_text(spark, path, "2")
    assert fs.read_text(spark, path) == "é 1"
    assert [n for n, _, _ in fs.list_entries(spark, f"{scratch}/texts") if not n.startswith(".")] == ["a.json"]
