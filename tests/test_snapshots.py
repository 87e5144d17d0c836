"""Snapshot tables: commits, restarts, conflicts, clean-up."""

import pytest
from pyspark.sql import functions as F

from riskspark.operators.rollups import upsert
from riskspark.sources import snapshots as SN
from riskspark.streaming.ops import work_dir

DAY = "d"


def batch(spark, rows):
    return spark.createDataFrame(rows, "d string, k long, v long").coalesce(1)


def rows_of(table, **kw):
    return sorted((r.d, r.k, r.v) for r in table.read(**kw).collect())


def test_fifty_epochs_read_as_many_files_as_days(spark):
    t = SN.SnapshotTable(spark, work_dir(spark, "t_snap"))
    want = {}
    for e in range(50):
        rows = [(f"2024-01-{1 + e % 5:02d}", k, 100 * e + k) for k in (e % 3, 7)]
        assert t.upsert(batch(spark, rows), ["d", "k"], F.to_date(DAY), e)
        want |= {(d, k): v for d, k, v in rows}
    assert t.files() == 5 and rows_of(t) == sorted((d, k, v) for (d, k), v in want.items())
    assert t.vacuum(keep=2) == 44 and len(t.versions()) == 2  # 50 folders, 5 named by the last snapshot and one more before it
    assert t.files() == 5 and rows_of(t) == sorted((d, k, v) for (d, k), v in want.items())


def test_a_failed_commit_leaves_the_old_state(spark, monkeypatch):
    t = SN.SnapshotTable(spark, work_dir(spark, "t_snap"))
    t.upsert(batch(spark, [("2024-01-01", 1, 1)]), ["k"], F.to_date(DAY), 0)
    with monkeypatch.context() as m:
        m.setattr(SN.SnapshotTable, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            t.upsert(batch(spark, [("2024-01-01", 1, 2), ("2024-01-02", 1, 2)]), ["k"], F.to_date(DAY), 1)
    assert rows_of(t) == [("2024-01-01", 1, 1)]
    assert t.upsert(batch(spark, [("2024-01-01", 1, 2), ("2024-01-02", 1, 2)]), ["k"], F.to_date(DAY), 1)  # the epoch again
    assert rows_of(t) == [("2024-01-01", 1, 2), ("2024-01-02", 1, 2)]
    assert not t.upsert(batch(spark, [("2024-01-01", 1, 9)]), ["k"], F.to_date(DAY), 1)  # committed already
    assert rows_of(t) == [("2024-01-01", 1, 2), ("2024-01-02", 1, 2)] and rows_of(t, version=0) == [("2024-01-01", 1, 1)]
    assert t.vacuum() == 3  # the old day and the two that were never committed


def test_of_two_writers_one_fails(spark):
    t = SN.SnapshotTable(spark, work_dir(spark, "t_snap"))
    t.upsert(batch(spark, [("2024-01-01", 1, 1)]), ["k"], F.to_date(DAY), 0)
    state = t.snapshot() | {"version": 1}
    t._commit(state)
    with pytest.raises(SN.CommitConflict):
        t._commit(state)
    assert t.versions() == [0, 1]


def test_large_days_are_spread_and_rows_without_a_day_kept(spark):
    t = SN.SnapshotTable(spark, work_dir(spark, "t_snap"), file_rows=100)
    rows = [("2024-01-01", k, k) for k in range(1000)] + [("2024-01-02", 1, 1), (None, 5, 5), (None, None, 6)]
    t.upsert(batch(spark, rows), ["k"], F.to_date(DAY), 0)
    assert len(rows_of(t, days=["2024-01-01"])) == 1000 and t.files() >= 8
    t.upsert(batch(spark, [(None, 5, 50), (None, None, 60)]), ["k"], F.to_date(DAY), 1, writer="other")
    assert sorted(r.v for r in t.read(days=[SN.NO_DAY]).collect()) == [50, 60] and t.read().count() == 1003


def test_last_row_of_a_batch_wins(spark):
    old, new = batch(spark, [("a", 1, 1), ("b", 2, 2)]), batch(spark, [("x", 1, 10), ("y", 1, 30), ("z", 1, 20)])
    assert sorted(map(tuple, upsert(old, new, ["k"]).collect())) == [(1, "z", 20), (2, "b", 2)]
    assert sorted(map(tuple, upsert(old, new, ["k"], ["v"]).collect())) == [(1, "y", 30), (2, "b", 2)]
