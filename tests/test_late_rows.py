"""Rows with a null leading key: no mark covers them, a record of what was taken does."""

import datetime as dt
import os

import pytest

from blobferry.plans import jobs
from blobferry.sinks import ledgers as L

SCHEMA = "ID bigint, POLICY_ID bigint, COMPANY string, BROKER string, MODIFIED timestamp_ntz, BINDER_DOC binary"
T = [dt.datetime(2024, 1, d) for d in range(1, 9)]


def objects(root):
    return {f: open(os.path.join(root, f), "rb").read() for f in os.listdir(root) if not f.startswith(".")}


def job(spark, root, strategy, ctx="c", **sink):
    led = L.Ledgers(f"{root}/state")

    def run(rows, **kw):
        src = spark.createDataFrame(rows, SCHEMA)
        return jobs.run_incremental(spark, src, ctx, strategy, led,
                                    jobs.blob_sink(f"{root}/out", written=L.target_state(spark, led.status), **sink), **kw)

    return led, run


def late(strategy, k, policy, body):
    """A row whose leading key is null under the strategy."""
    by_id = strategy in ("id", "composite")
    return (None if by_id else k, policy, "c", "b", T[0] if by_id else None, body)


@pytest.mark.parametrize("strategy", ["id", "timestamp", "composite", "modified_id"])
def test_each_late_row_is_exported_once(spark, tmp_root, strategy):
    _, run = job(spark, tmp_root, strategy)
    rows = [(1, 1, "c", "b", T[1], b"1"), (2, 2, "c", "b", T[2], b"2"), late(strategy, 50, 50, b"early")]
    rep = run(rows)
    assert (rep.counts["n_ok"], rep.n_late) == (3, 1)
    rows += [late(strategy, 60, 60, b"l1"), late(strategy, 61, 61, b"l2"), (3, 3, "c", "b", T[3], b"3")]
    rep = run(rows)
    assert (rep.counts["n_rows"], rep.counts["n_ok"], rep.n_late) == (3, 3, 2)
    assert {f"binder_{p}.pdf" for p in (1, 2, 3, 50, 60, 61)} == set(objects(f"{tmp_root}/out"))
    rep = run(rows)
    assert rep.counts["n_rows"] == 0 and not rep.committed
    rep = run([*rows, late(strategy, 70, 70, b"alone")])  # nothing past the mark
    assert (rep.counts["n_rows"], rep.n_late) == (1, 1)
    assert rep.high_water == run(rows).high_water


def test_only_late_rows_and_no_mark_at_all(spark, tmp_root):
    _, run = job(spark, tmp_root, "timestamp")
    rows = [late("timestamp", 1, 1, b"a")]
    assert (run(rows).counts["n_ok"], run(rows).counts["n_rows"]) == (1, 0)
    rows += [late("timestamp", 2, 2, b"b"), (3, 3, "c", "b", T[0], b"c")]
    rep = run(rows)
    assert (rep.counts["n_ok"], rep.n_late, rep.high_water) == (2, 1, (T[0],))
    assert run(rows).counts["n_rows"] == 0


def test_failed_late_rows_are_retried(spark, tmp_root):
    import pyspark.sql.functions as F

    led, run = job(spark, tmp_root, "timestamp", fail=F.col("ID") == 9)
    rows = [(1, 1, "c", "b", T[1], b"1"), late("timestamp", 9, 9, b"nine"), late("timestamp", 8, 8, b"eight")]
    rep = run(rows)
    assert (rep.counts["n_ok"], rep.counts["n_failed"], rep.n_late) == (2, 1, 2)
    _, healed = job(spark, tmp_root, "timestamp")
    rep = healed([*rows, late("timestamp", 7, 7, b"seven")])
    assert (rep.counts["n_rows"], rep.counts["n_ok"], rep.n_late) == (2, 2, 1)
    assert objects(f"{tmp_root}/out")["binder_9.pdf"] == b"nine"
    assert healed(rows).counts["n_rows"] == 0


def test_failed_late_rows_are_retried_without_a_mark(spark, tmp_root):
    import pyspark.sql.functions as F

    _, run = job(spark, tmp_root, "timestamp", fail=F.col("ID") == 9)
    rows = [late("timestamp", 9, 9, b"nine")]
    assert run(rows).counts["n_failed"] == 1
    _, healed = job(spark, tmp_root, "timestamp")
    assert healed(rows).counts["n_ok"] == 1
    assert healed(rows).counts["n_rows"] == 0


def test_a_late_row_never_replaces_a_newer_object(spark, tmp_root):
    _, run = job(spark, tmp_root, "modified_id")
    rows = [(1, 1, "c", "b", T[1], b"new")]
    run(rows)
    rep = run([*rows, (2, 1, "c", "b", None, b"older"), (3, 2, "c", "b", None, b"other")])
    assert (rep.counts["n_ok"], rep.counts["n_skipped"], rep.n_late) == (1, 1, 2)
    assert objects(f"{tmp_root}/out") == {"binder_1.pdf": b"new", "binder_2.pdf": b"other"}


def test_contexts_keep_their_own_record(spark, tmp_root):
    _, one = job(spark, tmp_root, "timestamp", ctx="one")
    _, two = job(spark, tmp_root, "timestamp", ctx="two")
    rows = [late("timestamp", 1, 1, b"a"), (2, 2, "c", "b", T[0], b"b")]
    assert one(rows).n_late == 1 and two(rows).n_late == 1 and one(rows).n_late == 0


def test_a_context_older_than_the_record_goes_by_its_status_rows(spark, tmp_root):
    led, run = job(spark, tmp_root, "timestamp")
    rows = [late("timestamp", 1, 1, b"a"), (2, 2, "c", "b", T[0], b"b")]
    run(rows)
    bare = L.Ledgers(f"{tmp_root}/old")  # the same state as an older version left it
    spark.read.parquet(led.status).write.parquet(bare.status)
    spark.read.parquet(led.bookmarks).write.parquet(bare.bookmarks)
    src = spark.createDataFrame([*rows, late("timestamp", 5, 5, b"c")], SCHEMA)
    sink = jobs.blob_sink(f"{tmp_root}/out")
    rep = jobs.run_incremental(spark, src, "c", "timestamp", bare, sink)
    assert (rep.counts["n_rows"], rep.n_late) == (1, 1)
    assert jobs.run_incremental(spark, src, "c", "timestamp", bare, sink).counts["n_rows"] == 0


def test_a_stop_between_status_and_bookmark_loses_nothing(spark, tmp_root, monkeypatch):
    led, run = job(spark, tmp_root, "timestamp")
    rows = [late("timestamp", 1, 1, b"a"), (2, 2, "c", "b", T[0], b"b")]
    monkeypatch.setattr(L, "append_taken", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        run(rows)
    monkeypatch.undo()
    rep = run(rows)
    assert rep.counts["n_rows"] == 2 and rep.n_late == 1 and run(rows).counts["n_rows"] == 0
