import os

from blobferry.streaming.ingest import ingest_new_objects, read_ingested


def _put(root, name, data):
    p = os.path.join(root, name)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    open(p, "wb").write(data)


def test_available_now_takes_only_new_objects(spark, tmp_root):
    src, sink, ckpt = f"{tmp_root}/src", f"{tmp_root}/sink", f"{tmp_root}/ckpt"
    _put(src, "a/1.pdf", b"one")
    _put(src, "2.pdf", b"two")
    _put(src, "skip.txt", b"no")
    r1 = ingest_new_objects(spark, src, sink, ckpt, suffix=".pdf", max_files_per_trigger=1)
    assert r1["rows"] == 2 and r1["batches"] >= 2  # at most one file per step
    # Nothing new: a second run adds no row.
    ingest_new_objects(spark, src, sink, ckpt, suffix=".pdf")
    assert read_ingested(spark, sink).count() == 2
    _put(src, "b/3.pdf", b"three")
    ingest_new_objects(spark, src, sink, ckpt, suffix=".pdf")
    got = sorted((r.filename, bytes(r.document)) for r in read_ingested(spark, sink).collect())
    assert got == [("2.pdf", b"two"), ("a/1.pdf", b"one"), ("b/3.pdf", b"three")]


def test_rewritten_object_is_not_taken_again(spark, tmp_root):
    """Like a key-only comparison: a new body under a known name is not new."""
    import time

    src, sink, ckpt = f"{tmp_root}/src", f"{tmp_root}/sink", f"{tmp_root}/ckpt"
    _put(src, "a.pdf", b"v1")
    ingest_new_objects(spark, src, sink, ckpt, suffix=".pdf")
    time.sleep(1.1)
    _put(src, "a.pdf", b"version two")
    ingest_new_objects(spark, src, sink, ckpt, suffix=".pdf")
    assert [bytes(r.document) for r in read_ingested(spark, sink).collect()] == [b"v1"]


def test_stream_into_registry_is_idempotent(spark, tmp_root):
    from blobferry.streaming.ingest import stream_into_registry

    src, reg = f"{tmp_root}/src", f"{tmp_root}/registry"
    _put(src, "a.pdf", b"A")
    _put(src, "d/b.pdf", b"BB")
    r1 = stream_into_registry(spark, src, reg, f"{tmp_root}/ck1", suffix=".pdf")
    assert r1["inserted"] == 2
    # The same files again under a fresh checkpoint (as after losing it):
    # the registry anti-join keeps every key once.
    _put(src, "c.pdf", b"C")
    r2 = stream_into_registry(spark, src, reg, f"{tmp_root}/ck2", suffix=".pdf")
    assert r2["inserted"] == 1
    rows = sorted((r.id, r.filename) for r in spark.read.parquet(reg).collect())
    assert rows == [(1, "a.pdf"), (2, "d/b.pdf"), (3, "c.pdf")]


def test_old_files_are_taken(spark, tmp_root):
    """A file dated 30 days before the newest one seen is loaded by a later pass."""
    import os
    import time

    from blobferry.streaming.ingest import ingest_new_objects

    root = f"{tmp_root}/objs"
    os.makedirs(root)
    for name, age in (("new.pdf", 0), ("old.pdf", 30 * 86400)):
        with open(f"{root}/{name}", "wb") as f:
            f.write(b"x")
        os.utime(f"{root}/{name}", (time.time() - age,) * 2)
        rep = ingest_new_objects(spark, root, f"{tmp_root}/sink", f"{tmp_root}/ckpt")
        assert rep["rows"] == 1


def test_failed_reads_and_deleted_names_are_offered_again(spark, tmp_root):
    """A read that fails in one pass is loaded once in the next; a pass without new files takes what is owed."""
    from blobferry.plans import jobs
    from blobferry.sinks import ledgers as L
    from blobferry.sources import registry as R
    from blobferry.streaming.ingest import stream_into_registry

    root, reg, ckpt = (f"{tmp_root}/{x}" for x in ("in", "reg", "ckpt"))
    led, gone = L.Ledgers(f"{tmp_root}/state"), L.Ledgers(f"{tmp_root}/sync")
    os.makedirs(root)

    def put(name, data):
        open(f"{root}/{name}", "wb").write(data)

    def go(**kw):
        return stream_into_registry(spark, root, reg, ckpt, suffix=".pdf", ledgers=led, sync_ledgers=gone, **kw)

    def live():
        view = R.current_view(spark.read.parquet(reg), tombstones=L.read_tombstones(spark, gone.tombstones))
        return sorted((r["filename"], bytes(r["document"])) for r in view.collect())

    put("a.pdf", b"small")
    put("b.pdf", b"x" * 50)
    out = go(max_bytes=10)
    assert (out["inserted"], out["failed"]) == (1, 1)
    assert go(max_bytes=10)["inserted"] == 0  # still failing, still owed
    put("c.pdf", b"new")
    out = go()
    assert (out["inserted"], out["failed"]) == (2, 0)
    assert [k for k, _ in live()] == ["a.pdf", "b.pdf", "c.pdf"]
    assert go()["inserted"] == 0
    # c goes away, its row is deleted, and it comes back under its old name
    os.remove(f"{root}/c.pdf")
    jobs.sync_registry(spark, R.current_view(spark.read.parquet(reg)), jobs.list_all_objects(spark, root), gone)
    assert [k for k, _ in live()] == ["a.pdf", "b.pdf"]
    assert go()["inserted"] == 0  # not there: nothing to load
    put("c.pdf", b"again")
    assert go()["inserted"] == 1
    assert live() == [("a.pdf", b"small"), ("b.pdf", b"x" * 50), ("c.pdf", b"again")]
    assert go()["inserted"] == 0


def test_the_checkpoint_holds_steps_not_objects(spark, tmp_root):
    """Objects are noted once in a table; the stream's own log on the driver has an entry per step."""
    import glob

    from blobferry.streaming.ingest import arrivals_path, stream_into_registry

    root, reg, ckpt = (f"{tmp_root}/{x}" for x in ("in", "reg", "ckpt"))
    for i in range(10):
        _put(root, f"d{i % 3}/{i}.pdf", b"x" * (i + 1))
    _put(root, "d0/.hidden.pdf", b"no")
    _put(root, "d0/empty.pdf", b"")
    out = stream_into_registry(spark, root, reg, ckpt, suffix=".pdf", max_files_per_trigger=4)
    assert out == {"batches": 3, "inserted": 10, "failed": 0}
    log = "".join(open(p).read() for p in glob.glob(f"{ckpt}/sources/0/[0-9]*"))
    assert log.count('"path"') == 3 and "d0/" not in log
    noted = {(r["key"], r["id"]) for r in spark.read.parquet(arrivals_path(ckpt)).collect()}
    rows = {(r["filename"], r["id"]) for r in spark.read.parquet(reg).collect()}
    assert noted == rows | {("d0/empty.pdf", None)} and sorted(i for _, i in rows) == list(range(1, 11))
    again = stream_into_registry(spark, root, reg, ckpt, suffix=".pdf", max_files_per_trigger=4)
    assert again["inserted"] == 0 and spark.read.parquet(reg).count() == 10


def test_steps_of_a_stopped_pass_are_loaded_once(spark, tmp_root):
    """A pass that noted its arrivals and inserted some of them before it stopped: the next one takes the rest, with ids of their own."""
    from blobferry.plans import jobs
    from blobferry.streaming import ingest

    root, reg, ckpt = (f"{tmp_root}/{x}" for x in ("in", "reg", "ckpt"))
    for name in ("a.pdf", "b.pdf", "c.pdf"):
        _put(root, name, name.encode())
    ingest._plan(spark, root, reg, ckpt, ".pdf", None, None, None, "stopped")
    jobs.load_new(spark, root, reg, listing=spark.createDataFrame([("b.pdf", 5)], "key string, size long"))
    _put(root, "d.pdf", b"d.pdf")
    out = ingest.stream_into_registry(spark, root, reg, ckpt, suffix=".pdf")
    assert (out["inserted"], out["failed"]) == (3, 0)
    rows = [(r["id"], r["filename"], bytes(r["document"])) for r in spark.read.parquet(reg).collect()]
    assert sorted(f for _, f, _ in rows) == ["a.pdf", "b.pdf", "c.pdf", "d.pdf"]
    assert len({i for i, _, _ in rows}) == 4 and all(d == f.encode() for _, f, d in rows)
