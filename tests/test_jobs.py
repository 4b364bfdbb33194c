"""Jobs: bookmarks commit after success, failures retry, re-runs do no work."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from blobferry.functions import keys as K
from blobferry.plans import jobs
from blobferry.session import scratch_path
from blobferry.sinks import ledgers as L
from blobferry.sources import registry as R


def _source(spark, n=40, day=1):
    base = dt.datetime(2024, 1, day)
    rows = [(i, i % 5, "co", "br", base + dt.timedelta(hours=i // 3), f"body-{i}".encode()) for i in range(n)]
    return spark.createDataFrame(
        rows, "ID bigint, POLICY_ID bigint, COMPANY string, BROKER string, MODIFIED timestamp_ntz, BINDER_DOC binary")


def test_failed_rows_are_retried_and_bookmark_moves_on(spark, tmp_root):
    src = _source(spark)
    led = L.Ledgers(f"{tmp_root}/state")
    sink = jobs.blob_sink(f"{tmp_root}/out", key_of=lambda b: K.template_key("ID", "r_", ".bin"),
                          fail=F.col("ID") == 7)
    r1 = jobs.run_incremental(spark, src, "c", "modified_id", led, sink)
    assert r1.counts["n_rows"] == 40 and r1.counts["n_failed"] == 1 and r1.committed
    # Second run: nothing new, but the failure is retried (and now succeeds).
    ok_sink = jobs.blob_sink(f"{tmp_root}/out", key_of=lambda b: K.template_key("ID", "r_", ".bin"))
    r2 = jobs.run_incremental(spark, src, "c", "modified_id", led, ok_sink)
    assert r2.counts["n_rows"] == 1 and r2.counts["n_ok"] == 1
    assert os.path.exists(f"{tmp_root}/out/r_7.bin")
    # Third run: nothing at all to do, and no bookmark row is added.
    r3 = jobs.run_incremental(spark, src, "c", "modified_id", led, ok_sink)
    assert r3.counts["n_rows"] == 0 and not r3.committed
    assert spark.read.parquet(led.bookmarks).count() == 2


def test_bookmark_not_committed_when_sink_raises(spark, tmp_root):
    src = _source(spark)
    led = L.Ledgers(f"{tmp_root}/state")

    def broken(batch, run_id):
        raise IOError("target unavailable")

    with pytest.raises(IOError):
        jobs.run_incremental(spark, src, "c", "id", led, broken)
    assert L.last_bookmark(spark, led.bookmarks, "c") == (0, None)


def test_latest_row_per_target_wins(spark, tmp_root):
    src = _source(spark)
    led = L.Ledgers(f"{tmp_root}/state")
    rep = jobs.run_incremental(spark, src, "c", "modified_id", led, jobs.blob_sink(f"{tmp_root}/out"))
    assert rep.counts["n_rows"] == 5  # five policies, one object each
    for p in range(5):
        last = max(i for i in range(40) if i % 5 == p)
        assert open(f"{tmp_root}/out/binder_{p}.pdf", "rb").read() == f"body-{last}".encode()


def test_sync_refuses_mass_delete(spark, tmp_root):
    reg = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, filename string")
    empty = spark.createDataFrame([], "key string")
    led = L.Ledgers(f"{tmp_root}/state")
    with pytest.raises(RuntimeError):
        jobs.sync_registry(spark, reg, empty, led)
    assert L.read_tombstones(spark, led.tombstones) is None
    live = spark.createDataFrame([("a",)], "key string")
    rep = jobs.sync_registry(spark, reg, live, led, max_share=0.6)
    assert rep.counts == {"existing": 2, "orphans": 1}
    view = R.current_view(reg, tombstones=L.read_tombstones(spark, led.tombstones))
    assert [r.filename for r in view.collect()] == ["a"]


def test_load_new_twice_loads_once(spark, tmp_root):
    root = f"{tmp_root}/objs"
    for name, data in [("a.pdf", b"A"), ("d/b.pdf", b"BB"), ("z.pdf", b""), ("n.txt", b"x")]:
        p = os.path.join(root, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        open(p, "wb").write(data)
    reg = f"{tmp_root}/registry"
    r1 = jobs.load_new(spark, root, reg, suffix=".pdf")
    assert r1.counts["inserted"] == 2
    rows = {r.filename: (r.id, bytes(r.document)) for r in spark.read.parquet(reg).collect()}
    assert rows == {"a.pdf": (1, b"A"), "d/b.pdf": (2, b"BB")}
    open(os.path.join(root, "c.pdf"), "wb").write(b"C")
    r2 = jobs.load_new(spark, root, reg, suffix=".pdf")
    assert r2.counts["inserted"] == 1
    ids = sorted(r.id for r in spark.read.parquet(reg).collect())
    assert ids == [1, 2, 3]


def test_registry_append_checks(spark, tmp_root):
    path = f"{tmp_root}/registry"
    rows = spark.createDataFrame([("g1", "a.pdf", b"x"), ("g2", "b.pdf", b"y")],
                                 "guid string, filename string, document binary")
    assert R.append(spark, path, rows) == 2
    with pytest.raises(ValueError, match="already"):
        R.append(spark, path, rows.limit(1))
    dup = spark.createDataFrame([("g3", "c", b"1"), ("g3", "d", b"2")],
                                "guid string, filename string, document binary")
    with pytest.raises(ValueError, match="duplicate"):
        R.append(spark, path, dup)
    more = spark.createDataFrame([("g4", "a.pdf", b"z")], "guid string, filename string, document binary")
    R.append(spark, path, more)  # filename may repeat
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_export_pending_marks_through_ledger(spark, tmp_root):
    reg = spark.createDataFrame([(1, "g1", "a.pdf", b"A", False), (2, "g2", "b.pdf", b"B", True),
                                 (3, "g3", "pre/c.pdf", b"C", None)],
                                "id bigint, guid string, filename string, document binary, uploaded_to_s3 boolean")
    led = L.Ledgers(f"{tmp_root}/state")
    rep = jobs.export_pending(spark, reg, f"{tmp_root}/out", led, target_prefix="docs", strip="pre/")
    assert rep.counts["n_ok"] == 2
    assert os.path.exists(f"{tmp_root}/out/docs/c.pdf") and os.path.exists(f"{tmp_root}/out/docs/a.pdf")
    view = R.current_view(reg, ok_ledger=L.ok_guids(spark, led.status))
    assert all(r.uploaded_to_s3 for r in view.collect())
    # A second run finds nothing pending once the ledger is read.
    rep2 = jobs.export_pending(spark, reg, f"{tmp_root}/out", led, target_prefix="docs", strip="pre/",
                               ok_ledger=L.ok_guids(spark, led.status))
    assert rep2.counts["n_rows"] == 0 and rep2.run_no == 2  # numbered from the ledger


def test_compaction_writes_the_view_elsewhere(spark, tmp_root):
    reg_path = f"{tmp_root}/registry"
    rows = spark.createDataFrame([("g1", "a.pdf", b"x"), ("g2", "b.pdf", b"y")],
                                 "guid string, filename string, document binary")
    R.append(spark, reg_path, rows)
    led = L.Ledgers(f"{tmp_root}/state")
    L.append_tombstones(spark.createDataFrame([("b.pdf",)], "key string"), led.tombstones, "r1")
    view = R.current_view(spark.read.parquet(reg_path), tombstones=L.read_tombstones(spark, led.tombstones))
    new_path = R.compact(view, f"{tmp_root}/registry-v2")
    assert [r.filename for r in spark.read.parquet(new_path).collect()] == ["a.pdf"]
    assert spark.read.parquet(reg_path).count() == 2  # the old table is untouched
    with pytest.raises(Exception):
        R.compact(view, new_path)  # never over an existing table


def test_accumulate_pages(spark):
    from blobferry.operators.sync import accumulate

    p1 = spark.createDataFrame([("a",), ("b",)], "key string")
    p2 = spark.createDataFrame([("b",), ("c",)], "key string")
    assert accumulate([p1, p2]).count() == 4
    assert accumulate([p1, p2], as_set=True).count() == 3


def test_same_size_new_content_is_exported_with_sha1_compare(spark, tmp_root):
    base = dt.datetime(2024, 1, 1)
    schema = "ID bigint, POLICY_ID bigint, COMPANY string, BROKER string, MODIFIED timestamp_ntz, BINDER_DOC binary"
    v1 = spark.createDataFrame([(1, 1, "c", "b", base, b"AAAA"), (2, 2, "c", "b", base, b"BBBB")], schema)
    led = L.Ledgers(f"{tmp_root}/state")
    out = f"{tmp_root}/out"
    jobs.run_incremental(spark, v1, "c", "modified_id", led, jobs.blob_sink(out))
    later = base + dt.timedelta(days=1)
    v2 = spark.createDataFrame([(3, 1, "c", "b", later, b"AAAA"), (4, 2, "c", "b", later, b"CCCC")], schema)
    state = L.target_state(spark, led.status)
    rep = jobs.run_incremental(spark, v2, "c", "modified_id", led,
                               jobs.blob_sink(out, target_listing=state, compare_sha1=True))
    assert rep.counts["n_skipped"] == 1 and rep.counts["n_ok"] == 1
    assert open(f"{out}/binder_2.pdf", "rb").read() == b"CCCC"
    # Size alone would have skipped both.
    size_only = jobs.blob_sink(out, target_listing=L.target_state(spark, led.status))
    st = size_only(v2, "probe")
    assert st.where("skipped").count() == 2


def test_failing_listing_deletes_nothing(spark, tmp_root):
    from blobferry.sources.listing import list_all_objects

    reg = spark.createDataFrame([(1, "a")], "id bigint, filename string")
    led = L.Ledgers(f"{tmp_root}/state")
    with pytest.raises(Exception):
        jobs.sync_registry(spark, reg, list_all_objects(spark, f"{tmp_root}/missing"), led)
    assert L.read_tombstones(spark, led.tombstones) is None


def test_load_new_records_unreadable_objects(spark, tmp_root):
    root = f"{tmp_root}/objs"
    os.makedirs(root)
    open(f"{root}/a.pdf", "wb").write(b"A")
    open(f"{root}/b.pdf", "wb").write(b"B")
    listing = spark.createDataFrame([("a.pdf", 1), ("b.pdf", 1), ("b.pdf", 1), ("gone.pdf", 5)],
                                    "key string, size bigint")  # b.pdf listed twice
    led = L.Ledgers(f"{tmp_root}/state")
    rep = jobs.load_new(spark, root, f"{tmp_root}/registry", listing=listing, ledgers=led)
    assert rep.counts["inserted"] == 2 and rep.counts["failed"] == 1
    errs = spark.read.parquet(led.status).collect()
    assert [(r.key, r.ok) for r in errs] == [("gone.pdf", False)] and errs[0].error


def test_status_compaction_keeps_latest_per_key(spark, tmp_root):
    src = _source(spark)
    led = L.Ledgers(f"{tmp_root}/state")
    sink = jobs.blob_sink(f"{tmp_root}/out", key_of=lambda b: K.template_key("ID", "r_", ".bin"),
                          fail=F.col("ID") == 3)
    jobs.run_incremental(spark, src, "c", "modified_id", led, sink)
    ok_sink = jobs.blob_sink(f"{tmp_root}/out", key_of=lambda b: K.template_key("ID", "r_", ".bin"))
    jobs.run_incremental(spark, src, "c", "modified_id", led, ok_sink)
    assert spark.read.parquet(led.status).count() == 41
    new = L.compact_status(spark, led.status, f"{tmp_root}/status-v2")
    rows = spark.read.parquet(new)
    assert rows.count() == 40 and rows.where("not ok").count() == 0


def test_export_pending_bodies_do_not_cross_a_shuffle(spark, tmp_root):
    """The pending set is small and counted, so it is broadcast: the registry
    (with its bodies) is scanned and filtered in place."""
    from pyspark.sql import functions as F

    from blobferry.operators import sync
    from blobferry.session import materialize
    from conftest import plan_text

    reg_path = f"{tmp_root}/registry"
    rows = spark.range(0, 300).select(
        F.concat(F.lit("g"), F.col("id").cast("string")).alias("guid"),
        F.concat(F.lit("f"), F.col("id").cast("string"), F.lit(".pdf")).alias("filename"),
        F.col("id").cast("string").cast("binary").alias("document"))
    R.append(spark, reg_path, rows)
    reg = spark.read.parquet(reg_path)
    pending = materialize(reg.where("id % 2 = 0").select("guid"), "test-pending")
    right, n = sync.checked_broadcast(pending)
    plan = plan_text(reg.join(right, "guid", "left_semi"))
    assert n == 150 and "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    big, n_big = sync.checked_broadcast(pending, max_rows=10)
    assert n_big == 150 and big is pending  # above the bound: no broadcast hint


def test_ship_to_executors_writes_zip_in_shared_folder(spark):
    import zipfile

    from blobferry.session import ship_to_executors, state_root
    from blobferry.session import to_local

    path = ship_to_executors(spark)
    assert path.startswith(state_root(spark))
    names = zipfile.ZipFile(to_local(path)).namelist()
    assert "blobferry/plans/jobs.py" in names and "blobferry/sources/listing.py" in names


SOURCE_SCHEMA = ("ID bigint, POLICY_ID bigint, COMPANY string, BROKER string, "
                 "MODIFIED timestamp_ntz, BINDER_DOC binary")


def _objects(root: str) -> dict[str, bytes]:
    return {f: open(os.path.join(root, f), "rb").read() for f in os.listdir(root) if not f.startswith(".")}


@pytest.mark.parametrize("strategy", ["id", "timestamp", "composite", "modified_id"])
def test_rows_with_null_keys_are_exported_once(spark, tmp_root, strategy):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, 1, "c", "b", base, b"x"), (2, 2, None, "b", None, b"y"), (None, 3, "c", None, base, b"z")]
    src = spark.createDataFrame(rows, SOURCE_SCHEMA)
    led = L.Ledgers(f"{tmp_root}/state")
    sink = jobs.blob_sink(f"{tmp_root}/out")
    rep = jobs.run_incremental(spark, src, "c", strategy, led, sink)
    assert (rep.counts["n_rows"], rep.counts["n_ok"]) == (3, 3)
    assert _objects(f"{tmp_root}/out") == {"binder_1.pdf": b"x", "binder_2.pdf": b"y", "binder_3.pdf": b"z"}
    again = jobs.run_incremental(spark, src, "c", strategy, led, sink)
    assert again.counts["n_rows"] == 0


def test_repeated_ids_keep_their_own_bodies(spark, tmp_root):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [(5, 1, "c", "b", t[0], b"P1"), (5, 2, "c", "b", t[0], b"P2"),  # an id shared by two policies
            (7, 3, "c", "b", t[0], b"old"), (7, 3, "c", "b", t[1], b"new"),  # two versions of a row
            (None, 4, "c", "b", t[0], b"no id"), (8, 6, "c", "b", t[2], None),
            (9, 5, "c", "b", t[0], b"twice"), (9, 5, "c", "b", t[0], b"twice"),  # a repeated row
            (9, 7, "c", "b", t[0], b"a"), (9, 7, "c", "b", t[0], b"bb")]  # tied: the longer body
    src = spark.createDataFrame(rows, SOURCE_SCHEMA)
    led = L.Ledgers(f"{tmp_root}/state")
    rep = jobs.run_incremental(spark, src, "c", "modified_id", led, jobs.blob_sink(f"{tmp_root}/out"))
    assert _objects(f"{tmp_root}/out") == {
        "binder_1.pdf": b"P1", "binder_2.pdf": b"P2", "binder_3.pdf": b"new", "binder_4.pdf": b"no id",
        "binder_5.pdf": b"twice", "binder_7.pdf": b"bb"}
    assert (rep.counts["n_rows"], rep.counts["n_ok"], rep.counts["n_failed"]) == (7, 6, 1)
    # With a stored size no body is hashed: tied rows are refused, others go.
    sized = src.withColumn("n", F.length("BINDER_DOC").cast("bigint"))
    status = jobs.blob_sink(f"{tmp_root}/out2", size_col="n")(sized, "r")
    assert {r["key"] for r in L.append_status(status, f"{tmp_root}/st2", "r", 1).where("ok").collect()} == {
        "binder_1.pdf", "binder_2.pdf", "binder_3.pdf", "binder_4.pdf"}


def test_blob_sink_leaves_no_shuffle_files(spark, tmp_root):
    """What the plan and the write shuffled is gone when the run ends; the staged plan holds hashes of tied rows only."""
    import time

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f"{at}/{f}" for top in disk.localDirsString() for at, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    def kept():
        try:
            return sum(os.path.getsize(f) for f in shuffled() - before)
        except FileNotFoundError:  # just deleted
            return kept()

    t = [dt.datetime(2024, 1, d) for d in (1, 2)]
    rows = [(i, i % 50, "c", "b", t[i % 2], b"%d" % i) for i in range(20_000)] + [(99_999, 7, "c", "b", dt.datetime(2024, 2, 1), b"twice")] * 2
    spark.createDataFrame(rows, SOURCE_SCHEMA).repartition(4).write.parquet(f"{tmp_root}/src")
    src = spark.read.parquet(f"{tmp_root}/src")  # shuffles nothing of its own
    before, was = shuffled(), spark.conf.get(setting)
    staged = {d for d in os.listdir(scratch_path(spark, "x").rpartition("/")[0]) if d.startswith("export-plan-")}
    rep = jobs.run_incremental(spark, src, "c", "modified_id", L.Ledgers(f"{tmp_root}/state"), jobs.blob_sink(f"{tmp_root}/out"))
    assert (rep.counts["n_rows"], rep.counts["n_ok"]) == (50, 50) and spark.conf.get(setting) == was
    assert _objects(f"{tmp_root}/out") == {f"binder_{p}.pdf": b"twice" if p == 7 else b"%d" % (19_950 + p) for p in range(50)}
    folder = scratch_path(spark, "x").rpartition("/")[0]
    plan = [d for d in os.listdir(folder) if d.startswith("export-plan-") and d not in staged]
    held = {r["key"] for r in spark.read.parquet(f"{folder}/{plan[0]}").where("sha1 is not null").collect()}
    assert len(plan) == 1 and held == {"binder_7.pdf"}
    until = time.time() + 20
    while kept() > 100_000 and time.time() < until:  # deleted in the background
        time.sleep(0.2)
    assert kept() <= 100_000  # single counts


def test_blob_sink_tells_ties_in_any_order(spark, tmp_root):
    t = [dt.datetime(2024, 1, d) for d in (1, 2)]
    rows = [(1, 1, "c", "b", t[0], b"aa"), (1, 1, "c", "b", t[0], b"z"), (1, 1, "c", "b", t[0], b"y"),  # tied: the longest first
            (2, 2, "c", "b", t[0], b"z"), (2, 2, "c", "b", t[0], b"bb"),  # tied: the longest last
            (3, 3, "c", "b", t[0], b"old"), (3, 3, "c", "b", t[0], b"older"), (3, 3, "c", "b", t[1], b"n"),  # a tie that is not the latest
            (4, 4, "c", "b", t[0], b"x"), (None, 4, "c", "b", t[0], b"long"),  # a null id sorts lowest: no tie
            (None, 5, "c", "b", None, b"p"), (None, 5, "c", "b", None, b"pq"),  # tied without order and id
            (6, 6, "c", "b", t[0], None), (6, 6, "c", "b", t[0], b"s"),  # a null body is the least
            (7, 7, "c", "b", t[0], b"only")]
    want = {"binder_1.pdf": b"aa", "binder_2.pdf": b"bb", "binder_3.pdf": b"n", "binder_4.pdf": b"x", "binder_5.pdf": b"pq",
            "binder_6.pdf": b"s", "binder_7.pdf": b"only"}
    for n, order in enumerate((rows, rows[::-1])):
        for parts in (1, 5):
            src = spark.createDataFrame(order, SOURCE_SCHEMA).coalesce(1) if parts == 1 else spark.createDataFrame(order, SOURCE_SCHEMA).repartition(5)
            out = f"{tmp_root}/out{n}-{parts}"
            got = jobs.blob_sink(out)(src, "r").collect()
            assert sorted((r.key, r.ok) for r in got) == [(k, True) for k in sorted(want)] and _objects(out) == want
    sized = spark.createDataFrame(rows, SOURCE_SCHEMA).withColumn("n", F.length("BINDER_DOC").cast("bigint"))
    status = jobs.blob_sink(f"{tmp_root}/sized", size_col="n")(sized, "r").collect()
    assert {r.key for r in status if not r.ok} == {f"binder_{p}.pdf" for p in (1, 2, 5, 6)}
    assert {r.error for r in status if not r.ok} == {"several rows share key, order and id"}


def test_retry_of_a_shared_id_leaves_newer_objects(spark, tmp_root):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    src = spark.createDataFrame([(5, 1, "bad", "b", t[0], b"P1"), (5, 2, "c", "b", t[0], b"old"),
                                 (6, 2, "c", "b", t[1], b"new")], SOURCE_SCHEMA)
    led = L.Ledgers(f"{tmp_root}/state")
    bad = jobs.blob_sink(f"{tmp_root}/out", fail=F.col("COMPANY") == "bad")
    jobs.run_incremental(spark, src, "a", "modified_id", led, bad)
    # Another context under the same root succeeds; its state is its own.
    jobs.run_incremental(spark, src, "b", "modified_id", led, jobs.blob_sink(f"{tmp_root}/other"))
    rep = jobs.run_incremental(spark, src, "a", "modified_id", led, jobs.blob_sink(f"{tmp_root}/out"))
    assert rep.counts["n_rows"] == 1 and rep.run_no == 3
    assert _objects(f"{tmp_root}/out") == {"binder_1.pdf": b"P1", "binder_2.pdf": b"new"}


def test_sync_scope_and_readded_objects(spark, tmp_root):
    root, reg = f"{tmp_root}/objs", f"{tmp_root}/registry"
    for name in ("a/1.pdf", "a/2.pdf", "a/3.pdf", "b/1.pdf"):
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        open(f"{root}/{name}", "wb").write(name.encode())
    jobs.load_new(spark, root, reg)
    led = L.Ledgers(f"{tmp_root}/sync")

    def view():
        return R.current_view(spark.read.parquet(reg), tombstones=L.read_tombstones(spark, led.tombstones))

    os.remove(f"{root}/a/1.pdf")
    os.remove(f"{root}/b/1.pdf")
    listing = jobs.list_all_objects(spark, root, ".pdf", "a/")
    rep = jobs.sync_registry(spark, view(), listing, led, suffix=".pdf", prefix="a/")
    assert rep.counts == {"existing": 3, "orphans": 1}  # b/1.pdf is out of scope
    assert {r["filename"] for r in view().collect()} == {"a/2.pdf", "a/3.pdf", "b/1.pdf"}
    open(f"{root}/a/1.pdf", "wb").write(b"back")
    rep = jobs.load_new(spark, root, reg, tombstones=L.read_tombstones(spark, led.tombstones))
    assert rep.counts["new"] == 1 and rep.counts["inserted"] == 1
    back = view().where("filename = 'a/1.pdf'").collect()
    assert [bytes(r["document"]) for r in back] == [b"back"]
    guids = [r["guid"] for r in spark.read.parquet(reg).select("guid").collect()]
    assert len(set(guids)) == len(guids) == 5


def test_blob_sink_bodies_do_not_cross_a_shuffle(spark, tmp_root):
    from conftest import plan_text

    src_path = f"{tmp_root}/src"
    _source(spark, n=200).write.parquet(src_path)
    src = spark.read.parquet(src_path)
    status = jobs.blob_sink(f"{tmp_root}/out")(src, "probe")
    plan = plan_text(status)
    assert "BroadcastHashJoin" in plan and "MapInPandas" in plan
    assert "hashpartitioning" not in plan  # keys were shuffled and staged before; bodies never
    assert status.where("ok").count() == 5


def test_empty_inputs_do_no_work(spark, tmp_root):
    empty_src = _source(spark).where("false")
    led = L.Ledgers(f"{tmp_root}/state")
    rep = jobs.run_incremental(spark, empty_src, "c", "modified_id", led, jobs.blob_sink(f"{tmp_root}/out"))
    assert rep.counts["n_rows"] == 0 and not rep.committed
    os.makedirs(f"{tmp_root}/objs")
    rep = jobs.load_new(spark, f"{tmp_root}/objs", f"{tmp_root}/registry")
    assert rep.counts["new"] == 0 and rep.counts["inserted"] == 0
    reg = spark.read.parquet(f"{tmp_root}/registry")
    assert reg.count() == 0 and reg.columns == ["id", "guid", "filename", "document", "uploaded_to_s3"]
    rep = jobs.export_pending(spark, reg, f"{tmp_root}/out2", L.Ledgers(f"{tmp_root}/s2"))
    assert rep.counts["n_rows"] == 0


def test_state_root_is_the_same_for_every_session(spark):
    from blobferry.session import state_root

    first = state_root(spark)
    spark.sparkContext.setCheckpointDir(first.rpartition("/")[0])  # what another session does: a new folder below it
    assert state_root(spark) == first
