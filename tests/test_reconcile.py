"""Source, own writes and live listing compared three ways."""

import os

import pytest
from pyspark.sql import functions as F

from blobferry.operators import sync
from blobferry.plans import jobs
from blobferry.sinks import ledgers as L
from blobferry.sources.blobs import hash_objects
from blobferry.sources.listing import list_all_objects
from conftest import plan_text

FACTS = "key string, size long, sha1 string"


def test_every_state(spark):
    src = spark.createDataFrame([("absent", 1, "a"), ("removed", 1, "a"), ("unknown", 1, "a"), ("known", 1, "a"), ("size", 1, "a"),
                                 ("hash", 1, "a"), ("back", 1, "a"), ("changed", 1, "b"), ("same", 1, "a"), ("nohash", 1, "a")], FACTS)
    own = spark.createDataFrame([(k, 1, "a") for k in ("removed", "size", "hash", "changed", "same", "forgotten", "both")]
                                + [("back", 1, "old"), ("nohash", 1, None)], FACTS)
    live = spark.createDataFrame([("unknown", 1, None), ("known", 1, "a"), ("size", 2, None), ("hash", 1, "z"), ("back", 1, "a"),
                                  ("changed", 1, None), ("same", 1, None), ("same", 1, None), ("stray", 1, None), ("both", 1, None),
                                  ("nohash", 1, None)], FACTS)
    got = {r.key: (r.state, r.action) for r in sync.reconcile(src, own, live).collect()}
    new, changed, skip, none = "upload_new", "upload_changed", "skip", "none"
    assert got == {"absent": ("absent", new), "removed": ("removed", new), "unknown": ("unknown", changed), "known": ("unknown", skip),
                   "size": ("replaced", changed), "hash": ("replaced", changed), "back": ("replaced", skip),
                   "changed": ("changed", changed), "same": ("same", skip), "stray": ("stray", none), "forgotten": ("forgotten", none),
                   "both": ("stray", none), "nohash": ("changed", changed)}


def test_one_shuffle_and_extra_columns(spark):
    src = spark.createDataFrame([("a", 1, "x", 5), (None, 2, None, 6)], FACTS + ", id long")
    live = spark.createDataFrame([("a", 1)], "key string, size long")
    plan = sync.reconcile(src, None, live)
    assert sorted(map(tuple, plan.select("key", "id", "action").collect()), key=str) == [("a", 5, "upload_changed"), (None, 6, "upload_new")]
    wide = sync.reconcile(src.hint("merge"), src.drop("id"), live)
    assert plan_text(wide, "simple").count("Exchange hashpartitioning") == 1
    assert sync.reconcile(src.limit(0), src.limit(0), live.limit(0)).count() == 0


def source(spark, change=None):
    rows = [(i, f"P{i}", f"2024-01-{i + 1:02d}", (b"new!" if i == change else f"body{i}".encode())) for i in range(6)]
    return spark.createDataFrame(rows, "ID long, POLICY_ID string, MODIFIED string, BINDER_DOC binary").withColumn(
        "MODIFIED", F.col("MODIFIED").cast("timestamp"))


@pytest.mark.parametrize("verify", [False, True])
def test_export_writes_what_is_gone_or_not_ours(spark, tmp_root, verify):
    out, led = f"{tmp_root}/out", L.Ledgers(f"{tmp_root}/state")
    jobs.run_incremental(spark, source(spark), "first", "modified_id", led, jobs.blob_sink(out))
    os.remove(f"{out}/binder_P0.pdf")
    for name, data in (("P1", b"other size"), ("P2", b"BODY2"), ("stranger", b"s")):
        with open(f"{out}/binder_{name}.pdf", "wb") as f:
            f.write(data)
    own = L.target_state(spark, led.status)
    sink = jobs.blob_sink(out, target_listing=list_all_objects(spark, out), compare_sha1=True, written=own, verify=verify)
    rep = jobs.run_incremental(spark, source(spark, change=3), "second", "modified_id", L.Ledgers(f"{tmp_root}/state2"), sink)
    held = {f: open(f"{out}/{f}", "rb").read() for f in os.listdir(out)}
    # P2 has the size we wrote: only a look at the object itself tells that it is not ours.
    assert rep.counts["n_ok"] == (4 if verify else 3) and rep.counts["n_skipped"] == (2 if verify else 3)
    want = {f"binder_P{i}.pdf": f"body{i}".encode() for i in range(6)} | {"binder_P3.pdf": b"new!", "binder_stranger.pdf": b"s"}
    assert held == (want if verify else want | {"binder_P2.pdf": b"BODY2"})


def test_hashes_where_the_objects_are(spark, tmp_root):
    with open(f"{tmp_root}/a", "wb") as f:
        f.write(b"x" * 5000)
    open(f"{tmp_root}/empty", "wb").close()
    keys = spark.createDataFrame([("a", 5000), ("empty", 0), ("none", 1), ("../a", 1), (None, 1), ("empty", 3)], "key string, size long")
    got = sorted(((r.key, r.size, r.sha1, r.error is None) for r in hash_objects(keys, tmp_root, block=999).collect()), key=str)
    import hashlib

    sha = lambda b: hashlib.sha1(b).hexdigest()
    assert got == sorted([("a", 5000, sha(b"x" * 5000), True), ("empty", 0, sha(b""), True), ("none", 1, None, False),
                          ("../a", 1, None, False), (None, 1, None, False), ("empty", 3, None, False)], key=str)
    assert hash_objects(keys.limit(0), tmp_root).count() == 0
    plan = plan_text(hash_objects(keys, tmp_root), "simple")  # the keys are spread, no body is: nothing is exchanged above the read
    assert plan.index("MapInArrow") < plan.index("Exchange")
