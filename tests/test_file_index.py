"""Lookups that open only what holds wanted rows, and never shuffle a body."""

import os
import random

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from blobferry.operators import sync
from blobferry.plans import jobs
from blobferry.sinks import ledgers as L
from blobferry.sources import file_index as ix

SCHEMA = "id bigint, guid string, filename string, document binary, uploaded_to_s3 boolean"


def registry(spark, path, ids, files=8, by_id=True):
    rows = spark.createDataFrame([(i, f"g{i}-{k}", f"d/{i}.pdf", f"body {i}".encode(), False) for k, i in enumerate(ids)], SCHEMA)
    rows = rows.repartitionByRange(files, "id") if by_id else rows.repartition(files)
    rows.write.option("parquet.block.size", "4096").mode("append").parquet(path)
    return path


def found(df):
    return sorted((r["id"], bytes(r["document"])) for r in df.collect())


def ids_of(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id bigint")


@pytest.mark.parametrize("by_id", [True, False])
def test_lookup_equals_a_filter(spark, tmp_root, by_id, monkeypatch):
    """Sparse, negative, missing, null and repeated ids; ids in many blocks; rows that share an id."""
    monkeypatch.setattr(ix, "BLOCK_IDS", 7)
    rng = random.Random(1)
    have = [rng.randrange(-500, 5000) * 3 for _ in range(900)]
    path = registry(spark, f"{tmp_root}/reg", have, by_id=by_id)
    want = rng.sample(have, 60) + [1, 10 ** 15, -10 ** 15, None, have[0], have[0]]
    got = ix.rows_by_id(spark, path, ids_of(spark, want), per_task=5)
    assert got.columns == ["id", "guid", "filename", "document", "uploaded_to_s3"]
    assert found(got) == sorted((i, f"body {i}".encode()) for i in have if i in set(want))
    assert ix.rows_by_id(spark, path, ids_of(spark, [1, None])).collect() == []
    assert ix.rows_by_id(spark, path, ids_of(spark, []), ["guid"]).collect() == []


def test_only_files_in_range_are_opened(spark, tmp_root):
    path = registry(spark, f"{tmp_root}/reg", range(800))
    index = ix.refresh(spark, path).collect()
    wanted = {r["file"] for r in index if r["lo"] <= 105 <= r["hi"]}
    assert len(wanted) == 1 and len({r["file"] for r in index}) == 8
    for f in os.listdir(path):  # any other file would fail to open
        if f.endswith(".parquet") and not any(w.endswith(f) for w in wanted):
            open(os.path.join(path, f), "wb").write(b"not parquet")
            os.path.exists(os.path.join(path, f".{f}.crc")) and os.remove(os.path.join(path, f".{f}.crc"))
    at = ix.located(spark, path, ids_of(spark, [105]), 10)
    assert {r["file"] for r in at.collect()} == wanted


def test_index_follows_appends_and_replaced_files(spark, tmp_root):
    path = registry(spark, f"{tmp_root}/reg", range(100), files=2)
    first = {r["file"] for r in ix.refresh(spark, path).collect()}
    registry(spark, path, range(100, 200), files=2)
    second = ix.refresh(spark, path)
    assert len({r["file"] for r in second.collect()} - first) == 2
    assert second.agg(F.sum("n_rows")).first()[0] == 200
    assert spark.read.parquet(path).count() == 200  # the index is no part of the table
    gone = next(iter(first))
    os.remove(gone.removeprefix("file://").removeprefix("file:"))
    assert gone not in {r["file"] for r in ix.refresh(spark, path).collect()}


def test_no_body_above_an_exchange_at_any_size(spark, tmp_root, monkeypatch):
    path = registry(spark, f"{tmp_root}/reg", range(300))
    monkeypatch.setattr(sync, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(jobs, "OBJECTS_PER_TASK", 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(ix.rows_by_id(spark, path, ids_of(spark, range(50)), per_task=jobs.OBJECTS_PER_TASK))
        lines = plan.splitlines()
        moved = [lines[k + 1] for k, line in enumerate(lines) if line.startswith("(") and ") Exchange" in line]
        assert moved and all(x.startswith("Input") and "document" not in x for x in moved)
        assert all("document" not in line for line in lines if "ReadSchema" in line)
        led = L.Ledgers(f"{tmp_root}/state")
        rep = jobs.export_pending(spark, path, f"{tmp_root}/out", led)
        assert rep.counts["n_ok"] == 300
        saved = jobs.save_documents(spark, path, ids_of(spark, [5, 7, 7, None]), f"{tmp_root}/saved", led)
        assert saved.counts["n_ok"] == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert open(f"{tmp_root}/saved/d/5.pdf", "rb").read() == b"body 5"


def test_pending_by_path_equals_pending_by_frame(spark, tmp_root):
    path = registry(spark, f"{tmp_root}/reg", range(40), files=3)
    led = L.Ledgers(f"{tmp_root}/state")
    first = jobs.export_pending(spark, path, f"{tmp_root}/out", led, fail=F.col("id") % 10 == 0)
    assert (first.counts["n_ok"], first.counts["n_failed"]) == (36, 4)
    again = jobs.export_pending(spark, path, f"{tmp_root}/out", led, ok_ledger=L.ok_guids(spark, led.status))
    assert again.counts["n_ok"] == 4


def test_loaded_registries_are_laid_out_by_id(spark, tmp_root):
    root = f"{tmp_root}/objects"
    os.makedirs(root)
    for k in range(400):
        open(f"{root}/{k:04d}.pdf", "w").write(str(k))
    jobs.load_new(spark, root, f"{tmp_root}/reg")
    index = sorted((r["lo"], r["hi"]) for r in ix.refresh(spark, f"{tmp_root}/reg").collect() if r["lo"] is not None)
    assert len(index) > 1 and all(a[1] < b[0] for a, b in zip(index, index[1:]))
