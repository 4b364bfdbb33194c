"""Bodies as numbered byte ranges, and what a read task holds."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from blobferry.sources import blobs
from blobferry.sources.listing import list_all_objects


def objects(root, bodies):
    os.makedirs(root, exist_ok=True)
    for k, b in bodies.items():
        with open(f"{root}/{k}", "wb") as f:
            f.write(b)
    return bodies


def test_ranges_cover_each_object_once(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(blobs, "TASK_CHUNKS", 3)
    bodies = objects(f"{tmp_root}/o", {f"{n}.bin": os.urandom(n) for n in (0, 1, 6, 7, 8, 14, 15, 1000)})
    listing = list_all_objects(spark, f"{tmp_root}/o").select("key", "size", F.lit("x").alias("kept_column"))
    chunks = blobs.read_chunks(listing, f"{tmp_root}/o", chunk_bytes=7)
    assert chunks.columns == ["key", "size", "kept_column", "chunk_no", "n_chunks", "offset", "content", "error"]
    rows = chunks.orderBy("key", "chunk_no").collect()
    for k, b in bodies.items():
        mine = [r for r in rows if r["key"] == k]
        assert b"".join(bytes(r["content"]) for r in mine) == b
        assert [r["chunk_no"] for r in mine] == list(range(max(1, -(-len(b) // 7)))) and {r["n_chunks"] for r in mine} == {len(mine)}
        assert [r["offset"] for r in mine] == [7 * r["chunk_no"] for r in mine] and all(len(r["content"]) <= 7 for r in mine)
    joined = {r["key"]: r for r in blobs.join_chunks(chunks).collect()}
    assert {k: (r["size"], r["sha1"], r["ok"]) for k, r in joined.items()} == {
        k: (len(b), hashlib.sha1(b).hexdigest(), True) for k, b in bodies.items()}


def test_failed_changed_and_unsafe_objects(spark, tmp_root):
    objects(f"{tmp_root}/o", {"a": b"0123456789", "b": b"abc", "c": b"0123456789", "d": b"abcd"})
    keys = spark.createDataFrame([("a", 10), ("b", 9), ("gone", 4), ("../a", 3), (None, 2), ("c", None), ("d", None)],
                                 "key string, size long")
    rows = blobs.read_chunks(keys, f"{tmp_root}/o", chunk_bytes=4).collect()
    got = {}
    for r in rows:
        got.setdefault(r["key"], []).append(r)
    assert [r["error"] for r in got["a"]] == [None] * 3 and [r["error"] for r in got["d"]] == [None]
    for k in ("b", "gone", "../a", None, "c"):  # shorter than listed; absent; refused; null; unknown size and longer than a range
        assert all(r["error"] and r["content"] is None for r in got[k]), k
    joined = {r["key"]: r for r in blobs.join_chunks(spark.createDataFrame(rows, blobs.read_chunks(keys, tmp_root).schema)).collect()}
    assert {k: r["ok"] for k, r in joined.items()} == {"a": True, "d": True, "b": False, "gone": False, "../a": False, None: False, "c": False}
    assert all(r["sha1"] is None and r["size"] is None for r in joined.values() if not r["ok"])
    none = blobs.read_chunks(keys.limit(0), f"{tmp_root}/o")
    assert none.count() == 0 and blobs.join_chunks(none).count() == 0


def test_missing_and_repeated_chunks_are_not_joined(spark):
    schema = "key string, chunk_no long, n_chunks long, content binary"
    rows = [("gap", 0, 3, b"a"), ("gap", 2, 3, b"c"), ("tail", 0, 2, b"a"), ("twice", 0, 2, b"a"), ("twice", 0, 2, b"a"),
            ("twice", 1, 2, b"b"), ("fine", 0, 2, b"a"), ("fine", 1, 2, b"b")]
    got = {r["key"]: r["ok"] for r in blobs.join_chunks(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"gap": False, "tail": False, "twice": False, "fine": True}


@pytest.mark.parametrize("threads", [1, 4])
def test_a_task_holds_one_output_batch_of_bodies(spark, tmp_root, monkeypatch, threads):
    """Output batches end soon after the bound, so a whole key batch is never held."""
    objects(f"{tmp_root}/o", {f"{k:03d}": bytes([k]) * 1000 for k in range(100)})
    monkeypatch.setattr(blobs, "OUTPUT_BATCH_BYTES", 5000)
    keys = spark.createDataFrame([(f"{k:03d}",) for k in range(100)], "key string").coalesce(1)
    held = blobs.read_bodies(keys, f"{tmp_root}/o", io_threads=threads).mapInPandas(
        lambda it: (p[["size"]].sum().to_frame().T.assign(n=len(p)) for p in it), "size long, n long").collect()
    assert sum(r["n"] for r in held) == 100
    rows = blobs.read_bodies(keys, f"{tmp_root}/o", io_threads=threads).collect()
    assert {r["key"]: bytes(r["content"]) for r in rows} == {f"{k:03d}": bytes([k]) * 1000 for k in range(100)}
