"""Compaction rewrites the files that hold dead or newly marked rows, and no other."""

import os

import pytest

from blobferry.plans import jobs
from blobferry.sinks import ledgers as L
from blobferry.sources import compaction as C
from blobferry.sources import file_index as ix
from blobferry.sources import registry as R

SCHEMA = "id bigint, guid string, filename string, document binary, uploaded_to_s3 boolean"


def registry(spark, path, ids, files=6):
    rows = spark.createDataFrame([(i, f"g{i}", f"d/{i % 90}.pdf", f"body {i}".encode(), None if i % 4 == 0 else False) for i in ids], SCHEMA)
    rows.repartitionByRange(files, "id").write.mode("append").parquet(path)
    return path


def rows(df):
    return sorted(((r["id"], r["guid"], r["filename"], bytes(r["document"]), r["uploaded_to_s3"]) for r in df.collect()), key=lambda r: r[0])


def tomb(spark, *pairs):
    return spark.createDataFrame(list(pairs), "key string, id long")


def test_equals_the_view_and_leaves_other_files(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(C, "GROUP_BYTES", 200)
    path = registry(spark, f"{tmp_root}/reg", range(180))
    before = {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path)}
    gone = tomb(spark, ("d/3.pdf", 3), ("d/3.pdf", 1), ("d/5.pdf", None), ("none.pdf", 10))
    ok = spark.createDataFrame([("g1",), ("g4",), ("g3",), (None,), ("other",)], "guid string")
    # d/3.pdf up to id 3 (row 93 stays); d/5.pdf: rows 5 and 95
    whole = spark.read.parquet(path)
    want = rows(R.current_view(whole, ok_ledger=ok, tombstones=gone))
    got = C.compact_files(spark, path, gone, ok)
    assert got == {"files": 6, "rewritten": 2, "rows_removed": 3, "rows_marked": 2}
    flag = lambda rs: [(*r[:4], bool(r[4])) for r in rs]  # noqa: E731 - null and false are both pending
    assert flag(rows(R.read_registry(spark, path))) == flag(want) and len(want) == 177
    after = {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path)}
    assert {f: after[f] for f in before} == before  # nothing written over or removed
    live = R.live_files(spark, path)
    assert len(live) == 6 and sum("_rewritten" in f for f in live) == 2
    assert C.compact_files(spark, path, gone, ok)["rewritten"] == 0  # a second run has nothing to do
    assert ix.rows_by_id(spark, path, spark.createDataFrame([(5,), (3,), (1,), (95,), (93,)], "id long"), ["id"]).count() == 2


def test_rewritten_files_are_rewritten_again_and_appends_go_on(spark, tmp_root):
    path = registry(spark, f"{tmp_root}/reg", range(60), files=3)
    C.compact_files(spark, path, tomb(spark, ("d/1.pdf", 1)))
    registry(spark, path, range(60, 90), files=1)
    got = C.compact_files(spark, path, tomb(spark, ("d/1.pdf", 1), ("d/2.pdf", 2), ("d/70.pdf", 70)))
    assert got == {"files": 4, "rewritten": 2, "rows_removed": 2, "rows_marked": 0}
    assert [r[0] for r in rows(R.read_registry(spark, path))] == [i for i in range(90) if i not in (1, 2, 70)]
    all_gone = tomb(spark, *[(f"d/{i}.pdf", None) for i in range(90)])
    C.compact_files(spark, path, all_gone)
    assert R.read_registry(spark, path).count() == 0 and R.live_files(spark, path) == []
    registry(spark, path, [200], files=1)
    assert R.read_registry(spark, path).count() == 1


def test_a_run_that_stops_before_its_commit_changes_nothing(spark, tmp_root, monkeypatch):
    path = registry(spark, f"{tmp_root}/reg", range(30), files=2)
    want = rows(R.read_registry(spark, path))
    monkeypatch.setattr(C, "versions_path", lambda p: "unknown://nowhere/_versions")
    with pytest.raises(Exception):
        C.compact_files(spark, path, tomb(spark, ("d/1.pdf", None)))
    monkeypatch.undo()
    assert rows(R.read_registry(spark, path)) == want == rows(spark.read.parquet(path))


def test_nothing_to_do(spark, tmp_root):
    path = registry(spark, f"{tmp_root}/reg", range(10), files=2)
    assert C.compact_files(spark, path)["rewritten"] == 0
    assert C.compact_files(spark, path, spark.createDataFrame([], "key string, id long"))["rewritten"] == 0
    assert not os.path.exists(R.versions_path(path))


def test_ids_of_removed_rows_are_not_given_again(spark, tmp_root):
    """An object that comes back after its row was compacted away is not deleted by its old tombstone."""
    root, reg = f"{tmp_root}/objects", f"{tmp_root}/reg"
    os.makedirs(root)
    for k in "abc":
        open(f"{root}/{k}.pdf", "w").write(k)
    jobs.load_new(spark, root, reg)
    gone = tomb(spark, ("c.pdf", 3))
    assert C.compact_files(spark, reg, gone)["rows_removed"] == 1
    rep = jobs.load_new(spark, root, reg, tombstones=gone)
    assert rep.counts["existing_rows"] == 2 and rep.counts["inserted"] == 1
    view = R.current_view(R.read_registry(spark, reg), tombstones=gone)
    assert {r["filename"]: r["id"] for r in view.select("filename", "id").collect()} == {"a.pdf": 1, "b.pdf": 2, "c.pdf": 4}
    new = spark.createDataFrame([("gx", "x.pdf", b"x")], "guid string, filename string, document binary")
    C.compact_files(spark, reg, tomb(spark, ("c.pdf", 4)))
    assert R.append(spark, reg, new) == 1
    assert R.read_registry(spark, reg).agg({"id": "max"}).first()[0] == 5
    led = L.Ledgers(f"{tmp_root}/state")
    assert jobs.export_pending(spark, reg, f"{tmp_root}/out", led).counts["n_ok"] == 3
    assert sorted(os.listdir(f"{tmp_root}/out")) == ["a.pdf", "b.pdf", "x.pdf"]
