"""The command line runs each job in-process on the test session."""

import datetime as dt
import json
import os

from blobferry.__main__ import main


def _run(capsys, *args):
    assert main(list(args)) == 0
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_cli_round_trip(spark, tmp_root, capsys):
    objs = f"{tmp_root}/objs"
    os.makedirs(f"{objs}/d")
    for name, data in [("a.pdf", b"A"), ("d/b.pdf", b"BB"), ("c.txt", b"C")]:
        open(f"{objs}/{name}", "wb").write(data)
    assert _run(capsys, "count", "--root", objs)["n"] == 2
    reg = f"{tmp_root}/registry"
    state = f"{tmp_root}/state"
    rep = _run(capsys, "load-new", "--root", objs, "--registry", reg, "--state", state + "/load")
    assert rep["counts"]["inserted"] == 2
    rep = _run(capsys, "export-pending", "--registry", reg, "--target", f"{tmp_root}/out",
               "--target-prefix", "docs", "--state", state + "/push")
    assert rep["counts"]["n_ok"] == 2 and os.path.exists(f"{tmp_root}/out/docs/d/b.pdf")
    rep = _run(capsys, "export-pending", "--registry", reg, "--target", f"{tmp_root}/out",
               "--target-prefix", "docs", "--state", state + "/push")
    assert rep["counts"]["n_rows"] == 0  # nothing left pending
    os.remove(f"{objs}/a.pdf")
    rep = _run(capsys, "sync", "--registry", reg, "--root", objs, "--state", state + "/sync")
    assert rep["counts"] == {"existing": 2, "orphans": 1}
    # Compaction: the view (tombstones applied, exports marked) to a new path.
    rep = _run(capsys, "compact", "--registry", reg, "--new-registry", f"{tmp_root}/registry-v2",
               "--sync-state", state + "/sync", "--export-state", state + "/push")
    rows = spark.read.parquet(rep["registry"]).collect()
    assert [(r.filename, r.uploaded_to_s3) for r in rows] == [("d/b.pdf", True)]
    rep = _run(capsys, "compact", "--state", state + "/push", "--new-state", f"{tmp_root}/push-v2")
    assert spark.read.parquet(rep["state"] + "/status").count() == 2


def test_cli_incremental(spark, tmp_root, capsys):
    src = f"{tmp_root}/src"
    base = dt.datetime(2024, 1, 1)
    rows = [(i, i % 3, "c", "b", base + dt.timedelta(hours=i), f"doc{i}".encode()) for i in range(9)]
    spark.createDataFrame(rows, "ID bigint, POLICY_ID bigint, COMPANY string, BROKER string, "
                                "MODIFIED timestamp_ntz, BINDER_DOC binary").write.parquet(src)
    out = f"{tmp_root}/out"  # not there yet: the first run creates it
    args = ["export-incremental", "--source", src, "--target", out, "--ctx", "c",
            "--state", f"{tmp_root}/state"]
    assert _run(capsys, *args)["counts"]["n_ok"] == 3
    assert sorted(os.listdir(out)) == ["binder_0.pdf", "binder_1.pdf", "binder_2.pdf"]
    assert _run(capsys, *args)["counts"]["n_rows"] == 0
    _run(capsys, "compact", "--state", f"{tmp_root}/state", "--new-state", f"{tmp_root}/state2")
    again = args[:-1] + [f"{tmp_root}/state2"]
    assert _run(capsys, *again)["counts"]["n_rows"] == 0  # the mark moved with the state
    st = _run(capsys, "status", "--state", f"{tmp_root}/state", "--ctx", "c")
    assert st["runs"] == [{"run_no": 1, "n_rows": 3, "n_ok": 3, "n_skipped": 0, "n_failed": 0}]
    assert st["last_run_no"] == 1 and st["high_water"][1] == 8
    rep = _run(capsys, "export-json", "--source", src, "--out", f"{tmp_root}/json", "--ctx", "j",
               "--strategy", "composite", "--key-text", "--state", f"{tmp_root}/jstate")
    assert rep["counts"]["n_rows"] == 9


def test_cli_save_and_ingest(spark, tmp_root, capsys):
    objs = f"{tmp_root}/objs"
    os.makedirs(objs)
    for i in range(3):
        open(f"{objs}/f{i}.pdf", "wb").write(b"x" * (i + 1))
    reg = f"{tmp_root}/registry"
    _run(capsys, "load-new", "--root", objs, "--registry", reg, "--state", f"{tmp_root}/s1")
    spark.createDataFrame([(1,), (3,), (99,)], "id bigint").write.parquet(f"{tmp_root}/ids")
    rep = _run(capsys, "save", "--registry", reg, "--ids-table", f"{tmp_root}/ids", "--out", f"{tmp_root}/saved",
               "--state", f"{tmp_root}/s2")
    assert rep["counts"]["n_ok"] == 2 and sorted(os.listdir(f"{tmp_root}/saved")) == ["f0.pdf", "f2.pdf"]
    rep = _run(capsys, "ingest", "--root", objs, "--sink", f"{tmp_root}/sink", "--checkpoint", f"{tmp_root}/ck")
    assert rep["rows"] == 3


def test_cli_ingest_into_registry(spark, tmp_root, capsys):
    objs = f"{tmp_root}/objs"
    os.makedirs(objs)
    open(f"{objs}/a.pdf", "wb").write(b"A")
    rep = _run(capsys, "ingest", "--root", objs, "--registry", f"{tmp_root}/reg", "--checkpoint", f"{tmp_root}/ck")
    assert rep["inserted"] == 1
