"""Metadata stays with the object, and counts only for the object it was written with."""

import os
import sys
import types

import pytest
from pyspark.sql import functions as F

from blobferry.plans import jobs
from blobferry.sinks.export import export_bodies
from blobferry.sinks.objects_format import register_sink
from blobferry.sources import metadata as M
from blobferry.sources.listing import list_all_objects, list_objects, register_sources
from blobferry.sources.paging import KeyStore


def docs(spark):
    return spark.createDataFrame([("a.pdf", "7", b"A"), ("d/b.pdf", None, b"BB"), ("d/ü c.pdf", "ä%1", b""), ("../x", "9", b"x"),
                                  (".blobferry-meta/y", "9", b"y")], "key string, policy string, body binary")


def found(spark, root):
    return {r.key: r.metadata for r in jobs.object_metadata(spark, root).collect()}


def test_metadata_is_read_back_from_the_store(spark, tmp_root):
    st = {r.key: r.error for r in export_bodies(docs(spark), tmp_root, metadata={"policy_id": "policy", "kind": F.lit("pdf")}).collect()}
    assert st["../x"] and st[".blobferry-meta/y"] == "reserved name" and st["a.pdf"] is None
    assert found(spark, tmp_root) == {"a.pdf": {"policy_id": "7", "kind": "pdf"}, "d/b.pdf": {"kind": "pdf"},
                                      "d/ü c.pdf": {"policy_id": "ä%1", "kind": "pdf"}}
    # Sidecars are no objects, in either listing.
    assert list_all_objects(spark, tmp_root).count() == 3
    assert {"a.pdf", "d/b.pdf"} <= {r.key for r in list_objects(spark, tmp_root).collect()} <= {"a.pdf", "d/b.pdf", "d/ü c.pdf"}
    register_sources(spark)
    assert spark.read.format("blobferry_listing").load(tmp_root).count() == 3


def test_a_replaced_object_has_no_metadata(spark, tmp_root):
    export_bodies(docs(spark).limit(3), tmp_root, metadata={"policy_id": "policy"}).collect()
    os.replace(_file(tmp_root, b"Z"), f"{tmp_root}/a.pdf")  # same size, another time
    assert found(spark, tmp_root)["a.pdf"] is None
    export_bodies(docs(spark).limit(1), tmp_root).collect()  # written again without
    assert found(spark, tmp_root)["a.pdf"] is None
    export_bodies(docs(spark).limit(1), tmp_root, metadata={"policy_id": "policy"}).collect()
    assert found(spark, tmp_root)["a.pdf"] == {"policy_id": "7"}
    os.remove(f"{tmp_root}/a.pdf")
    assert "a.pdf" not in found(spark, tmp_root)


def _file(root, data):
    path = f"{root}-stranger"
    with open(path, "wb") as f:
        f.write(data)
    os.utime(path, (1, 1))
    return path


def test_a_lost_write_leaves_no_wrong_metadata(tmp_root, monkeypatch):
    at = M.SidecarMeta(tmp_root)
    at.put("k", b"old", {"v": "1"})

    class Lost:
        """The store of a task that dies when it renames the body."""

        def __getattr__(self, name):
            return getattr(fs, name)

        def move(self, src, dst):
            if dst.endswith("/k") and M.META_FOLDER not in dst:
                raise OSError("executor lost")
            fs.move(src, dst)

    fs, at.fs = at.fs, Lost()
    with pytest.raises(OSError):
        at.put("k", b"new", {"v": "2"})
    at.fs = fs
    st = os.stat(f"{tmp_root}/k")
    assert at.get("k", st.st_size, st.st_mtime_ns // 1000) is None  # not 1, which is overwritten, nor 2
    at.put("k", b"new", {"v": "2"})
    st = os.stat(f"{tmp_root}/k")
    assert at.get("k", st.st_size, st.st_mtime_ns // 1000) == {"v": "2"}
    assert at.get("none", 0, 0) is None


def test_the_write_format_keeps_metadata(spark, tmp_root):
    register_sink(spark)
    docs(spark).limit(3).write.format("blobferry_objects").mode("append").option("path", tmp_root) \
        .option("metadataColumns", "policy").save()
    assert found(spark, tmp_root) == {"a.pdf": {"policy": "7"}, "d/b.pdf": {}, "d/ü c.pdf": {"policy": "ä%1"}}


def test_user_metadata_of_a_key_store(monkeypatch):
    """The client's calls, against a stand-in for the store: header values are ASCII, a missing key is None."""
    class ClientError(Exception):
        def __init__(self, status):
            self.response = {"ResponseMetadata": {"HTTPStatusCode": status}}

    monkeypatch.setitem(sys.modules, "botocore", types.ModuleType("botocore"))
    exc = types.ModuleType("botocore.exceptions")
    exc.ClientError = ClientError
    monkeypatch.setitem(sys.modules, "botocore.exceptions", exc)
    held = {}

    class Client:
        def put_object(self, Bucket, Key, Body, Metadata):
            assert all(v.isascii() for v in Metadata.values())
            held[Bucket, Key] = Body, Metadata

        def head_object(self, Bucket, Key):
            if Key == "base/broken":
                raise ClientError(500)
            if (Bucket, Key) not in held:
                raise ClientError(404)
            return {"Metadata": held[Bucket, Key][1]}

    at = M.NativeMeta(KeyStore("s3://box/base", Client()))
    at.put("a", b"x", {"policy_id": "12 = b", "name": "ä%20\n"})
    assert held["box", "base/a"][1]["policy_id"] == "12 = b"
    assert at.get("a", 1, 0) == {"policy_id": "12 = b", "name": "ä%20\n"}
    assert at.get("none", 1, 0) is None
    with pytest.raises(ClientError):
        at.get("broken", 1, 0)


def test_errors_and_odd_keys_stay_in_the_listing(spark, tmp_root):
    class Broken:
        def get(self, key, size, mtime):
            raise OSError("slow down")

    rows = spark.createDataFrame([("a", 1), (None, 1), ("../b", None)], "key string, size long").withColumn(
        "mtime", F.lit(None).cast("timestamp"))
    got = {r.key: (r.metadata, r.meta_error) for r in M.with_metadata(rows, tmp_root, opener=lambda root: Broken()).collect()}
    assert got == {"a": (None, "OSError: slow down"), None: (None, None), "../b": (None, None)}
    assert M.with_metadata(rows.limit(0), tmp_root).count() == 0
