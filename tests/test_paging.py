"""Listing by pages: prefixes prune, flat folders are split, nothing is listed twice."""

import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from blobferry.sources import paging
from blobferry.sources.listing import list_all_objects, register_sources

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not import tests


def tree(root, names):
    for name in names:
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(name.encode())


def counting_store(log):
    """A store that notes each folder it opens as a file name in ``log``."""
    from blobferry.sources.paging import FolderStore

    class Counting(FolderStore):
        def entries(self, folder):
            import uuid

            open(os.path.join(log, (folder.replace("/", "+") or "ROOT") + "=" + uuid.uuid4().hex), "w").close()
            yield from super().entries(folder)

    return Counting


NAMES = ["r.pdf", "a/1.pdf", "a/b/2.pdf", "a/b/c/3.pdf", "ab/4.pdf", "ab/x/5.pdf", "b/6.pdf", "b/a/7.pdf", "abc.pdf"]


@pytest.mark.parametrize("prefix", ["", "a", "a/", "ab", "a/b", "a/b/", "a/b/c/3", "zz", "b/zz/q", "r.pdf"])
def test_folders_outside_the_prefix_are_never_opened(spark, tmp_root, prefix):
    root, log = f"{tmp_root}/in", f"{tmp_root}/log"
    os.makedirs(log)
    tree(root, NAMES)
    got = paging.list_paged(spark, root, prefix, store=counting_store(log)).collect()
    assert sorted((r.key, r.size) for r in got) == sorted((n, len(n)) for n in NAMES if n.startswith(prefix))
    opened = [f.rpartition("=")[0].replace("+", "/") for f in os.listdir(log)]
    assert len(opened) == len(set(opened))
    for folder in opened:
        inside = "" if folder == "ROOT" else folder + "/"
        assert inside.startswith(prefix) or prefix.startswith(inside)


@pytest.mark.parametrize("pages", [1, 16])
def test_many_folders_over_rounds(spark, tmp_root, monkeypatch, pages):
    """A budget far below the number of entries: the rest of the folders goes to the next rounds."""
    monkeypatch.setattr(paging, "PAGE", 5)
    names = [f"d{k % 13}/e{k % 5}/f{k}.bin" for k in range(300)] + [f"flat/{k}" for k in range(200)]
    tree(tmp_root, names)
    got = [r.key for r in paging.list_paged(spark, tmp_root, pages_per_task=pages).collect()]
    assert sorted(got) == sorted(names)


def fake_client(keys, log=None):
    """Pages through sorted keys as the S3 protocol does."""
    import datetime as dt

    class Client:
        def list_objects_v2(self, Bucket, Prefix, MaxKeys, StartAfter=""):
            found = sorted(k for k in keys if k.startswith(Prefix) and k > StartAfter)
            if log is not None:
                import uuid

                open(os.path.join(log, f"{len(found[:MaxKeys])}={uuid.uuid4().hex}"), "w").close()
            when = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
            return {"Contents": [{"Key": k, "Size": len(k), "LastModified": when} for k in found[:MaxKeys]],
                    "IsTruncated": len(found) > MaxKeys}

    return Client()


def shapes():
    rng = random.Random(1)
    yield "numbered", [f"base/doc_{k:06d}.pdf" for k in range(3000)]
    yield "nested names", [("base/" + "ab" * k) for k in range(1, 60)] + ["base/" + "ab" * k + "/x" for k in range(60)]
    yield "one hot branch", ["base/a"] + [f"base/hot/{'q' * 30}{k}" for k in range(2500)] + ["base/z", "other/1"]
    yield "any characters", ["base/" + "".join(rng.choice("aé漢😀 -\U0010ffff") for _ in range(rng.randrange(1, 5))) + f"{k}" for k in range(600)]


@pytest.mark.parametrize("name,keys", list(shapes()))
@pytest.mark.parametrize("prefix", ["", "h", "doc_0010"])
def test_ranges_of_sorted_keys_are_split_without_loss(name, keys, prefix):
    """Rounds as a queue: every key once, and no step lists more than its budget and its splits."""
    store = paging.KeyStore("s3a://bucket/base/", client=fake_client(keys))
    todo, got, steps = [(None, None)], [], 0
    while todo:
        steps += 1
        part, todo = todo[:3], todo[3:]
        for kind, key, size, mtime, before in paging.list_ranges(store, prefix, part, 200):
            if kind == "object":
                got.append(key)
            else:
                todo.append((key, before))
    assert sorted(got) == sorted({k[5:] for k in keys if k.startswith("base/" + prefix)})
    assert steps < 400


def test_flat_prefix_is_listed_by_many_tasks(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(paging, "PAGE", 50)
    log = f"{tmp_root}/log"
    os.makedirs(log)
    keys = [f"in/doc_{k:05d}" for k in range(2000)] + ["out/1"]
    make, page = fake_client, paging.PAGE

    def opener(root):
        from blobferry.sources import paging as here

        here.PAGE = page
        return here.KeyStore(root, client=make(keys, log))

    got = paging.list_paged(spark, "s3://bucket/in", "doc_0", store=opener, pages_per_task=2).collect()
    assert sorted(r.key for r in got) == sorted(k[3:] for k in keys if k.startswith("in/doc_0"))
    assert max(int(f.partition("=")[0]) for f in os.listdir(log)) <= page  # every request was a page


def test_missing_root_raises_and_empty_root_is_empty(spark, tmp_root):
    with pytest.raises(FileNotFoundError):
        list_all_objects(spark, f"{tmp_root}/nope")
    assert list_all_objects(spark, tmp_root).collect() == []


def test_data_source_takes_the_prefix(spark, tmp_root):
    tree(tmp_root, NAMES)
    register_sources(spark)
    df = spark.read.format("blobferry_listing").option("minPartitions", "6").load(tmp_root)
    assert sorted(r.key for r in df.collect()) == sorted(NAMES)
    assert sorted(r.key for r in df.where(F.col("key").startswith("a/")).collect()) == [n for n in sorted(NAMES) if n[:2] == "a/"]
    os.chmod(f"{tmp_root}/b", 0)
    try:
        got = df.where(F.col("key").startswith("ab") & F.col("key").endswith(".pdf")).collect()
    finally:
        os.chmod(f"{tmp_root}/b", 0o755)
    assert sorted(r.key for r in got) == ["ab/4.pdf", "ab/x/5.pdf", "abc.pdf"]
