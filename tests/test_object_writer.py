"""Objects are written away from the folder they end up in, so that tasks do not wait for each other there."""

import os

from blobferry.sinks.export import ObjectWriter, export_bodies
from blobferry.sources.listing import list_all_objects
from blobferry.sources.objectstore import WRITE_FOLDER


def test_target_folder_sees_whole_objects_only(tmp_root):
    writer, other = ObjectWriter(tmp_root), ObjectWriter(tmp_root)
    seen, write = [], writer._write

    def spy(path, body):
        write(path, body)
        seen.append((os.path.dirname(path), sorted(f for f in os.listdir(tmp_root) if not f.startswith(WRITE_FOLDER))))

    writer._write = spy
    for key, body in (("a", b"1"), ("b", b"2"), ("x/y/c", b"3"), ("a", b"new")):
        writer.put(key, body)
    other.put("d", b"4")
    assert [names for _, names in seen] == [[], ["a"], ["a", "b"], ["a", "b", "x"]]
    assert {folder for folder, _ in seen} == {writer.own} and other.own != writer.own
    writer.close()
    assert not os.path.exists(writer.own) and os.path.exists(other.own)
    other.close()
    assert {k: open(os.path.join(tmp_root, k), "rb").read() for k in ("a", "b", "x/y/c", "d")} \
        == {"a": b"new", "b": b"2", "x/y/c": b"3", "d": b"4"}


def test_what_a_lost_task_leaves_is_no_object(spark, tmp_root):
    lost = ObjectWriter(tmp_root)
    lost.put("whole", b"1")
    lost._write(f"{lost.own}/half", b"2")  # no rename, no close
    long = "n" * 250  # the temporary name has no room for the object's own
    df = spark.createDataFrame([(long, b"3"), ("f/z", b"4"), ("whole/under", b"5")], "key string, body binary")
    status = {r["key"]: r["error"] for r in export_bodies(df, tmp_root).collect()}
    assert status[long] is None and status["f/z"] is None and status["whole/under"]  # a file is no folder: kept per key
    assert sorted(r["key"] for r in list_all_objects(spark, tmp_root).collect()) == sorted(["whole", long, "f/z"])
