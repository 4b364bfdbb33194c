"""Executor-side access to an object store root through ``pyarrow.fs``.

Used inside ``mapInPandas`` tasks (body reads and writes) and by the listing
data source. Local paths, ``file:`` URIs and any scheme pyarrow knows
(``s3://``, ``gs://``, ``hdfs://``) work the same way.
"""

from __future__ import annotations

import os


# Hadoop scheme names and the pyarrow scheme for the same store.
HADOOP_SCHEMES = {"s3a": "s3", "s3n": "s3"}
# Below a root: the metadata of its objects, where the store keeps none (blobferry.sources.metadata).
META_FOLDER = ".blobferry-meta"
# Below a root, each followed by an id: what a task is writing, until it is renamed to its key (blobferry.sinks.export).
WRITE_FOLDER = ".blobferry-writing-"


def is_reserved(name: str) -> bool:
    """An entry of a root that is none of its objects."""
    return name == META_FOLDER or name.startswith(WRITE_FOLDER)


def open_fs(root: str):
    """Return ``(filesystem, base_path)`` for a root path or URI."""
    from pyarrow import fs as pafs

    if root.startswith("file:"):
        root = root[len("file://"):] if root.startswith("file://") else root[len("file:"):]
    if "://" in root:
        scheme, rest = root.split("://", 1)
        fs, base = pafs.FileSystem.from_uri(f"{HADOOP_SCHEMES.get(scheme, scheme)}://{rest}")
        return fs, base.rstrip("/")
    return pafs.LocalFileSystem(), os.path.abspath(root).rstrip("/")


def qualified_root(root: str) -> str:
    """The root as Spark's file sources print it in ``path`` (``file:/abs``)."""
    if root.startswith("file://"):
        root = root[len("file://"):]
    elif root.startswith("file:"):
        root = root[len("file:"):]
    elif "://" in root:
        return root.rstrip("/")
    return "file:" + os.path.abspath(root).rstrip("/")


def check_name(name) -> str | None:
    """Why a relative object name is unsafe below a root, or None if it is fine."""
    if name is None or name == "":
        return "empty name"
    if name.startswith("/") or (name[0].isascii() and name[0].isalpha() and name[1:3] in (":/", ":\\")):
        return "absolute name"  # the rule of functions.keys.is_safe_name; a colon alone is a legal key
    if ".." in name.split("/"):
        return "name climbs out of the root"
    if is_reserved(name.split("/", 1)[0]):
        return "reserved name"
    return None
