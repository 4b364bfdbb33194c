"""Complete listings by page, with the key prefix given to the store.

A listing is a few rounds of Spark jobs over a *frontier*: folders still to be
opened or, in a store that pages through sorted keys, key ranges still to be
read. A task takes its part of the frontier and lists up to a budget of pages;
what it does not reach - folders it found, the rest of a range split at the
characters that follow - is the frontier of the next round. So a flat prefix of
any size is spread over the tasks, whichever way its keys are distributed, and
no task lists much more than its budget or one folder.

Folders outside the prefix are never opened. The driver sees counts only: each
round is written to the shared folder, objects and frontier alike.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobferry.session import scratch_path
from blobferry.sources.objectstore import HADOOP_SCHEMES, is_reserved, open_fs

PAGE = 1000  # keys of a page
PAGES_PER_TASK = 16  # pages a task lists before it hands the rest on
MAX_ROUNDS = 10_000  # far above any folder depth; guards against a loop of links
PAST = "\U0010ffff"  # sorts behind every character

ROUND_SCHEMA = "kind string, key string, size long, mtime timestamp, before string"


def in_prefix(folder: str, prefix: str) -> bool:
    """A folder (its key without a slash at the end; "" is the root) may hold keys with the prefix."""
    inside = f"{folder}/" if folder else ""
    return inside.startswith(prefix) or prefix.startswith(inside)


class FolderStore:
    """A store that lists one folder at a time: local disks, and any store ``pyarrow.fs`` knows."""

    ranged = False

    def __init__(self, root: str):
        from pyarrow import fs as pafs

        self.root = root
        self.fs, self.base = open_fs(root)
        self.local = isinstance(self.fs, pafs.LocalFileSystem)

    def exists(self) -> bool:
        from pyarrow import fs as pafs

        return self.fs.get_file_info(self.base).type != pafs.FileType.NotFound

    def entries(self, folder: str):
        """(key, size, microseconds of the last change, is a folder) of each entry. A folder that does not exist (any more) is empty.
        The folders of metadata sidecars and of writes under way are none of the objects'."""
        path = f"{self.base}/{folder}" if folder else self.base
        cut = len(self.base) + 1
        if self.local:  # entry by entry, whatever the folder's size
            try:
                with os.scandir(path) as found:
                    for e in found:
                        if not folder and is_reserved(e.name):
                            continue
                        if e.is_dir():
                            yield f"{folder}/{e.name}" if folder else e.name, 0, 0, True
                        elif e.is_file():
                            st = e.stat()
                            yield f"{folder}/{e.name}" if folder else e.name, st.st_size, st.st_mtime_ns // 1000, False
            except (FileNotFoundError, NotADirectoryError):
                if not folder:
                    raise
            return
        from pyarrow import fs as pafs

        for e in self.fs.get_file_info(pafs.FileSelector(path, recursive=False, allow_not_found=bool(folder))):
            if folder or not is_reserved(e.path[cut:]):
                yield e.path[cut:], e.size or 0, (e.mtime_ns or 0) // 1000, e.type == pafs.FileType.Directory


class KeyStore:
    """A store that pages through sorted keys (``list_objects_v2`` of the S3 protocol, through ``boto3``)."""

    ranged = True

    def __init__(self, root: str, client=None):
        scheme, _, rest = root.partition("://")
        if HADOOP_SCHEMES.get(scheme, scheme) != "s3":
            raise ValueError(f"not a root of an S3 store: {root}")
        self.bucket, _, base = rest.partition("/")
        self.base = base.strip("/") + "/" if base.strip("/") else ""
        if client is None:
            import boto3  # gated: only a cluster that lists such a store needs it

            client = boto3.client("s3")
        self.client = client

    def exists(self) -> bool:
        return True  # an empty prefix and a missing one are the same thing here

    def page(self, prefix: str, after: str | None, before: str | None, limit: int):
        """(objects, more): keys with the prefix, past ``after`` and before ``before``, ascending."""
        ask = {"Bucket": self.bucket, "Prefix": self.base + prefix, "MaxKeys": limit}
        if after is not None:
            ask["StartAfter"] = self.base + after
        got = self.client.list_objects_v2(**ask)
        rows = [(o["Key"][len(self.base):], o["Size"], int(o["LastModified"].timestamp() * 1_000_000))
                for o in got.get("Contents", [])]
        kept = [r for r in rows if before is None or r[0] < before]
        return kept, bool(got.get("IsTruncated")) and len(kept) == len(rows)


def open_store(root: str):
    """The store of a root: paged where keys are sorted and the client is there, else by folders."""
    if HADOOP_SCHEMES.get(root.partition("://")[0], root.partition("://")[0]) == "s3":
        try:
            return KeyStore(root)
        except ImportError:
            pass
    return FolderStore(root)


def list_folders(store: FolderStore, prefix: str, folders: list[str], budget: int):
    """Round rows of the folders and of what they hold, as far as the budget of entries goes."""
    todo, seen = list(reversed(folders)), 0
    while todo and seen < budget:
        for key, size, mtime, is_folder in store.entries(todo.pop()):
            seen += 1
            if is_folder:
                if in_prefix(key, prefix):
                    todo.append(key)
            elif key.startswith(prefix):
                yield "object", key, size, mtime, None
    for key in todo:
        yield "folder", key, None, None, None


def split_range(store, prefix: str, after: str | None, before: str | None):
    """The first key of each branch of a range as an object, and the ranges between them.

    Branches are told apart by the first character in which the range's keys differ:
    from each branch one request jumps behind all its keys to the next.
    """
    first, _ = store.page(prefix, after, before, 1)
    if not first:
        return
    depth, heads = len(prefix), first
    while True:
        while True:
            nxt, _ = store.page(prefix, heads[-1][0][:depth + 1] + PAST, before, 1)
            if not nxt:
                break
            heads = heads + nxt
        if len(heads) > 1 or depth >= len(first[0][0]):
            break
        depth += 1
    for (key, size, mtime), end in zip(heads, [*(h[0] for h in heads[1:]), before]):
        yield "object", key, size, mtime, None
        yield "range", key, None, None, end


def list_ranges(store, prefix: str, ranges: list[tuple], budget: int):
    """Round rows of the ranges ``(after, before)``, as far as the budget of keys goes."""
    for n, (after, before) in enumerate(ranges):
        more = True
        while more and budget > 0:
            rows, more = store.page(prefix, after, before, PAGE)
            budget -= PAGE
            for key, size, mtime in rows:
                yield "object", key, size, mtime, None
                after = key
        if more and n == 0:  # only a task's first range is known to be large
            yield from split_range(store, prefix, after, before)
        elif more:
            yield "range", after, None, None, before


def list_paged(spark: SparkSession, root: str, prefix: str = "",
               store: Callable[[str], object] | None = None, pages_per_task: int | None = None,
               tasks: int | None = None) -> DataFrame:
    """Every object below ``root`` whose key starts with ``prefix``: key, size, mtime.

    ``store`` opens the root in the driver and in tasks (default :func:`open_store`). Listed now, into
    a table in the shared folder; a root that does not exist raises ``FileNotFoundError``.
    """
    store = store or open_store
    budget = PAGE * (pages_per_task or PAGES_PER_TASK)
    tasks = tasks or 3 * spark.sparkContext.defaultParallelism
    opened = store(root)
    if not opened.exists():
        raise FileNotFoundError(f"listing root not found: {root}")
    ranged = opened.ranged

    def listed(batches):
        import pyarrow as pa

        at = store(root)
        schema = pa.schema([("kind", pa.string()), ("key", pa.string()), ("size", pa.int64()),
                            ("mtime", pa.timestamp("us", "UTC")), ("before", pa.string())])
        todo = [(k, b) for batch in batches for k, b in zip(*(batch.column(c).to_pylist() for c in ("key", "before")))]
        if not todo:
            return
        rows = list_ranges(at, prefix, todo, budget) if ranged else list_folders(at, prefix, [k for k, _ in todo], budget)
        page = []
        for row in rows:
            page.append(row)
            if len(page) == 10 * PAGE:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*page), schema)], schema=schema)
                page = []
        if page:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*page), schema)], schema=schema)

    # The deepest folder that all keys with the prefix lie in; a store of sorted keys takes the prefix itself.
    start = None if ranged else prefix.rpartition("/")[0]
    frontier = spark.range(1).select(F.lit(start).cast("string").alias("key"), F.lit(None).cast("string").alias("before")).coalesce(1)
    rounds = []
    for _ in range(MAX_ROUNDS):
        rounds.append(scratch_path(spark, "listing-round"))
        frontier.mapInArrow(listed, ROUND_SCHEMA).write.parquet(rounds[-1])
        rest = spark.read.schema(ROUND_SCHEMA).parquet(rounds[-1]).where("kind <> 'object'").select("key", "before")
        n = rest.count()
        if not n:
            break
        frontier = rest.repartition(min(n, tasks))
    else:
        raise RuntimeError(f"listing did not end after {MAX_ROUNDS} rounds: {root}")
    return spark.read.schema(ROUND_SCHEMA).parquet(*rounds).where("kind = 'object'").select("key", "size", "mtime")
