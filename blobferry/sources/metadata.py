"""Metadata that stays with an object: a few named texts, such as its policy id.

A store of the S3 protocol keeps them on the object itself (user metadata, written by the
same request as the body). ``pyarrow.fs`` hands only a few standard headers on, so this goes
through ``boto3`` where that is there. Every other store gets a *sidecar*: a small JSON file under
``.blobferry-meta/`` below the root, which listings leave out and no object may be named after. A sidecar
also holds the size and time of the body it was written for and counts only while
the object still has both, so that an object replaced by someone else has none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blobferry.sources.objectstore import META_FOLDER, check_name, open_fs
from blobferry.sources.paging import KeyStore, open_store

IO_THREADS = 8  # requests in flight per task on a remote store
PLAIN = "".join(map(chr, range(32, 127))).replace("%", "")  # header values are ASCII; the rest goes as %XX


class NativeMeta:
    """Metadata as the store keeps it on the object."""

    def __init__(self, store: KeyStore):
        self.store = store

    def put(self, key: str, body: bytes, meta: dict[str, str]) -> None:
        self.store.client.put_object(Bucket=self.store.bucket, Key=self.store.base + key, Body=body,
                                     Metadata={k: quote(v, safe=PLAIN) for k, v in meta.items()})

    def get(self, key: str, size: int, mtime: int) -> dict[str, str] | None:
        """None: the object is gone or was written without metadata."""
        from botocore.exceptions import ClientError  # comes with boto3

        try:
            found = self.store.client.head_object(Bucket=self.store.bucket, Key=self.store.base + key)
        except ClientError as e:
            if e.response["ResponseMetadata"]["HTTPStatusCode"] == 404:
                return None
            raise
        return {k: unquote(v) for k, v in found.get("Metadata", {}).items()} or None


class SidecarMeta:
    """Metadata in a file beside the objects."""

    def __init__(self, root: str):
        from pyarrow import fs as pafs

        self.fs, self.base = open_fs(root)
        self.local = isinstance(self.fs, pafs.LocalFileSystem)

    def _replace(self, path: str, body: bytes, before_move: Callable[[str], None] | None = None) -> None:
        """The whole file or none of it: a hidden temporary name, then a rename; elsewhere one PUT."""
        folder, _, name = path.rpartition("/")
        if not self.local:
            with self.fs.open_output_stream(path) as out:
                out.write(body)
            return
        self.fs.create_dir(folder, recursive=True)
        tmp = f"{folder}/.{name}.{uuid.uuid4().hex}.part"
        with self.fs.open_output_stream(tmp) as out:
            out.write(body)
        if before_move:
            before_move(tmp)
        self.fs.move(tmp, path)

    def put(self, key: str, body: bytes, meta: dict[str, str]) -> None:
        # A task that is lost between the two writes leaves a sidecar that does not fit its
        # object and so counts for nothing, until the retried task writes both again.
        path = f"{self.base}/{key}"

        def sidecar(written: str) -> None:
            at = self.fs.get_file_info(written).mtime_ns // 1000
            self._replace(f"{self.base}/{META_FOLDER}/{key}",
                          json.dumps({"size": len(body), "mtime": at, "metadata": meta}).encode())

        if self.local:
            self._replace(path, body, before_move=sidecar)  # a rename keeps the time
        else:
            self._replace(path, body)
            sidecar(path)

    def get(self, key: str, size: int, mtime: int) -> dict[str, str] | None:
        try:
            with self.fs.open_input_stream(f"{self.base}/{META_FOLDER}/{key}") as src:
                kept = json.loads(src.read())
        except (FileNotFoundError, NotADirectoryError, IsADirectoryError):
            return None
        return kept["metadata"] if (kept["size"], kept["mtime"]) == (size, mtime) else None


def open_meta(root: str) -> NativeMeta | SidecarMeta:
    """Where the metadata of objects below ``root`` is kept."""
    store = open_store(root)
    return NativeMeta(store) if isinstance(store, KeyStore) else SidecarMeta(root)


def with_metadata(listing: DataFrame, root: str, opener: Callable[[str], object] = open_meta,
                  io_threads: int | None = None) -> DataFrame:
    """The listing (``key, size, mtime``) with ``metadata map<string,string>`` as the store holds it, and ``meta_error``.

    One small request per object, in the tasks that hold the listing's rows. Null metadata:
    the object has none, or (sidecars) is no longer the one it was written for. An object that could not be
    asked has its error in ``meta_error``. Null and unsafe keys are kept, without metadata.
    """
    remote = "://" in root and not root.startswith("file:")
    n_threads = io_threads or (IO_THREADS if remote else 1)
    rows = listing.select("key", "size", F.unix_micros("mtime").alias("mtime"))

    def ask(batches):
        from concurrent.futures import ThreadPoolExecutor

        import pyarrow as pa

        at = opener(root)

        def one(row):
            if check_name(row[0]):
                return None, None
            try:
                found = at.get(*row)
                return (None if found is None else list(found.items())), None
            except Exception as ex:  # noqa: BLE001 - kept per key
                return None, f"{type(ex).__name__}: {ex}"

        with ThreadPoolExecutor(max_workers=n_threads) as pool:
            for b in batches:
                cols = [b.column(i).to_pylist() for i in range(3)]
                got = list((pool.map if n_threads > 1 else map)(one, zip(*cols)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.array([m for m, _ in got], pa.map_(pa.string(), pa.string())),
                     pa.array([e for _, e in got], pa.string())], names=["key", "size", "mtime", "metadata", "meta_error"])

    out = rows.mapInArrow(ask, "key string, size long, mtime long, metadata map<string,string>, meta_error string")
    return out.withColumn("mtime", F.timestamp_micros("mtime"))
