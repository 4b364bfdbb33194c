"""Blob export: write each row's body to ``root/key`` from the executors.

Sizes and hashes are computed JVM-side first; the Python task only moves
bytes. Each input row yields one status row (ok / skipped / error), and the
caller writes those rows to the status ledger in a single action, because
every action on a ``mapInPandas`` frame would run the writes again. Keys are
deterministic and writes replace the object, so a retried task is harmless.
"""

from __future__ import annotations

import itertools
import json
import time
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blobferry.functions import keys as K
from blobferry.sources.metadata import open_meta
from blobferry.sources.objectstore import WRITE_FOLDER, check_name, open_fs

STATUS_SCHEMA = ("key string, src_id bigint, guid string, policy_id string, size bigint, "
                 "sha1 string, ok boolean, skipped boolean, error string, elapsed_s double")


# Concurrent writes per task on a remote store, which answers each PUT with a
# latency a single thread would wait out. Local disks get one thread (measured:
# more threads only add contention for small files).
IO_THREADS = 8


class ObjectWriter:
    """Puts bodies below a root, each whole or not at all; one writer for a task.

    On a local disk a body is written in a folder that only this writer uses and
    renamed to its key: tasks that put objects into one folder wait for each other
    at the rename only. Listings leave such folders out, so what a lost executor leaves
    is never mistaken for an object.
    """

    def __init__(self, root: str):
        self.fs, self.base = open_fs(root)
        self.local = "://" not in root or root.startswith("file:")
        self.own = f"{self.base}/{WRITE_FOLDER}{uuid.uuid4().hex}"
        self.number = itertools.count()
        self.made = False

    def _write(self, path: str, body: bytes) -> None:
        with self.fs.open_output_stream(path) as out:
            out.write(body)

    def put(self, key: str, body: bytes) -> None:
        target = f"{self.base}/{key}"
        if not self.local:
            return self._write(target, body)  # one PUT: atomic on object stores
        if not self.made:
            self.fs.create_dir(self.own, recursive=True)
            self.made = True
        tmp = f"{self.own}/{next(self.number)}"
        self._write(tmp, body)
        try:
            self.fs.move(tmp, target)  # rename: readers never see half a body
        except FileNotFoundError:  # the first object of its folder
            self.fs.create_dir(target.rpartition("/")[0], recursive=True)
            self.fs.move(tmp, target)

    def close(self) -> None:
        if self.made:
            self.fs.delete_dir(self.own)


def export_bodies(df: DataFrame, root: str, key: str | Column = "key",
                  body: str | Column = "body", src_id: str | Column | None = None,
                  guid: str | Column | None = None,
                  policy_id: str | Column | None = None, skip: Column | None = None,
                  fail: Column | None = None, io_threads: int | None = None,
                  metadata: dict[str, str | Column] | None = None) -> DataFrame:
    """Status rows after writing bodies to ``root``.

    ``skip`` marks rows not to write (target already equal); ``fail`` is a
    fault-injection predicate for tests (those rows report an error and are
    not written). Unsafe names (absolute, ``..``) are refused per row. Each
    task keeps ``io_threads`` writes in flight. ``metadata`` (name -> column) is
    kept with each object (:mod:`blobferry.sources.metadata`); a null value is left out.
    """
    c = K._c
    plan = df.select(
        c(key).cast("string").alias("key"),
        # ids travel as text: a pandas column of integers with nulls is float and rounds above 2^53
        (c(src_id).cast("bigint") if src_id is not None else F.lit(None)).cast("string").alias("src_id"),
        (c(guid).cast("string") if guid is not None else F.lit(None).cast("string")).alias("guid"),
        (c(policy_id).cast("string") if policy_id is not None
         else F.lit(None).cast("string")).alias("policy_id"),
        K.byte_length(body).alias("size"),
        K.body_sha1(body).alias("sha1"),
        (skip if skip is not None else F.lit(False)).alias("_skip"),
        (fail if fail is not None else F.lit(False)).alias("_fail"),
        # Null values are left out of the JSON; without the option nothing is kept with an object.
        (F.to_json(F.struct(*[c(v).cast("string").alias(n) for n, v in metadata.items()])) if metadata
         else F.lit(None).cast("string")).alias("_meta"),
        c(body).cast("binary").alias("_body"),
    )
    keeps = bool(metadata)
    local = "://" not in root or root.startswith("file:")
    io_threads = io_threads or (1 if local else IO_THREADS)

    def _one(writer, at, k, b, sk, fl, meta):
        """(ok, skipped, error, seconds) of one row."""
        if bool(sk):
            return True, True, None, 0.0
        t0 = time.perf_counter()
        e = check_name(k)
        if e is None and b is None:
            e = "no body"
        if e is None and bool(fl):
            e = "injected failure"
        if e is None:
            try:
                if meta is not None:
                    at.put(k, bytes(b), json.loads(meta))
                else:
                    writer.put(k, bytes(b))
            except Exception as ex:  # noqa: BLE001 - kept per key
                e = f"{type(ex).__name__}: {ex}"
        return e is None, False, e, round(time.perf_counter() - t0, 2)

    def _export(batches):
        from concurrent.futures import ThreadPoolExecutor

        writer = ObjectWriter(root)
        at = open_meta(root) if keeps else None
        pool = ThreadPoolExecutor(max_workers=io_threads) if io_threads > 1 else None
        run = pool.map if pool else map  # one thread: a plain loop, no futures
        try:
            for pdf in batches:
                res = list(run(lambda r: _one(writer, at, *r),
                               zip(pdf["key"], pdf["_body"], pdf["_skip"], pdf["_fail"], pdf["_meta"])))
                yield pd.DataFrame({
                    "key": pdf["key"], "src_id": pdf["src_id"], "guid": pdf["guid"],
                    "policy_id": pdf["policy_id"], "size": pdf["size"], "sha1": pdf["sha1"],
                    "ok": [r[0] for r in res], "skipped": [r[1] for r in res],
                    "error": [r[2] for r in res], "elapsed_s": [r[3] for r in res]})
        finally:
            if pool:
                pool.shutdown()
            writer.close()

    return plan.mapInPandas(_export, STATUS_SCHEMA.replace("src_id bigint", "src_id string")) \
        .withColumn("src_id", F.col("src_id").cast("bigint"))
