"""Body reads for a chosen set of keys.

``binaryFile`` pushes filters on ``length`` and ``modificationTime`` only, so a
semi-join on ``path`` would still open every file. When only some keys are
wanted (new objects), the keys frame is spread over tasks and each task reads
its own bodies; a failed read becomes a row with ``ok = false`` and the
error, and the other rows go on.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blobferry.sources.objectstore import check_name, open_fs

BODY_FIELDS = [T.StructField("content", T.BinaryType()), T.StructField("size", T.LongType()),
               T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType())]


# Bytes of bodies per output batch, and concurrent fetches per task on a
# remote store (each request has a latency one thread would wait out; local
# disks get one thread).
OUTPUT_BATCH_BYTES = 64 << 20
IO_THREADS = 8
# Largest body one row can hold (a Spark binary value, an Arrow batch slot).
MAX_BODY_BYTES = (1 << 31) - 1


def _fetch(fs, base: str, key, max_bytes: int | None):
    """(body, error) of one object."""
    err = check_name(key)
    if err is not None:
        return None, err
    try:
        with fs.open_input_file(f"{base}/{key}") as f:
            n = f.size()
            if max_bytes is not None and n > max_bytes:
                return None, f"body of {n} bytes above limit {max_bytes}"
            return f.read(), None
    except Exception as e:  # noqa: BLE001 - kept per key
        return None, f"{type(e).__name__}: {e}"


def read_bodies(keys: DataFrame, root: str, key: str = "key",
                max_bytes: int | None = MAX_BODY_BYTES, io_threads: int | None = None) -> DataFrame:
    """Rows of ``keys`` (all columns kept) plus content, size, ok, error.

    Each task fetches its keys with ``io_threads`` requests in flight and
    yields what it has once that reaches ``OUTPUT_BATCH_BYTES`` of bodies, so a
    batch of many keys is never held whole. An object over ``max_bytes`` (by
    default the most one row can hold) becomes an error row instead of failing
    the task; :func:`read_chunks` reads objects of any size.
    """
    out_schema = T.StructType(list(keys.schema.fields) + BODY_FIELDS)
    local = "://" not in root or root.startswith("file:")
    io_threads = io_threads or (1 if local else IO_THREADS)

    def _read(batches):
        from concurrent.futures import ThreadPoolExecutor

        fs, base = open_fs(root)
        pool = ThreadPoolExecutor(max_workers=io_threads) if io_threads > 1 else None
        run = pool.map if pool else map  # one thread: a plain loop, no futures
        try:
            for pdf in batches:
                pdf = pdf.reset_index(drop=True)
                names = pdf[key].tolist()
                start, got, acc = 0, [], 0
                # One request of each thread at a time: what a task holds is the bytes
                # of one output batch and of the bodies in flight, not of all its keys.
                for at in range(0, len(names), io_threads):
                    part = list(run(lambda k: _fetch(fs, base, k, max_bytes), names[at:at + io_threads]))
                    got += part
                    acc += sum(len(b) for b, _ in part if b is not None)
                    if acc >= OUTPUT_BATCH_BYTES or at + io_threads >= len(names):
                        out = pdf.iloc[start:start + len(got)].copy()
                        out["content"] = [b for b, _ in got]
                        out["size"] = pd.array([None if b is None else len(b) for b, _ in got], dtype="Int64")
                        out["ok"] = [b is not None for b, _ in got]
                        out["error"] = [e for _, e in got]
                        yield out
                        start, got, acc = start + len(got), [], 0
        finally:
            if pool:
                pool.shutdown()

    return keys.mapInPandas(_read, out_schema)


CHUNK_BYTES = 8 << 20
TASK_BYTES = 256 << 20  # ranges a task reads, one after the other
TASK_CHUNKS = 2000
CHUNK_FIELDS = [T.StructField("chunk_no", T.LongType()), T.StructField("n_chunks", T.LongType()),
                T.StructField("offset", T.LongType()), T.StructField("content", T.BinaryType()),
                T.StructField("error", T.StringType())]


def chunk_plan(keys: DataFrame, chunk_bytes: int = CHUNK_BYTES, size: str = "size") -> DataFrame:
    """``keys`` with one row per byte range: chunk_no (from 0), n_chunks, offset and _length.

    An empty object, or one of unknown (null) size, has one chunk; the latter is read from its start to ``chunk_bytes``
    and reported if the object is longer.
    """
    n = F.greatest(F.ceil(F.coalesce(F.col(size), F.lit(0)) / F.lit(chunk_bytes)), F.lit(1)).cast("bigint")
    cut = keys.withColumn("n_chunks", n).withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_chunks") - 1)))
    offset = (F.col("chunk_no") * chunk_bytes).cast("bigint")
    left = F.when(F.col(size).isNull(), F.lit(chunk_bytes)).otherwise(F.col(size) - offset)
    return cut.withColumn("offset", offset).withColumn("_length", F.least(left, F.lit(chunk_bytes)).cast("bigint"))


def read_chunks(keys: DataFrame, root: str, chunk_bytes: int = CHUNK_BYTES, key: str = "key", size: str = "size",
                io_threads: int | None = None) -> DataFrame:
    """Bodies of any length as numbered byte ranges: columns of ``keys`` plus chunk_no, n_chunks, offset, content, error.

    ``size`` is the listed size. The ranges, not the bodies, are spread over tasks, so one huge
    object is read by many, and a task holds at most ``io_threads`` ranges at a time. A read that
    fails, or an object whose present size is not the listed one, gives rows with ``error`` and null content.
    """
    plan = chunk_plan(keys, chunk_bytes, size)
    spark = keys.sparkSession
    n, total = plan.agg(F.count(F.lit(1)), F.coalesce(F.sum("_length"), F.lit(0))).first()
    plan = plan.repartition(max(1, min(n, spark.sparkContext.defaultParallelism), -(-n // TASK_CHUNKS), -(-total // TASK_BYTES)))
    out_schema = T.StructType(list(keys.schema.fields) + CHUNK_FIELDS)
    local = "://" not in root or root.startswith("file:")
    io_threads = io_threads or (1 if local else IO_THREADS)
    own = keys.columns

    def _range(fs, base, k, listed, offset, length):
        """(content, error) of one byte range."""
        err = check_name(k)
        if err is not None:
            return None, err
        try:
            with fs.open_input_file(f"{base}/{k}") as f:
                now = f.size()
                if now != listed and (listed is not None or now > length):
                    return None, f"object of {now} bytes, listed with {listed}"
                return bytes(f.read_at(min(length, now - offset), offset)), None
        except Exception as e:  # noqa: BLE001 - kept per range
            return None, f"{type(e).__name__}: {e}"

    def _read(batches):
        from concurrent.futures import ThreadPoolExecutor

        import pyarrow as pa

        fs, base = open_fs(root)
        pool = ThreadPoolExecutor(max_workers=io_threads) if io_threads > 1 else None
        run = pool.map if pool else map
        try:
            for b in batches:
                for at in range(0, b.num_rows, io_threads):
                    part = b.slice(at, io_threads)
                    cols = [part.column(part.schema.get_field_index(c)).to_pylist() for c in (key, size, "offset", "_length")]
                    got = list(run(lambda r: _range(fs, base, *r), zip(*cols)))
                    take = [part.column(part.schema.get_field_index(c)) for c in (*own, "chunk_no", "n_chunks", "offset")]
                    yield pa.RecordBatch.from_arrays(
                        [*take, pa.array([c for c, _ in got], pa.binary()), pa.array([e for _, e in got], pa.string())],
                        names=[*own, "chunk_no", "n_chunks", "offset", "content", "error"])
        finally:
            if pool:
                pool.shutdown()

    return plan.mapInArrow(_read, out_schema)


def join_chunks(chunks: DataFrame, key: str = "key") -> DataFrame:
    """``key, size, sha1, n_chunks, ok`` of objects from their chunks: the hash of the joined body, which is never held.

    Chunks are sorted by key and number inside a partition (a sort that spills) and hashed as they
    stream by. ``ok`` is false, with null size and hash, where a chunk is missing, repeated or failed.
    """
    ordered = chunks.select(F.col(key).alias("key"), "chunk_no", "n_chunks", "content") \
        .repartition("key").sortWithinPartitions("key", "chunk_no")

    def _hash(batches):
        import hashlib

        import pyarrow as pa

        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        names = ["key", "size", "sha1", "n_chunks", "ok"]

        def rows(found):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

        open_key, h, size, seen, total, good = None, None, 0, 0, 0, True

        def close():
            ok = good and seen == total
            return open_key, size if ok else None, h.hexdigest() if ok else None, total, ok

        for b in batches:
            done = []
            for k, no, n, content in zip(*(b.column(i).to_pylist() for i in range(4))):
                if h is None or k != open_key:
                    if h is not None:
                        done.append(close())
                    open_key, h, size, seen, total, good = k, hashlib.sha1(), 0, 0, n, True
                good = good and content is not None and no == seen and n == total
                if good:
                    h.update(content)
                    size += len(content)
                seen += 1
            if done:
                yield rows(done)
        if h is not None:
            yield rows([close()])

    return ordered.mapInArrow(_hash, "key string, size long, sha1 string, n_chunks long, ok boolean")


def hash_objects(keys: DataFrame, root: str, block: int = 1 << 20) -> DataFrame:
    """``key, size, sha1, error`` of the objects of ``keys`` (``key, size``: as listed), hashed where they are read.

    A body streams through its task by blocks and is never held or moved. The keys are spread by the listed bytes and by
    count. An object that cannot be read, or has another size by now, has an ``error`` and a null hash.
    """
    keys = keys.select("key", "size")
    n, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    cores = keys.sparkSession.sparkContext.defaultParallelism
    keys = keys.repartition(max(1, min(n, cores), -(-n // TASK_CHUNKS), -(-total // TASK_BYTES)))

    def _hash_one(fs, base, k, listed):
        import hashlib

        err = check_name(k)
        if err is not None:
            return None, err
        try:
            h, seen = hashlib.sha1(), 0
            with fs.open_input_stream(f"{base}/{k}") as f:
                while part := f.read(block):
                    h.update(part)
                    seen += len(part)
            return (None, f"object of {seen} bytes, listed with {listed}") if seen != listed else (h.hexdigest(), None)
        except Exception as e:  # noqa: BLE001 - kept per key
            return None, f"{type(e).__name__}: {e}"

    def _hash(batches):
        import pyarrow as pa

        fs, base = open_fs(root)
        for b in batches:
            got = [_hash_one(fs, base, k, s) for k, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([h for h, _ in got], pa.string()),
                                              pa.array([e for _, e in got], pa.string())], names=["key", "size", "sha1", "error"])

    return keys.mapInArrow(_hash, "key string, size long, sha1 string, error string")


def sizes_of(keys: DataFrame, root: str) -> DataFrame:
    """``key, size`` of those ``keys`` (column ``key``) that are objects below ``root`` now."""
    def _stat(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        fs, base = open_fs(root)
        for b in batches:
            safe = [k for k in b.column(0).to_pylist() if check_name(k) is None]
            found = [(k, i.size) for k, i in zip(safe, fs.get_file_info([f"{base}/{k}" for k in safe])) if i.type == pafs.FileType.File]
            cols = list(zip(*found)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64())], ["key", "size"])

    return keys.select("key").mapInArrow(_stat, "key string, size long")


def lookup(registry: DataFrame, ids: DataFrame, on: str = "id") -> DataFrame:
    """Registry rows for many ids at once (a semi-join, not a loop of lookups)."""
    return registry.join(ids.select(on).where(F.col(on).isNotNull()).distinct(), on, "left_semi")
