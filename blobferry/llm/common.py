"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from blobferry.session import discard, materialize, scratch_path  # noqa: F401  (re-exported)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast when a counted bound holds; otherwise leave the join to
    Spark (shuffle with skew splitting). ``df`` should be a written table."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def broadcast_within(df: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """Hint a broadcast when the values of ``df``, a written table, have at most ``max_bytes`` in all
    (as text or bytes; 16 more for each row); otherwise leave the join to Spark."""
    sizes = [F.octet_length(F.col(c) if t in ("string", "binary") else F.to_json(F.struct(c))) for c, t in df.dtypes]
    total = sum((F.coalesce(x, F.lit(0)).cast("long") for x in sizes), F.lit(16).cast("long"))
    return F.broadcast(df) if (df.agg(F.sum(total)).first()[0] or 0) <= max_bytes else df


def fresh_name(columns, wanted: str) -> str:
    """A column name not yet in ``columns``: extra input columns may clash."""
    taken = {c.lower() for c in columns}
    name = wanted
    while name.lower() in taken:
        name = "_" + name
    return name


def release_memory() -> None:
    """Give freed memory back to the system. Python workers are reused, and what Arrow and the
    C library keep of one stage's peak would stay beside all later stages."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(fn):
    """``fn``, a function of an iterator, whose task ends with :func:`release_memory`."""
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return run


def group_runs(keys):
    """Start and end of each run of equal rows in a 2-D integer array sorted by rows."""
    import numpy as np

    n = len(keys)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    return np.r_[0, cut], np.r_[cut, n]


def by_group(batches, keys: list[str]):
    """From record batches sorted by the integer columns ``keys``, yield
    ``(table, starts, ends)`` of whole groups; a group that continues in the
    next batch waits for its end. Holds one batch and one open group."""
    import numpy as np
    import pyarrow as pa

    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if t.num_rows == 0:
            continue
        held = t if held is None else pa.concat_tables([held, t])
        k = np.stack([held.column(c).to_numpy() for c in keys], axis=1)
        starts, ends = group_runs(k)
        last = int(starts[-1])
        if last:
            yield held.slice(0, last), starts[:-1], ends[:-1]
            held = held.slice(last)
    if held is not None and held.num_rows:
        k = np.stack([held.column(c).to_numpy() for c in keys], axis=1)
        yield held, *group_runs(k)


def list_column(table, name: str):
    """(values, offsets) of a list column of a (sliced) Arrow table, as numpy."""
    import numpy as np

    arr = table.column(name).combine_chunks()
    if hasattr(arr, "chunks"):
        arr = arr.chunk(0)
    off = arr.offsets.to_numpy()
    values = arr.values.to_numpy(zero_copy_only=False)
    return values, np.asarray(off, dtype=np.int64)


def binary_array(parts, n_bytes):
    """Arrow binary array over one buffer: ``n_bytes`` holds the length of each value."""
    import numpy as np
    import pyarrow as pa

    off = np.zeros(len(n_bytes) + 1, np.int32)
    np.cumsum(n_bytes, out=off[1:])
    return pa.Array.from_buffers(pa.binary(), len(n_bytes), [None, pa.py_buffer(off), pa.py_buffer(parts)])
