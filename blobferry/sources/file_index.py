"""Rows of a registry by id, opening only the row groups that hold wanted rows.

The registry's index is a table beside its files (``_index``, which Spark's readers
pass over): one row per row group with the least and greatest id, read from the
Parquet footers on the executors, once per file. A lookup compares the wanted ids
with those ranges, reads the id column of row groups in range, and then the other
columns of row groups that do hold wanted ids. Only ids and file names are
shuffled: no exchange, join or broadcast ever carries a body.

A registry laid out by id (``load_new`` writes it so) has ranges that hardly overlap;
in any other, more row groups are in range, and their id column decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobferry.operators.batching import global_index
from blobferry.session import materialize
from blobferry.sources.objectstore import open_fs
from blobferry.sources.registry import REGISTRY_SCHEMA, live_files, read_table

INDEX_SCHEMA = "file string, row_group int, lo long, hi long, n_rows long"
BLOCK_IDS = 100_000  # wanted ids compared with a row group at a time; the driver sees two numbers of each block
ROWS_PER_READ = 64  # registry rows decoded at a time
OUTPUT_BATCH_BYTES = 64 << 20


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}/_index"


def _footers(batches):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for b in batches:
        rows = []
        for file in b.column(0).to_pylist():
            fs, path = open_fs(file)
            with fs.open_input_file(path) as f:
                meta = pq.ParquetFile(f).metadata
                at = meta.schema.names.index("id")
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    stats = group.column(at).statistics
                    known = stats is not None and stats.has_min_max
                    rows.append((file, g, stats.min if known else None, stats.max if known else None, group.num_rows))
        cols = list(zip(*rows)) or [[]] * 5
        types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         ["file", "row_group", "lo", "hi", "n_rows"])


def refresh(spark: SparkSession, path: str) -> DataFrame:
    """The index of the registry's present files; footers are read of files that it does not hold yet."""
    files = live_files(spark, path)  # as a scan lists them; no footer is read for it
    here = spark.createDataFrame([(f,) for f in files], "file string")
    known = read_table(spark, index_path(path), INDEX_SCHEMA)
    new = here if known is None else here.join(known.select("file").distinct(), "file", "left_anti")
    new = materialize(new, "new-files")
    n = new.count()
    if n or known is None:
        tasks = min(max(n, 1), 3 * spark.sparkContext.defaultParallelism)
        new.repartition(tasks).mapInArrow(_footers, INDEX_SCHEMA).write.mode("append").parquet(index_path(path))
        known = spark.read.schema(INDEX_SCHEMA).parquet(index_path(path))
    # files that were replaced are no longer there; two runs at once may note a file twice
    return known.distinct().join(here, "file", "left_semi")


def _open(file: str):
    import pyarrow.parquet as pq

    fs, path = open_fs(file)
    return pq.ParquetFile(fs.open_input_file(path))


def located(spark: SparkSession, path: str, ids: DataFrame, per_task: int) -> DataFrame:
    """``file, row_group, ids``: the wanted ids that each row group holds, at most ``per_task`` in a row."""
    index = materialize(refresh(spark, path), "index-now")
    wanted = global_index(ids.select(F.col("id").cast("long").alias("id")).where("id is not null").distinct(), ["id"], name="_at")
    blocks = materialize(wanted.groupBy(F.expr(f"_at div {BLOCK_IDS}").alias("block"))
                         .agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.collect_list("id").alias("ids")), "id-blocks")
    bounds = spark.sparkContext.broadcast([tuple(r) for r in blocks.select("block", "lo", "hi").orderBy("block").collect()])

    def in_range(batches):
        import numpy as np
        import pyarrow as pa

        lows, highs = (np.array([b[k] for b in bounds.value], np.int64) for k in (1, 2))
        for b in batches:
            rows = []
            for r in b.to_pylist():
                first = 0 if r["lo"] is None else int(np.searchsorted(highs, r["lo"]))
                last = len(lows) if r["hi"] is None else int(np.searchsorted(lows, r["hi"], "right"))
                rows += [(r["file"], r["row_group"], bounds.value[k][0]) for k in range(first, last)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int64()))],
                                                 ["file", "row_group", "block"])

    def held(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            rows = []
            for r in b.to_pylist():
                have = _open(r["file"]).read_row_group(r["row_group"], columns=["id"]).column("id").to_numpy()
                mine = np.intersect1d(have, np.array(r["ids"], np.int64))
                rows += [(r["file"], r["row_group"], mine[k:k + per_task]) for k in range(0, len(mine), per_task)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.list_(pa.int64())))],
                    ["file", "row_group", "ids"])

    tasks = 3 * spark.sparkContext.defaultParallelism
    pairs = index.select("file", "row_group", "lo", "hi").mapInArrow(in_range, "file string, row_group int, block long")
    pairs = pairs.join(blocks.select("block", "ids"), "block").select("file", "row_group", "ids").repartition(tasks)
    return materialize(pairs.mapInArrow(held, "file string, row_group int, ids array<long>"), "located")


def rows_by_id(spark: SparkSession, path: str, ids: DataFrame, columns: list[str] | None = None,
               per_task: int = 2000) -> DataFrame:
    """Registry rows of ``ids`` (column ``id``; nulls and repeats are ignored): ``columns`` (default all) of the fixed schema.

    Ids that no row has give nothing. A task reads at most ``per_task`` wanted rows of a row group at
    a time, and holds some ``OUTPUT_BATCH_BYTES`` of bodies.
    """
    names = columns or [f.name for f in REGISTRY_SCHEMA.fields]
    fields = [f for n in names for f in REGISTRY_SCHEMA.fields if f.name == n]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    at = located(spark, path, ids, per_task)
    n = at.count()

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                mine = np.array(r["ids"], np.int64)
                parts, size = [], 0
                read = list(dict.fromkeys(["id", *names]))
                for part in _open(r["file"]).iter_batches(ROWS_PER_READ, row_groups=[r["row_group"]], columns=read):
                    mask = np.isin(part.column("id").to_numpy(), mine)
                    if not mask.any():
                        continue
                    part = part.filter(pa.array(mask)).select(names)
                    parts.append(part)
                    size += part.nbytes
                    if size >= OUTPUT_BATCH_BYTES:
                        yield from pa.Table.from_batches(parts).to_batches()
                        parts, size = [], 0
                if parts:
                    yield from pa.Table.from_batches(parts).combine_chunks().to_batches()

    return at.repartition(max(1, min(n, 100 * spark.sparkContext.defaultParallelism))).mapInArrow(read, schema)
