"""Compaction of a registry file by file.

Deleted rows and stale flags are found on ids and names; the files that hold any are
rewritten, each by one task and batch by batch, and every other file stays as it is.
No body is shuffled, and the work follows the files touched, not the registry.

A rewritten file is put in ``_rewritten`` beside the registry's own files (Spark's readers pass
over it), and a run becomes visible by one row file in ``_versions``: the files it takes
out and those it puts in. :func:`registry.read_registry` is the registry with these applied. A run
that stops before that file leaves the registry as it was; its files are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobferry.functions import keys as K
from blobferry.operators import sync
from blobferry.session import materialize
from blobferry.sources.objectstore import open_fs
from blobferry.sources.registry import VERSION_SCHEMA, read_registry, versions_path

ROWS_PER_WRITE = 64  # registry rows held while a file is rewritten
GROUP_BYTES = 64 << 20  # bodies of one row group of a rewritten file


def changes(registry: DataFrame, tombstones: DataFrame | None, ok_ledger: DataFrame | None) -> DataFrame:
    """``file, id, dead``: rows to take out (dead) or to mark as exported, found without their bodies.

    As :func:`registry.current_view` has it: a tombstone deletes its name's rows up to its id (all of them
    where that is null); a success in ``ok_ledger`` (column ``guid``) sets the flag.
    """
    slim = registry.select(F.col("_metadata.file_path").alias("file"), "id", "guid", "filename", K.FLAG_COLUMN)
    found = None
    if tombstones is not None:
        upto = F.max(F.coalesce(F.col("id"), F.lit((1 << 63) - 1))) if "id" in tombstones.columns else F.lit((1 << 63) - 1)
        dead, _ = sync.checked_broadcast(materialize(
            tombstones.groupBy(F.col("key").alias("_dead")).agg(upto.alias("_upto")), "dead-names"))
        found = slim.join(dead, (F.col("filename") == F.col("_dead")) & (F.col("id") <= F.col("_upto")), "left_semi") \
            .select("file", "id", F.lit(True).alias("dead"))
    if ok_ledger is not None:
        done, _ = sync.checked_broadcast(materialize(ok_ledger.select("guid").where("guid is not null").distinct(), "exported"))
        marks = slim.where(~F.coalesce(F.col(K.FLAG_COLUMN), F.lit(False))).join(done, "guid", "left_semi") \
            .select("file", "id", F.lit(False).alias("dead"))
        found = marks if found is None else found.unionByName(marks)
    if found is None:
        return registry.sparkSession.createDataFrame([], "file string, id long, dead boolean")
    return found.groupBy("file", "id").agg(F.max("dead").alias("dead"))


def compact_files(spark: SparkSession, path: str, tombstones: DataFrame | None = None,
                  ok_ledger: DataFrame | None = None) -> dict:
    """Rewrite the files at ``path`` that hold deleted rows or stale flags; counts of files and rows.

    A row is known by its id, which the registry keeps unique. A file left without rows is taken out and has
    no successor. Run one compaction of a registry at a time; appends may go on, their files are new.
    """
    registry = read_registry(spark, path)
    touched = changes(registry, tombstones, ok_ledger).groupBy("file").agg(
        # ids of one file: bounded by its rows
        F.collect_list(F.when(F.col("dead"), F.col("id"))).alias("dead"),
        F.collect_list(F.when(~F.col("dead"), F.col("id"))).alias("marked"))
    touched = materialize(touched, "touched-files")
    n = touched.count()
    n_files = len(registry.inputFiles())
    if not n:
        return {"files": n_files, "rewritten": 0, "rows_removed": 0, "rows_marked": 0}
    fields = [f.split()[0] for f in VERSION_SCHEMA.split(", ")]
    run_id, folder = uuid.uuid4().hex, f"{path.rstrip('/')}/_rewritten"

    def rewrite(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq

        flag = K.FLAG_COLUMN
        for b in batches:
            rows = []
            for r in b.to_pylist():
                dead, marked = (np.array(r[c], np.int64) for c in ("dead", "marked"))
                fs, base = open_fs(r["file"])
                to_fs, to = open_fs(folder)
                to_fs.create_dir(to, recursive=True)
                name = f"{uuid.uuid4().hex}.parquet"  # a repeated task writes another file; only committed names are read
                kept = n_dead = n_marked = top = 0
                writer, held, size = None, [], 0
                with fs.open_input_file(base) as f, to_fs.open_output_stream(f"{to}/{name}") as out:
                    source = pq.ParquetFile(f)

                    def flush():
                        if held:
                            writer.write_table(pa.Table.from_batches(held))

                    for part in source.iter_batches(ROWS_PER_WRITE):
                        ids = part.column("id").to_numpy(zero_copy_only=False)
                        top = max(top, int(ids.max(initial=0)))
                        at = part.schema.get_field_index(flag)
                        mark = np.isin(ids, marked)
                        values = [True if m else v for m, v in zip(mark, part.column(at).to_pylist())]
                        part = part.set_column(at, part.schema.field(at), pa.array(values, pa.bool_()))
                        stay = ~np.isin(ids, dead)
                        n_dead += int((~stay).sum())
                        n_marked += int((mark & stay).sum())
                        part = part.filter(pa.array(stay))
                        if not part.num_rows:
                            continue
                        writer = writer or pq.ParquetWriter(out, part.schema, compression="snappy")
                        held.append(part)
                        size += part.nbytes
                        kept += part.num_rows
                        if size >= GROUP_BYTES:
                            flush()
                            held, size = [], 0
                    if writer:
                        flush()
                        writer.close()
                rows.append((run_id, r["file"], f"{folder}/{name}" if kept else None, kept, n_dead, n_marked, top))
            if rows:
                types = [pa.string()] * 3 + [pa.int64()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=fields)

    wide = touched.repartition(min(n, 100 * spark.sparkContext.defaultParallelism))
    done = materialize(wide.mapInArrow(rewrite, VERSION_SCHEMA), "rewritten")
    done.coalesce(1).write.mode("append").parquet(versions_path(path))  # one file: seen whole or not at all
    total = done.agg(F.sum("n_dead"), F.sum("n_marked")).first()
    return {"files": n_files, "rewritten": n, "rows_removed": total[0], "rows_marked": total[1]}
