"""Repeated ingestion of new objects with Structured Streaming.

A pass lists the root on the executors, and what no earlier pass listed is noted once in a
Parquet table beside the checkpoint (``arrivals``: one row per object). The stream reads that table, not the
store: its checkpoint holds one entry per file of up to ``max_files_per_trigger``
objects, and the driver no object's status. Each run (``trigger(availableNow=True)``) loads only objects
that arrived since the last one. The Parquet sink is exactly-once through its metadata log. As with key-only
comparison, an object rewritten under the same name is not taken again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobferry.functions import keys as K
from blobferry.operators import sync
from blobferry.operators.batching import global_index
from blobferry.session import materialize
from blobferry.sources.blobs import MAX_BODY_BYTES, read_bodies, sizes_of
from blobferry.sources.listing import list_all_objects, required_body, visible

# One row per object a pass listed first. ``id``: the registry id that pass gave it (null: nothing to insert).
ARRIVAL_SCHEMA = "key string, size long, mtime timestamp, id long, again boolean, pass_id string"

# By default Spark's file source passes over files a week older than the newest one it has seen.
ANY_AGE = "36500d"
OBJECTS_PER_TASK = 250  # of a micro-batch, as long as there are cores


def arrivals_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/arrivals"


def _arrived(spark: SparkSession, root: str, checkpoint: str, suffix: str | None, taken: DataFrame | None = None) -> DataFrame:
    """Listed objects (key, size, mtime) that no earlier pass noted, staged; ``taken``: keys to
    leave out where a checkpoint is older than its table of arrivals."""
    from blobferry.sources.registry import read_table

    listed = visible(list_all_objects(spark, root, suffix))
    noted = read_table(spark, arrivals_path(checkpoint), ARRIVAL_SCHEMA)
    seen = taken if noted is None else noted.select("key")
    return materialize(listed if seen is None else sync.drop_keys(listed, seen, "key"), "arrived")


def _note(rows: DataFrame, checkpoint: str, this: str, max_files: int | None) -> None:
    """Append a pass's arrivals, at most ``max_files`` objects in a file: a file is one step of the stream."""
    out = rows.select("key", "size", "mtime", "id", "again", F.lit(this).alias("pass_id"))
    writer = out.write.mode("append")
    if max_files:
        writer = writer.option("maxRecordsPerFile", str(max_files))
    writer.parquet(arrivals_path(checkpoint))


def _steps(spark: SparkSession, checkpoint: str, max_files: int | None) -> DataFrame:
    """The arrivals as a stream."""
    reader = spark.readStream.format("parquet").schema(ARRIVAL_SCHEMA).option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", "1")
    return reader.load(arrivals_path(checkpoint))


def _read_tasks(spark: SparkSession, n: int, n_bytes: int, max_files: int | None) -> int:
    """Read tasks of a step of a pass with ``n`` objects of ``n_bytes``."""
    from blobferry.plans.jobs import spread_tasks

    step = min(n, max_files or n)
    spread = spread_tasks(spark, step, n_bytes * step // max(n, 1))
    return spread or max(1, min(spark.sparkContext.defaultParallelism, -(-step // OBJECTS_PER_TASK)))


def _run(query, timeout_s: float | None) -> None:
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError("ingestion did not finish in time")


def _committed_rows(spark: SparkSession, sink_path: str) -> int:
    from blobferry.sources.registry import read_table

    df = read_table(spark, sink_path)
    return 0 if df is None else df.count()


def ingest_new_objects(spark: SparkSession, root: str, sink_path: str, checkpoint: str,
                       suffix: str | None = None, max_files_per_trigger: int | None = None,
                       timeout_s: float | None = None) -> dict:
    """Run one availableNow pass: new objects below ``root`` -> registry-shaped
    rows (guid, filename, document, size, sha1) appended to ``sink_path``.

    No file is too old to be taken. A body that cannot be read fails the pass, and the next one
    begins with its step.
    """
    from blobferry.sources.registry import read_table

    sink = read_table(spark, sink_path)
    rows_before = 0 if sink is None else sink.count()
    new = _arrived(spark, root, checkpoint, suffix, None if sink is None else sink.select(F.col("filename").alias("key")))
    n, total = new.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if n or read_table(spark, arrivals_path(checkpoint), ARRIVAL_SCHEMA) is None:
        _note(new.withColumn("id", F.lit(None).cast("bigint")).withColumn("again", F.lit(False)),
              checkpoint, uuid.uuid4().hex, max_files_per_trigger)
    # Leftover steps of a pass that stopped have no count here: at least one task per core.
    tasks = max(_read_tasks(spark, n, total, max_files_per_trigger), 1 if n else spark.sparkContext.defaultParallelism)
    keys = _steps(spark, checkpoint, max_files_per_trigger).where(F.col("size") > 0).select(
        "key", F.date_trunc("millisecond", "mtime").alias("mtime"))
    rows = read_bodies(keys.repartition(tasks), root).select(
        K.derived_guid("key").alias("guid"),
        F.col("key").alias("filename"),
        required_body().alias("document"),
        "size", "mtime").select("guid", "filename", "document", "size", K.body_sha1("document").alias("sha1"), "mtime")
    q = (rows.writeStream.format("parquet").option("path", sink_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    _run(q, timeout_s)
    # Rows committed by this run, read from the sink's own log (the query's
    # progress list keeps only its latest updates).
    after = _committed_rows(spark, sink_path)
    return {"batches": len(q.recentProgress), "rows": after - rows_before}


def _plan(spark: SparkSession, root: str, registry_path: str, checkpoint: str, suffix: str | None, max_files: int | None,
          owed: DataFrame | None, dead: DataFrame | None, this: str) -> tuple[int, int, int]:
    """Note the pass's arrivals with the ids of those to insert; (number of them, their bytes, greatest id in use).

    The registry is read once for the whole pass: an arrival is inserted if no live row has
    its key, if it is not empty, and if it was not owed, which is a load of its own.
    """
    from blobferry.sources import registry as R

    reg = R.create_if_absent(spark, registry_path)
    new = _arrived(spark, root, checkpoint, suffix)
    live = R.current_view(reg.select("id", "filename"), tombstones=dead)
    wanted = sync.new_objects(new.where(F.col("size") > 0).select("key", "size"), live, existing_key="filename")
    if owed is not None:
        wanted = sync.drop_keys(wanted, owed, "key")
    keyed = global_index(wanted, ["key"], name="_idx")
    n, total = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    start = R.last_id(spark, registry_path, reg)[1]
    ids = keyed.select("key", (F.col("_idx") + F.lit(int(start) + 1)).cast("bigint").alias("id"))
    rows = new.join(ids, "key", "left")
    if dead is None:
        rows = rows.withColumn("again", F.lit(False))
    else:
        marked = sync.distinct_keys(dead).withColumn("_dead", F.lit(True))
        rows = rows.join(marked, "key", "left").withColumn("again", F.col("_dead").isNotNull())
    if not new.isEmpty() or R.read_table(spark, arrivals_path(checkpoint), ARRIVAL_SCHEMA) is None:
        # Steps hold ranges of ids, so that registry files do (see sources.file_index); most steps are full.
        steps = -(-new.count() // max_files) if max_files else 1
        cores = spark.sparkContext.defaultParallelism
        _note(rows.repartitionByRange(max(1, min(cores, steps // 8)), "id").sortWithinPartitions("id"), checkpoint, this, max_files)
    return n, total, start + n


def stream_into_registry(spark: SparkSession, root: str, registry_path: str, checkpoint: str,
                         suffix: str | None = None, max_files_per_trigger: int | None = None,
                         ledgers=None, timeout_s: float | None = None, sync_ledgers=None,
                         max_bytes: int | None = MAX_BODY_BYTES) -> dict:
    """Run one availableNow pass that loads new objects straight into the registry.

    The pass compares its arrivals with the registry once and gives the missing ones their ids
    (:func:`_plan`); a micro-batch then reads just its own bodies and appends them
    (:func:`blobferry.plans.jobs.insert_bodies`), whatever the registry holds by then. Steps that a stopped pass
    left go through :func:`blobferry.plans.jobs.load_new`, whose anti-join makes a re-run harmless.

    The stream offers an object once. What must be looked at again comes from
    the ledgers: objects whose read failed (``ledgers``) and names whose rows were
    deleted (``sync_ledgers``). Each pass loads those that are in the store
    now before its arrivals. An object that comes back after its delete is loaded as a new row.
    """
    from blobferry.plans import jobs
    from blobferry.sinks import ledgers as L

    this, reports = uuid.uuid4().hex, []
    dead = L.read_tombstones(spark, sync_ledgers.tombstones) if sync_ledgers is not None else None
    owed = L.owed_keys(spark, ledgers, sync_ledgers)
    if owed is not None:
        if suffix:
            owed = owed.where(K.has_suffix("key", suffix))
        owed = materialize(sizes_of(owed, root), "owed")
        if not owed.isEmpty():
            reports.append(jobs.load_new(spark, root, registry_path, listing=owed, ledgers=ledgers, tombstones=dead,
                                         max_bytes=max_bytes).counts)
    n, total, top = _plan(spark, root, registry_path, checkpoint, suffix, max_files_per_trigger, owed, dead, this)
    tasks = _read_tasks(spark, n, total, max_files_per_trigger)
    per_task = max(1, -(-min(n, max_files_per_trigger or n) // tasks))

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        inserted, failed, n_old = jobs.insert_bodies(batch, this, root, registry_path, top - n + 1, per_task, tasks,
                                                     ledgers, max_bytes)
        reports.append({"inserted": inserted, "failed": failed})
        if n_old:
            old = batch.where(F.col("pass_id") != this).select("key", "size")
            reports.append(jobs.load_new(session, root, registry_path, listing=old, ledgers=ledgers, tombstones=dead,
                                         max_bytes=max_bytes, above=top).counts)

    q = (_steps(spark, checkpoint, max_files_per_trigger).writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _run(q, timeout_s)
    return {"batches": len(reports), "inserted": sum(r["inserted"] for r in reports),
            "failed": sum(r["failed"] for r in reports)}


def read_ingested(spark: SparkSession, sink_path: str) -> DataFrame:
    """Rows the stream committed (the sink's metadata log hides partial files)."""
    return spark.read.parquet(sink_path)
