"""Jobs: the operators composed into the four movements.

* :func:`load_new` - objects -> registry, only keys not yet loaded.
* :func:`export_pending` - registry rows not yet exported -> objects.
* :func:`run_incremental` - source rows past the bookmark (plus retries) ->
  a sink, then the bookmark is committed.
* :func:`sync_registry` - tombstone registry rows whose object is gone.

Each job is lazy until one write; counts for the report come from the
written ledger or registry, never from a second run of a side-effecting plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blobferry.functions import keys as K
from blobferry.operators import incremental as inc
from blobferry.operators import sync
from blobferry.operators.batching import global_index
from blobferry.session import materialize, shuffles_go
from blobferry.sinks import ledgers as L
from blobferry.sinks.export import export_bodies
from blobferry.sinks.json_sink import read_json, write_json
from blobferry.sources import registry as R
from blobferry.sources.blobs import MAX_BODY_BYTES, hash_objects, read_bodies
from blobferry.sources.file_index import rows_by_id
from blobferry.sources.listing import list_all_objects
from blobferry.sources.metadata import with_metadata


@dataclass
class RunReport:
    """What a run did (the facts the reference only logged)."""

    run_id: str
    run_no: int = 0
    counts: dict = field(default_factory=dict)
    high_water: tuple | None = None
    committed: bool = False
    n_late: int = 0  # rows taken without the mark's help: their leading key is null


def status_totals(status: DataFrame) -> DataFrame:
    """One row: n_rows, n_ok (written), n_skipped, n_failed, bytes_written."""
    written = F.col("ok") & ~F.col("skipped")
    return status.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(written).cast("bigint").alias("n_ok"),
        F.count_if(F.col("skipped")).cast("bigint").alias("n_skipped"),
        F.count_if(~F.col("ok")).cast("bigint").alias("n_failed"),
        F.coalesce(F.sum(F.when(written, F.col("size"))), F.lit(0)).cast("bigint").alias("bytes_written"))


# ------------------------------------------------------------------ load new

# Bytes of bodies one read task should fetch, and objects one write task
# should put: with small bodies an input split holds very many objects, and
# the per-object latency, not the bytes, sets the task's length.
BODY_BYTES_PER_TASK = 128 << 20
OBJECTS_PER_TASK = 2000


def spread_tasks(spark: SparkSession, n_objects: int, n_bytes: int | None = None) -> int | None:
    """Number of write tasks for ``n_objects`` (and ``n_bytes``), or None when
    the work fits the cluster's cores as it is partitioned."""
    n = -(-n_objects // OBJECTS_PER_TASK)
    if n_bytes:
        n = max(n, -(-n_bytes // BODY_BYTES_PER_TASK))
    return n if n > spark.sparkContext.defaultParallelism else None


def load_new(spark: SparkSession, root: str, registry_path: str,
             suffix: str | None = K.OBJECT_SUFFIX,
             prefix: str | None = None, listing: DataFrame | None = None,
             ledgers: L.Ledgers | None = None,
             tombstones: DataFrame | None = None, max_bytes: int | None = MAX_BODY_BYTES, above: int = 0) -> RunReport:
    """Load objects under ``root`` whose key is not in the registry yet.

    A key whose rows are all tombstoned (``tombstones``) counts as absent: an
    object that comes back is loaded again, as a new row with its own guid.
    Keys whose body could not be read are not inserted; with ``ledgers``
    their errors go to the status ledger (only those few keys are read
    again to get the error text, so no body is read twice on success). Ids are given ``above``
    a number that another writer of the same pass has reserved.
    """
    rep = RunReport(run_id=uuid.uuid4().hex)
    reg = R.create_if_absent(spark, registry_path)
    n_before, start = R.last_id(spark, registry_path, reg)
    start = max(start, above)
    live = R.current_view(reg.select("id", "filename"), tombstones=tombstones)
    # The distributed listing: object names never pass through the driver
    # (Spark's file index would keep every file status there). It is staged
    # as it is made, so the walk is never repeated.
    if listing is None:
        listed = list_all_objects(spark, root, suffix, prefix).select("key", "size")
    else:
        listed = listing.select("key", "size")
    n_listed = listed.count()
    # A small listing probes the registry (no shuffle of registry keys); a
    # large one is anti-joined with the registry's distinct keys.
    new = sync.new_objects_by_probe(listed, live.select(F.col("filename").alias("key")),
                                    n_listing=n_listed)
    # One row per key even if a supplied listing repeats one: the guid derives
    # from the key and must stay unique.
    new = new.groupBy("key").agg(F.max("size").alias("size"))
    # Ids on keys only (cheap), then bodies are read once, on the executors.
    keyed = global_index(new.where(F.col("size") > 0).select("key", "size"), ["key"], name="_idx")
    keyed = keyed.withColumn("id", (F.col("_idx") + F.lit(int(start) + 1)).cast("bigint")).drop("_idx")
    # The key table is small and would be read in a few splits; spread it so
    # each read task gets about BODY_BYTES_PER_TASK of bodies or
    # OBJECTS_PER_TASK objects, whichever needs more tasks (keys-only shuffle).
    n_keys, total = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    n_tasks = spread_tasks(spark, int(n_keys), int(total)) or spark.sparkContext.defaultParallelism
    # By id ranges, so that a registry file holds a range of ids (see sources.file_index).
    bodies = read_bodies(keyed.drop("size").repartitionByRange(n_tasks, "id"), root, max_bytes=max_bytes)
    # A key that comes back gets a guid of its own, from its name and row id.
    name = F.col("key")
    if tombstones is not None:
        again = sync.distinct_keys(tombstones).withColumnRenamed("key", "_again")
        again, _ = sync.checked_broadcast(materialize(
            again.join(keyed.select(F.col("key").alias("_again")), "_again", "left_semi"), "re-added"))
        bodies = bodies.join(again, F.col("key") == F.col("_again"), "left")
        name = _own_name(F.col("_again").isNotNull())
    _registry_rows(bodies, name).write.mode("append").parquet(registry_path)
    n_new = int(n_keys)
    inserted = R.read_registry(spark, registry_path).count() - n_before
    rep.counts = {"listed": n_listed, "existing_rows": n_before, "new": n_new,
                  "inserted": inserted, "failed": n_new - inserted}
    if ledgers is not None and n_new > inserted:
        loaded = spark.read.parquet(registry_path).where(F.col("id") > int(start)).select("id")
        _note_failures(keyed, loaded, root, max_bytes, ledgers, rep.run_id)
    rep.committed = True
    return rep


def _own_name(again: Column) -> Column:
    """What a row's guid derives from: its key, with the row id where the key was deleted before."""
    return F.when(~again, F.col("key")).otherwise(F.concat_ws("#", "key", F.col("id").cast("string")))


def _registry_rows(bodies: DataFrame, name: Column) -> DataFrame:
    return (bodies.where(F.col("ok") & K.non_empty_body("content"))
            .select("id", K.derived_guid(name).alias("guid"), F.col("key").alias("filename"),
                    F.col("content").alias("document"), F.lit(False).alias(K.FLAG_COLUMN)))


def _note_failures(keyed: DataFrame, loaded: DataFrame, root: str, max_bytes: int | None, ledgers: L.Ledgers, run_id: str) -> None:
    """Status rows of the keys (``key, id``) that are not among the ``loaded`` ids; they are read again for the error."""
    missing = sync.drop_keys(keyed.select("key", "id"), loaded, "id")
    errors = read_bodies(missing, root, max_bytes=max_bytes).select(
        "key", F.col("id").alias("src_id"), F.lit(None).cast("string").alias("guid"),
        F.lit(None).cast("string").alias("policy_id"), "size",
        F.lit(None).cast("string").alias("sha1"), F.lit(False).alias("ok"),
        F.lit(False).alias("skipped"),
        F.coalesce(F.col("error"), F.lit("empty body")).alias("error"),
        F.lit(0.0).alias("elapsed_s"))
    L.append_status(errors, ledgers.status, run_id, L.next_run_no(keyed.sparkSession, ledgers.status), L.LOAD_CTX)


def insert_bodies(batch: DataFrame, pass_id: str, root: str, registry_path: str, first: int, per_task: int, n_tasks: int,
                  ledgers: L.Ledgers | None = None, max_bytes: int | None = MAX_BODY_BYTES) -> tuple[int, int, int]:
    """Append the bodies of a pass's planned rows (``key, id, again, pass_id``; a null id: nothing to insert).

    Returns (inserted, failed, rows of other passes). One job, whatever the registry holds: the counts
    are observed as the rows go by, and only failed reads are looked up, by their ids' range. A task takes
    runs of ``per_task`` ids (counted from the pass's ``first``), so that a file holds a range of ids.
    """
    offered, written = Observation(), Observation()
    mine = (F.col("pass_id") == pass_id) & F.col("id").isNotNull()
    seen = batch.observe(offered, F.count_if(mine).alias("n"), F.count_if(F.col("pass_id") != pass_id).alias("n_old"),
                         F.min(F.when(mine, F.col("id"))).alias("lo"), F.max(F.when(mine, F.col("id"))).alias("hi"))
    run = F.expr(f"cast((id - {first}) div {per_task} % {n_tasks} as int)")
    keyed = seen.where(mine).select("key", "id", "again").repartitionById(n_tasks, run)
    rows = _registry_rows(read_bodies(keyed, root, max_bytes=max_bytes), _own_name(F.col("again")))
    rows.observe(written, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(registry_path)
    facts, inserted = offered.get, written.get["n"]
    failed = facts["n"] - inserted
    if failed and ledgers is not None:
        loaded = batch.sparkSession.read.schema(R.REGISTRY_SCHEMA).parquet(registry_path).where(
            F.col("id").between(facts["lo"], facts["hi"])).select("id")
        _note_failures(batch.where(mine), loaded, root, max_bytes, ledgers, uuid.uuid4().hex)
    return inserted, failed, facts["n_old"]


# ------------------------------------------------------------ export pending

def export_keys(filename: Column, target_prefix: str = "", strip: str | None = None,
                leading_only: bool = False) -> Column:
    """Target key of a registry row: the name, a text stripped, under a prefix."""
    name = K.strip_text(filename, strip, leading_only) if strip else filename
    return K.join_key(target_prefix, name) if target_prefix else name


def export_pending(spark: SparkSession, registry: DataFrame | str, target_root: str,
                   ledgers: L.Ledgers, target_prefix: str = "", strip: str | None = None,
                   fail: Column | None = None, run_no: int | None = None,
                   ok_ledger: DataFrame | None = None,
                   tombstones: DataFrame | None = None) -> RunReport:
    """Write every pending row's body, then record the run in the status ledger.

    Which rows are pending is decided on keys only (the flag, earlier
    successes in ``ok_ledger``, tombstoned names); that set is written once
    and the bodies are attached by a counted broadcast semi-join, so a
    large registry's bodies are not shuffled for a small pending set. For a
    registry given by its path the tasks open just the row groups that hold
    pending rows (:mod:`blobferry.sources.file_index`), and no body is shuffled for any
    set. The registry is not rewritten: :func:`registry.current_view` reads the
    ledger to mark rows uploaded.
    """
    rep = RunReport(run_id=uuid.uuid4().hex, run_no=run_no or L.next_run_no(spark, ledgers.status))
    path = registry if isinstance(registry, str) else None
    if path:
        registry = R.read_registry(spark, path)
    keys = registry.select("id", "guid", "filename", K.FLAG_COLUMN)
    view = R.current_view(keys, ok_ledger=ok_ledger, tombstones=tombstones)
    pending = materialize(view.where(K.is_pending(K.FLAG_COLUMN)).select("id" if path else "guid").distinct(),
                          "pending")
    if path:
        pend = rows_by_id(spark, path, pending, per_task=OBJECTS_PER_TASK)
    else:
        right, n_pending = sync.checked_broadcast(pending)
        pend = registry.join(right, "guid", "left_semi")
        spread = spread_tasks(spark, n_pending)
        if spread:
            pend = pend.repartition(spread)  # round-robin: even objects per task
    status = export_bodies(pend, target_root,
                           key=export_keys(F.col("filename"), target_prefix, strip),
                           body="document", src_id="id", guid="guid", fail=fail)
    written = L.append_status(status, ledgers.status, rep.run_id, rep.run_no)
    rep.counts = status_totals(written).first().asDict()
    rep.committed = True
    return rep


def save_documents(spark: SparkSession, registry: DataFrame | str, ids: DataFrame, out_dir: str,
                   ledgers: L.Ledgers, run_no: int | None = None) -> RunReport:
    """Write the documents of many ids into ``out_dir`` under their filename
    (nested names make folders; absolute or ``..`` names are refused per row).
    A registry given by its path is read by row groups that hold the ids."""
    rep = RunReport(run_id=uuid.uuid4().hex, run_no=run_no or L.next_run_no(spark, ledgers.status))
    if isinstance(registry, str):
        rows = rows_by_id(spark, registry, ids, per_task=OBJECTS_PER_TASK)
    else:
        wanted, n_ids = sync.checked_broadcast(
            materialize(ids.select("id").where(F.col("id").isNotNull()).distinct(), "save-ids"))
        rows = registry.join(wanted, "id", "left_semi")
        spread = spread_tasks(spark, n_ids)
        if spread:
            rows = rows.repartition(spread)  # round-robin: even objects per task
    status = export_bodies(rows, out_dir, key="filename", body="document", src_id="id", guid="guid")
    written = L.append_status(status, ledgers.status, rep.run_id, rep.run_no)
    rep.counts = status_totals(written).first().asDict()
    rep.committed = True
    return rep


# ------------------------------------------------------------- incremental

Sink = Callable[[DataFrame, str], DataFrame]
"""A sink takes the run's rows and a run id, does its one write, and returns
status rows (key, src_id, ..., ok, skipped, error) - or raises."""


def late_rows(spark: SparkSession, source: DataFrame, keys: list[str], mark, ledgers: L.Ledgers, ctx: str,
              id_col: str = "ID", policy_col: str = "POLICY_ID") -> DataFrame | None:
    """Identities (``row``, staged) of source rows with a null leading key that no run of ``ctx`` has taken, or None.

    The leading key's null filter reaches the scan, so a source without such rows costs one
    look at its statistics. What earlier runs took comes from the context's own
    record. A context that has a mark but no record is older than the record: there
    rows with the id (and policy) of one of its status rows count as taken, and are recorded.
    """
    if not source.schema[keys[0]].nullable:
        return None
    rows = source.where(inc.no_place(keys))
    names = [id_col] + [policy_col] * (policy_col in source.columns)
    rows = rows.select(inc.row_identity(source, keys, id_col, policy_col).alias("row"),
                       *[F.col(c).cast("string").alias(f"_l{i}") for i, c in enumerate(names)])
    if rows.isEmpty():
        return None
    seen = L.taken_rows(spark, ledgers.taken, ctx)
    if seen is not None:
        rows = rows.join(seen, "row", "left_anti")
    elif mark is not None:
        status = L.read_status(spark, ledgers.status)
        if status is not None:
            old = status.where(F.col("ctx").isNull() | (F.col("ctx") == ctx)).select(
                F.col("src_id").cast("string").alias("_s0"), F.col("policy_id").alias("_s1")).distinct()
            match = F.col("_l0").eqNullSafe(F.col("_s0"))
            if len(names) > 1:
                match = match & F.col("_l1").eqNullSafe(F.col("_s1"))
            rows = materialize(rows, "rows-without-place")
            L.append_taken(rows.join(old, match, "left_semi").distinct(), ledgers.taken, ctx, 0)
            rows = rows.join(old, match, "left_anti")
    return materialize(rows.select("row").distinct(), "late-rows")


def next_batch(spark: SparkSession, source: DataFrame, keys: list[str], mark,
               ledgers: L.Ledgers | None = None, id_col: str = "ID",
               until=None, ctx: str | None = None, policy_col: str = "POLICY_ID",
               late: DataFrame | None = None) -> DataFrame:
    """Rows past the mark (and at most ``until``, if given), plus rows whose
    latest export (in context ``ctx``, or any) failed: the retries.

    With ``late`` (the staged :func:`late_rows` of this run, possibly none of
    them), rows with a null leading key are taken if they are in it, and only then.
    """
    fresh = inc.past_mark(source, keys, mark)
    if until is not None:
        fresh = inc.up_to(fresh, keys, until)
    n_late = 0
    if late is not None:
        right, n_late = sync.checked_broadcast(late.withColumnRenamed("row", "_row"))
        identity = inc.row_identity(source, keys, id_col, policy_col)
        fresh = fresh.where(~inc.no_place(keys))
        if n_late:
            fresh = fresh.unionByName(source.where(inc.no_place(keys)).join(right, identity == F.col("_row"), "left_semi"))
    if ledgers is None or (mark is None and late is None):
        return fresh
    failed = L.failed_keys(spark, ledgers.status, ctx)
    if failed is None:
        return fresh
    # The failed ids are staged and counted: a small set is broadcast, so the
    # source rows (with their bodies) are filtered in place, not shuffled.
    # Matched with the policy too: where an id repeats, another policy's older
    # row must not be written again over its newer object.
    id_type = source.schema[id_col].dataType
    ids = materialize(failed.select(F.col("src_id").cast(id_type).alias("_rid"),
                                    F.col("policy_id").alias("_rpolicy")).distinct(), "retry-ids")
    failures, n_failed = sync.checked_broadcast(ids)
    if n_failed == 0:
        return fresh
    match = F.col(id_col).eqNullSafe(F.col("_rid"))
    if policy_col in source.columns:
        match = match & F.col(policy_col).cast("string").eqNullSafe(F.col("_rpolicy"))
    # Failed rows are at or below the mark (they were in an earlier run), so
    # the two parts are disjoint and a plain union keeps each row once.
    below = source.where(inc.no_place(keys)) if mark is None else inc.up_to(source, keys, mark)
    retry = below.join(failures, match, "left_semi")
    if n_late:
        retry = retry.join(right, inc.no_place(keys) & (identity == F.col("_row")), "left_anti")
    return fresh.unionByName(retry)


def run_incremental(spark: SparkSession, source: DataFrame, ctx: str, strategy: str,
                    ledgers: L.Ledgers, sink: Sink, retry: bool = True,
                    id_col: str = "ID",
                    transform: Callable[[DataFrame], DataFrame] | None = None,
                    policy_col: str = "POLICY_ID") -> RunReport:
    """One bookmarked run: read mark -> fix the new mark -> batch ->
    [transform] -> sink -> status -> commit mark.

    The new high water is fixed first, from a keys-only aggregate of the rows
    past the mark; the sink then takes exactly the range (mark, new mark],
    bounded by literals that reach the scan, plus retries. A row that arrives
    during the run is left for the next one instead of being marked done
    without export. The bookmark is committed only after the sink's status
    rows are written; failed rows stay retryable through the status ledger.

    Rows with a null leading key have no place behind or before a mark. Each run
    stages those that its context's record does not hold (:func:`late_rows`), takes
    exactly them, and adds them to the record before the bookmark: each is
    exported once, whichever run it arrives in, and ``n_late`` counts them.
    ``transform`` is the caller's processing hook (DataFrame in, DataFrame
    out, keeping the id). It is evaluated once per row: a sink that reads its
    input once says so (``one_pass``); for any other the hook's output is staged.
    """
    keys = inc.strategy_keys(strategy)
    last_no, mark = L.last_bookmark(spark, ledgers.bookmarks, ctx)
    # A run that stopped between its status rows and its bookmark has used its
    # number: the next one is above both ledgers, so later always sorts later.
    run_no = max(last_no + 1, L.next_run_no(spark, ledgers.status))
    rep = RunReport(run_id=uuid.uuid4().hex, run_no=run_no, high_water=mark)
    placed = inc.past_mark(source, keys, mark).where(~inc.no_place(keys))
    hw_frame = inc.high_water_frame(placed, keys)
    hw_type = hw_frame.schema["high_water"]
    fresh_hw = hw_frame.first()["high_water"]
    new_mark = mark if fresh_hw is None else tuple(fresh_hw)
    late = late_rows(spark, source, keys, mark, ledgers, ctx, id_col, policy_col)
    rep.n_late = 0 if late is None else late.count()
    batch = next_batch(spark, source, keys, mark, ledgers if retry else None, id_col,
                       until=new_mark, ctx=ctx, policy_col=policy_col, late=late)
    if fresh_hw is None and not rep.n_late and ((mark is None and late is None) or batch.isEmpty()):
        rep.counts = {"n_rows": 0, "n_ok": 0, "n_skipped": 0, "n_failed": 0, "bytes_written": 0}
        return rep
    if transform:
        batch = transform(batch)
        if not getattr(sink, "one_pass", False):
            batch = materialize(batch, "hook-output")
    status = sink(batch, rep.run_id)
    with shuffles_go(spark):
        written = L.append_status(status, ledgers.status, rep.run_id, rep.run_no, ctx)
    totals = status_totals(written).first().asDict()
    if rep.n_late:
        L.append_taken(late, ledgers.taken, ctx, rep.run_no)
    rep.high_water = L.commit_bookmark(spark, ledgers.bookmarks, ctx, rep.run_no, strategy,
                                       new_mark, hw_type, totals["n_rows"],
                                       totals["n_ok"] + totals["n_skipped"], totals["n_failed"])
    rep.counts = totals
    rep.committed = True
    return rep


def json_sink(path: str, columns: list[str] | None = None, id_col: str = "ID",
              policy_col: str | None = "POLICY_ID") -> Sink:
    """Sink writing the rows as JSON; every row is ok once the write commits.

    The rows are evaluated once: the status rows are read back from what the write
    committed. Where the written ``columns`` lack the id or policy, the rows are
    staged first, with these, and both the JSON and the status come from there.
    """

    def _sink(batch: DataFrame, run_id: str) -> DataFrame:
        facts = [c for c in (id_col, policy_col) if c]
        target = f"{path}/run_id={run_id}"
        shown = {c.lower() for c in (columns or batch.columns)}
        if shown >= {c.lower() for c in facts}:
            write_json(batch, target, columns=columns)
            have = {f.name.lower(): f for f in batch.schema.fields}
            rows = read_json(batch.sparkSession, target, T.StructType([have[c.lower()] for c in facts]))
        else:
            rows = materialize(batch.select(*{c.lower(): c for c in (*columns, *facts)}.values()), "json-rows")
            write_json(rows, target, columns=columns)
        return rows.select(
            F.col(id_col).cast("string").alias("key"), F.col(id_col).cast("bigint").alias("src_id"),
            F.lit(None).cast("string").alias("guid"),
            (F.col(policy_col).cast("string") if policy_col else F.lit(None).cast("string")).alias("policy_id"),
            F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("string").alias("sha1"),
            F.lit(True).alias("ok"), F.lit(False).alias("skipped"),
            F.lit(None).cast("string").alias("error"), F.lit(0.0).alias("elapsed_s"))

    _sink.one_pass = True
    return _sink


def reconcile_targets(src: DataFrame, own: DataFrame | None, live: DataFrame,
                      verify_root: str | None = None) -> DataFrame:
    """:func:`sync.reconcile` of source, own writes and live listing, written once.

    With ``verify_root`` the objects that it would skip are hashed there
    (:func:`blobferry.sources.blobs.hash_objects`) and compared by their own hash: an object replaced by one of
    equal size is found too, and one that cannot be read counts as replaced. Nothing else is read.
    """
    live = live.select("key", "size", *(["sha1"] if "sha1" in live.columns else []))
    plan = materialize(sync.reconcile(src, own, live), "reconcile")
    if verify_root is None:
        return plan
    skips = plan.where(F.col("action") == sync.SKIP).select("key", F.col("target_size").alias("size"))
    facts = materialize(hash_objects(skips, verify_root).select(
        "key", F.coalesce("sha1", F.lit("unreadable")).alias("_sha1")), "verified")
    sha1 = F.col("sha1") if "sha1" in live.columns else F.lit(None).cast("string")
    found = live.select("key", "size", sha1.alias("sha1")).join(facts, "key", "left").select(
        "key", "size", F.coalesce("_sha1", "sha1").alias("sha1"))
    return materialize(sync.reconcile(src, own, found), "reconcile-verified")


def object_metadata(spark: SparkSession, root: str, suffix: str | None = None, prefix: str | None = None) -> DataFrame:
    """The complete listing of ``root`` with each object's metadata, as the store holds it
    (:func:`blobferry.sources.metadata.with_metadata`): one small request per object, spread over the tasks."""
    listing = list_all_objects(spark, root, suffix, prefix)
    spread = spread_tasks(spark, listing.count())
    return with_metadata(listing.repartition(spread) if spread else listing, root)


def blob_sink(target_root: str, target_listing: DataFrame | None = None,
              key_of: Callable[[DataFrame], Column] | None = None, body: str = K.BODY_COLUMN,
              id_col: str = "ID", policy_col: str = "POLICY_ID",
              order: tuple[str, ...] = ("MODIFIED", "ID"), fail: Column | None = None,
              compare_sha1: bool = False, size_col: str | None = None,
              written: DataFrame | None = None, verify: bool = False,
              metadata: dict[str, str | Column] | None = None) -> Sink:
    """Sink writing one object per target key.

    With ``compare_sha1`` and a listing without hashes the plan is a three-way one (:func:`reconcile_targets`):
    ``written`` is what earlier runs wrote, ``target_listing`` what is there now, so an object that was
    removed or replaced by another hand is written again; ``verify`` hashes the objects that
    would be skipped. ``metadata`` (name -> column) is kept with each object.

    ``written`` (column ``key``: objects of earlier runs, see
    :func:`ledgers.target_state`) keeps late rows from going back in time: a row
    whose first ``order`` column is null is older than any other of its target
    key, so it is skipped where the key was written before.

    The plan is made on keys, sizes and hashes only: the latest row per target
    key wins (ties: the greater size, then hash), and a target object of equal
    size (or sha1) means skip. One shuffle of keys, combined map-side, tells the
    latest row and whether others share its order and id. That small plan is written once to the shared
    folder, with the hash where such a tie needs it; bodies are then attached to the rows to write by target key and
    order tuple, in a join that is broadcast when the plan's row count is under
    a bound (so the bodies are not shuffled for it). Repeated equal rows give
    one object and one status row. With ``size_col`` no body is hashed, so rows
    that share key, order and id are refused in their status row. When
    there are many objects per core, the rows to write are spread round-robin
    so no task puts more than about ``OBJECTS_PER_TASK`` objects. Skipped rows
    never touch their bodies again. ``size_col`` names a stored size to use
    instead of measuring the body.
    """

    def _sink(batch: DataFrame, run_id: str) -> DataFrame:
        tkey = key_of(batch) if key_of else K.template_key(policy_col)
        size = F.col(size_col).cast("bigint") if size_col else K.byte_length(body)
        # The body is scanned for its size anyway, so its hash comes along and
        # tells apart rows that share key, order and id.
        hashed = compare_sha1 or size_col is None
        sha1 = F.unhex(K.body_sha1(body)) if hashed else F.lit(None).cast("binary")  # 20 bytes a row in the shuffle
        place = list(dict.fromkeys(order + (id_col,)))
        own = [f"_o{i}" for i in range(len(place))]
        at_id = own[place.index(id_col)]
        slim = batch.select(tkey.alias("key"), *[F.col(c).alias(o) for c, o in zip(place, own)],
                            size.alias("size"), sha1.alias("sha1"),
                            F.col(policy_col).cast("string").alias("_policy"), F.monotonically_increasing_id().alias("_row"))
        # Of the rows with a key's latest order and id, the greatest and least number: they differ if there are several.
        last, first = F.struct(*own, "_row"), F.struct(*own, (-F.col("_row")).alias("_row"))
        plan = slim.groupBy("key").agg(F.max(F.struct(*own, "size", "sha1", "_policy")).alias("_best"),
                                       F.max(last).alias("_last"), F.max(first).alias("_first"))
        plan = plan.select("key", *[F.col(f"_best.{c}").alias(c) for c in [*own, "size"]],
                           F.lower(F.hex("_best.sha1")).alias("sha1"), F.col("_best._policy").alias("_policy"),
                           (F.col("_last._row") != -F.col("_first._row")).alias("_tied"))
        if target_listing is not None and compare_sha1 and "sha1" not in target_listing.columns:
            plan = reconcile_targets(plan, written, target_listing, target_root if verify else None)
            plan = plan.where(F.col("action") != sync.NONE)
        elif target_listing is not None:
            plan = sync.size_plan(plan, target_listing, key="key", size="size",
                                  compare_sha1="sha1" if compare_sha1 else None)
        else:
            plan = plan.withColumn("action", F.lit(sync.NEW))
        if written is not None:
            # Only the few null-ordered rows are looked up; the others pass.
            late = materialize(plan.where(F.col(own[0]).isNull()).select("key"), "late-keys")
            if not late.isEmpty():
                old, _ = sync.checked_broadcast(materialize(
                    written.select(F.col("key").alias("_old")).join(late, F.col("_old") == F.col("key"), "left_semi").distinct(),
                    "late-targets"))
                plan = plan.join(old, F.col("key") == F.col("_old"), "left").withColumn(
                    "action", F.when(F.col("_old").isNotNull() & F.col(own[0]).isNull(), sync.SKIP).otherwise(F.col("action")))
        with shuffles_go(batch.sparkSession):
            plan = materialize(plan.select("key", *own, "size", F.when(F.col("_tied"), F.col("sha1")).alias("sha1"), "_policy",
                                           "_tied", "action"), "export-plan")

        def settled(rows: DataFrame, ok: bool, error: str | None) -> DataFrame:
            return rows.select(
                "key", F.col(at_id).cast("bigint").alias("src_id"),
                F.lit(None).cast("string").alias("guid"), F.col("_policy").alias("policy_id"), "size",
                F.lit(None).cast("string").alias("sha1"), F.lit(ok).alias("ok"), F.lit(ok).alias("skipped"),
                F.lit(error).cast("string").alias("error"), F.lit(0.0).alias("elapsed_s"))

        writes = plan.where(F.col("action") != sync.SKIP)
        done = settled(plan.where(F.col("action") == sync.SKIP), True, None)
        if not hashed:
            # Nothing tells such rows apart: refuse them instead of guessing.
            unclear = writes.where("_tied")
            done = done.unionByName(settled(unclear, False, "several rows share key, order and id"))
            writes = writes.where("not _tied")
        n_write, n_bytes, n_tied = writes.agg(
            F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0)), F.count_if("_tied")).first()
        # A counted bound (the plan is staged): broadcast only up to it.
        to_write = writes.select(F.col("key").alias("_wkey"), *[F.col(o).alias(f"_w{o}") for o in own],
                                 F.col("sha1").alias("_wsha1"), F.col("_tied").alias("_wtied"))
        # Above it the plan is merged, however few bytes its file has: rows are far larger on the driver.
        to_write = to_write.hint("broadcast" if n_write <= sync.BROADCAST_MAX_ROWS else "merge")
        # Attached by target key and the whole order tuple, null-safe: an id
        # that repeats, or is null, still finds its own body only.
        match = F.col("_key").eqNullSafe(F.col("_wkey"))
        for c, o in zip(place, own):
            match = match & F.col(c).eqNullSafe(F.col(f"_w{o}"))
        if n_tied:
            match = match & (~F.col("_wtied") | K.body_sha1(body).eqNullSafe(F.col("_wsha1")))
        rows = batch.withColumn("_key", tkey).join(to_write, match, "inner")
        spread = spread_tasks(batch.sparkSession, n_write, n_bytes)
        if spread:
            rows = rows.repartition(spread)  # round-robin: even objects per task
        put = export_bodies(rows, target_root, key="_key", body=body, src_id=id_col,
                                policy_id=policy_col, fail=fail, metadata=metadata)
        if n_tied:
            # Repeated rows put the same bytes under one key: one status row.
            put = sync.latest_per_key(put, "key", ["ok"]).select(*put.columns)
        return put.unionByName(done)

    return _sink


# ------------------------------------------------------------ registry sync

def sync_registry(spark: SparkSession, registry_view: DataFrame, listing: DataFrame,
                  ledgers: L.Ledgers, allow_mass_delete: bool = False,
                  max_share: float = 0.5, suffix: str | None = None,
                  prefix: str | None = None) -> RunReport:
    """Tombstone registry keys whose object is gone.

    ``suffix`` and ``prefix`` limit both sides, listing and registry, so a
    narrowed listing never deletes rows it did not look for. A listing that
    failed raises before this point; an empty listing or a large orphan share
    of the rows in scope is refused unless ``allow_mass_delete``. The orphan
    set is computed once and staged; the guard reads its count.
    """
    rep = RunReport(run_id=uuid.uuid4().hex)
    for test, text in ((K.has_suffix, suffix), (K.has_prefix, prefix)):
        if text:
            registry_view = registry_view.where(test("filename", text))
            listing = listing.where(test("key", text))
    gone = sync.orphans(registry_view.select(F.col("filename").alias("key")), listing)
    if "id" in registry_view.columns:
        # The greatest row id of the key: rows added later under the same
        # name have a greater one and stay visible.
        last = registry_view.groupBy(F.col("filename").alias("key")).agg(F.max("id").alias("id"))
        gone = last.join(gone, "key", "left_semi")
    orphan = materialize(gone, "orphans")
    n_existing = sync.distinct_keys(registry_view, "filename").count()
    n_listed = listing.limit(1).count()
    n_orphans = orphan.count()
    sync.mass_delete_guard(n_existing, n_orphans, n_listed, max_share, allow_mass_delete)
    if n_orphans:
        L.append_tombstones(orphan, ledgers.tombstones, rep.run_id)
    rep.counts = {"existing": n_existing, "orphans": n_orphans}
    rep.committed = True
    return rep
