"""Registered queries over the test tables, each with its SQL oracle.

Every query reads whole tables (roles in :mod:`blobferry.roles`); queries that
write do so below the shared folder in a fresh path and read the result back,
so the real sinks and sources are exercised.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobferry import roles
from blobferry.functions import keys as K
from blobferry.operators import incremental as inc
from blobferry.operators import sync
from blobferry.operators.batching import batch_report
from blobferry.plans import jobs
from blobferry.session import ensure_checkpoint_dir, scratch_path
from blobferry.sinks import ledgers as L
from blobferry.sinks.export import export_bodies
from blobferry.sinks.json_sink import read_json, write_json
from blobferry.sources import registry as R
from blobferry.sources.blobs import join_chunks, lookup, read_chunks
from blobferry.sources.compaction import compact_files
from blobferry.sources.file_index import rows_by_id
from blobferry.sources.listing import list_all_objects, list_objects, read_objects
from blobferry.streaming.ingest import ingest_new_objects, read_ingested, stream_into_registry

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the test queries.
TS_MARK = dt.datetime(2024, 1, 15)
ID_MARK = 7500
ORDERS_MARK = (dt.datetime(1998, 1, 1), 7000)
RUN_CUTS = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20), None)
BATCH_SIZE = 100
CHUNK = 1024
FIRST_N = 100


def _events_before(src: DataFrame, cut: dt.datetime) -> DataFrame:
    """Source rows modified at or before ``cut`` (the table as it stood then)."""
    return src.where(F.col("MODIFIED") <= F.lit(cut.isoformat(" ")).cast("timestamp_ntz"))


def _src_cols(df: DataFrame) -> DataFrame:
    return df.select(*roles.SOURCE_COLUMNS)


def _export_documents(spark: SparkSession, sf: str, purpose: str) -> str:
    """Write every document body as the object ``{source}/doc_{id}.txt``
    (status rows to a ledger beside it); returns the root folder."""
    root = scratch_path(spark, purpose)
    docs = roles.table(spark, sf, "documents")
    status = export_bodies(docs, root, key=F.concat_ws("/", "source", roles.doc_key("doc_id")),
                           body="text", src_id="doc_id")
    L.append_status(status, f"{root}-ledger/status", purpose, 1)
    return root


# ------------------------------------------------------------------ queries

def object_listing(spark, sf):
    lst = roles.page_listing(spark, sf)
    return lst.where(K.has_prefix("key", "https://") & K.has_suffix("key", ".html")).select("key", "size")


def listing_count(spark, sf):
    lst = roles.page_listing(spark, sf).where(K.has_suffix("key", ".html"))
    return lst.agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def distinct_keys(spark, sf):
    # Two shards of a listing, accumulated as a set.
    docs = roles.table(spark, sf, "documents")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    shards = [docs.where(english).select("source"), docs.where(~english).select("source")]
    return sync.distinct_keys(sync.accumulate(shards), "source")


def blob_roundtrip(spark, sf):
    root = _export_documents(spark, sf, "roundtrip")
    objs = read_objects(spark, root, suffix=".txt")
    return objs.select("key", "size", K.body_sha1("content").alias("sha1"))


def chunked_bodies(spark, sf):
    # Every object in ranges of at most CHUNK bytes; the joined ranges hash as the object does.
    root = _export_documents(spark, sf, "chunked")
    chunks = read_chunks(list_all_objects(spark, root, suffix=".txt").select("key", "size"), root, chunk_bytes=CHUNK)
    return join_chunks(chunks).select("key", "size", "sha1", "n_chunks")


def complete_listing(spark, sf):
    root = _export_documents(spark, sf, "listing")
    return list_all_objects(spark, root, suffix=".txt").select("key", "size")


def prefix_listing(spark, sf):
    # A prefix that ends inside a folder's name: src1, src10, src11, ...
    root = _export_documents(spark, sf, "prefix-src")
    return list_all_objects(spark, root, prefix="src1").select("key", "size")


def object_metadata(spark, sf):
    # One object per policy with its policy id and event type, read back from the store.
    root = scratch_path(spark, "metadata")
    sink = jobs.blob_sink(root, metadata={"policy_id": "POLICY_ID", "company": "COMPANY"})
    led = L.Ledgers(scratch_path(spark, "metadata-state"))
    jobs.run_incremental(spark, roles.source_from_events(spark, sf), "metadata", "modified_id", led, sink)
    meta = F.col("metadata")
    return jobs.object_metadata(spark, root, suffix=".pdf").select(
        "key", "size", meta["policy_id"].alias("policy_id"), meta["company"].alias("company"))


def reconcile_targets(spark, sf):
    # Every document was exported once. By now the target lacks the German ones, holds others of the same size for the
    # French ones and html pages that nobody exported; the source has new texts for the toxic ones and no Spanish ones.
    docs = roles.table(spark, sf, "documents")
    key = roles.doc_key("doc_id")
    once = L.append_status(export_bodies(docs, scratch_path(spark, "reconcile-once"), key=key, body="text", src_id="doc_id"),
                           scratch_path(spark, "reconcile-state"), "reconcile", 1)
    root = scratch_path(spark, "reconcile-now")
    body = F.when(F.col("lang") == "fr", F.repeat(F.lit("x"), F.octet_length("text"))).otherwise(F.col("text"))
    now = docs.where("lang <> 'de'").select(key.alias("key"), body.alias("body")).unionByName(
        roles.table(spark, sf, "pages").select(F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("key"),
                                               F.col("html").alias("body")))
    L.append_status(export_bodies(now, root), f"{root}-ledger/status", "reconcile", 1)
    toxic = roles.table(spark, sf, "labels").where("toxic = 1").select("doc_id", F.lit("!").alias("_mark"))
    text = F.concat("text", F.coalesce("_mark", F.lit("")))
    src = docs.where("lang <> 'es'").join(toxic, "doc_id", "left").select(
        key.alias("key"), K.byte_length(text).alias("size"), K.body_sha1(text).alias("sha1"))
    own = once.where("ok").select("key", "size", "sha1")
    return jobs.reconcile_targets(src, own, list_all_objects(spark, root), verify_root=root).select("key", "state", "action")


def file_listing(spark, sf):
    # The key prefix is the operator under test: a text prefix, not a folder,
    # so "src1" takes src1/ and src10/ to src19/. The whole tree is listed.
    root = _export_documents(spark, sf, "filelisting")
    return list_objects(spark, root, suffix=".txt", prefix="src1").select("key", "size")


def pending_blobs(spark, sf):
    reg = roles.registry(spark, sf, facts=True)
    return reg.where(K.is_pending(K.FLAG_COLUMN)).select("guid", "filename", "size", "sha1")


def blobs_by_id(spark, sf):
    reg = roles.registry(spark, sf, facts=True)
    ids = roles.table(spark, sf, "labels").where(F.col("toxic") == 1).select(F.col("doc_id").alias("id"))
    return lookup(reg, ids).select("id", "guid", "filename", "size", "sha1")


def pruned_lookup(spark, sf):
    # The same lookup from a registry of many files, by their id ranges.
    path = scratch_path(spark, "ranged-registry")
    roles.registry(spark, sf).repartitionByRange(24, "id").write.parquet(path)
    ids = roles.table(spark, sf, "documents").where(F.col("doc_id") % 20 == 3).select(F.col("doc_id").alias("id"))
    rows = rows_by_id(spark, path, ids.unionAll(spark.range(10 ** 12, 10 ** 12 + 3)))
    return rows.select("id", "guid", "filename", K.byte_length("document").alias("size"), K.body_sha1("document").alias("sha1"))


def save_by_id(spark, sf):
    # Every labelled toxic document saved to a folder under its nested name.
    reg = roles.registry(spark, sf).withColumn("filename", F.concat_ws("/", F.lit("by_id"), "filename"))
    ids = roles.table(spark, sf, "labels").where(F.col("toxic") == 1).select(F.col("doc_id").alias("id"))
    out = scratch_path(spark, "saved")
    jobs.save_documents(spark, reg, ids, out, L.Ledgers(f"{out}-state"))
    return read_objects(spark, out).select("key", "size", K.body_sha1("content").alias("sha1"))


def new_objects(spark, sf):
    reg = roles.registry(spark, sf, facts=True)
    listing = reg.select(F.col("filename").alias("key"), "size")
    return sync.new_objects(listing, roles.loaded_keys(spark, sf))


def orphan_keys(spark, sf):
    reg = roles.registry(spark, sf, with_body=False)
    return sync.orphans(reg.select(F.col("filename").alias("key")), roles.live_keys(spark, sf))


def orphan_delete(spark, sf):
    reg = roles.registry(spark, sf, with_body=False)
    led = L.Ledgers(scratch_path(spark, "sync"))
    jobs.sync_registry(spark, reg, roles.live_keys(spark, sf), led, allow_mass_delete=True)
    view = R.current_view(reg, tombstones=L.read_tombstones(spark, led.tombstones))
    return view.select("id", "filename")


def size_skip_plan(spark, sf):
    reg = roles.registry(spark, sf, facts=True)
    src = reg.select(F.col("filename").alias("key"), "size")
    plan = sync.size_plan(src, roles.target_listing(spark, sf))
    return plan.select("key", "size", "target_size", "action")


def incr_timestamp(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    return inc.past_mark(src, inc.strategy_keys("timestamp"), (TS_MARK,))


def incr_id(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    return inc.past_mark(src, inc.strategy_keys("id"), (ID_MARK,))


def incr_composite(spark, sf):
    src = roles.source_from_orders(spark, sf)
    return inc.past_mark(src, inc.strategy_keys("modified_id"), ORDERS_MARK)


def incr_composite_keys(spark, sf):
    # The five-key composite bookmark in its given order (ID first): a run over
    # the rows seen up to TS_MARK, then the rows the next run would take.
    src = roles.source_from_events(spark, sf, with_body=False)
    led = L.Ledgers(scratch_path(spark, "composite"))
    jobs.run_incremental(spark, _events_before(src, TS_MARK), "composite", "composite", led,
                         jobs.json_sink(scratch_path(spark, "composite-json")))
    _, mark = L.last_bookmark(spark, led.bookmarks, "composite")
    return jobs.next_batch(spark, src, inc.strategy_keys("composite"), mark, led)


def bookmark_runs(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    led = L.Ledgers(scratch_path(spark, "bookmarks"))
    out = scratch_path(spark, "bookmark-json")
    for cut in RUN_CUTS:  # the source as it stood at each run
        visible = src if cut is None else _events_before(src, cut)
        jobs.run_incremental(spark, visible, "events_json", "modified_id", led, jobs.json_sink(out))
    b = spark.read.parquet(led.bookmarks)
    return b.select("run_no", "n_rows", "n_failed", F.col("high_water.MODIFIED").alias("hw_modified"),
                    F.col("high_water.ID").alias("hw_id"))


def retry_failures(spark, sf):
    src = roles.source_from_events(spark, sf)
    led = L.Ledgers(scratch_path(spark, "retry"))
    target = scratch_path(spark, "retry-objects")
    sink = jobs.blob_sink(target, key_of=lambda b: K.template_key("ID", "event_", ".bin"),
                          fail=F.col("COMPANY") == "error")
    jobs.run_incremental(spark, _events_before(src, TS_MARK), "events_blobs", "modified_id", led, sink)
    _, mark = L.last_bookmark(spark, led.bookmarks, "events_blobs")
    nxt = jobs.next_batch(spark, src, inc.strategy_keys("modified_id"), mark, led)
    return _src_cols(nxt)


def record_hash(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    return src.select("ID", K.record_hash(list(roles.SOURCE_COLUMNS)).alias("RECORD_HASH"))


def safe_record_hash(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    return src.select("ID", K.safe_record_hash(list(roles.SOURCE_COLUMNS)).alias("SAFE_HASH"))


def key_text(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    return K.with_key_text(src, list(roles.SOURCE_COLUMNS)).select("ID", "CALCULATED_HASH")


# Source column, its type, target column, target type.
EVENT_MAPPING = [
    ("event_id", "bigint", "ID", "bigint"),
    ("user_id", "bigint", "POLICY_ID", "string"),
    ("ts", "timestamp_ntz", "MODIFIED", "string"),
]


def apply_mapping(spark, sf):
    return K.apply_mapping(roles.table(spark, sf, "events"), EVENT_MAPPING)


def json_full(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    path = scratch_path(spark, "json-full")
    write_json(src, path)
    return read_json(spark, path, src.schema)


def json_projected(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    path = scratch_path(spark, "json-projected")
    write_json(src, path, columns=["MODIFIED"])
    return read_json(spark, path, src.select("MODIFIED").schema)


def batch_report_q(spark, sf):
    docs = roles.table(spark, sf, "documents").select("doc_id", K.byte_length("text").alias("size"))
    return batch_report(docs, ["doc_id"], BATCH_SIZE, size_col="size")


def ordered_first_n(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    return inc.bounded_run(src, inc.strategy_keys("modified_id"), FIRST_N)


def key_derivation(spark, sf):
    pages = roles.table(spark, sf, "pages")
    bucket, prefix = K.split_uri("url")
    name = K.template_key("page_id")
    return pages.select(
        "page_id", bucket.alias("bucket"), prefix.alias("prefix"),
        K.join_key(prefix, name).alias("object_key"),
        K.strip_text("url", "https://").alias("stripped"),
        K.join_key("downloads", K.strip_text(prefix, "/")).alias("local_path"))


def registry_append(spark, sf):
    path = scratch_path(spark, "registry")
    R.create_if_absent(spark, path)
    rows = roles.registry(spark, sf).select("id", "guid", "filename", "document")
    R.append(spark, path, rows)
    reg = spark.read.parquet(path)
    return reg.select("id", "guid", "filename", K.byte_length("document").alias("size"),
                      K.body_sha1("document").alias("sha1"), K.FLAG_COLUMN)


def mark_uploaded(spark, sf):
    reg = roles.registry(spark, sf, extra=("lang",))
    led = L.Ledgers(scratch_path(spark, "mark"))
    jobs.export_pending(spark, reg, scratch_path(spark, "mark-objects"), led,
                        fail=F.col("lang") == "de")
    view = R.current_view(roles.registry(spark, sf, with_body=False),
                          ok_ledger=L.ok_guids(spark, led.status))
    return view.select("id", K.FLAG_COLUMN)


def latest_per_key(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    return sync.latest_per_key(src, "POLICY_ID", ["MODIFIED", "ID"], payload=["COMPANY"])


def run_report(spark, sf):
    src = roles.source_from_events(spark, sf)
    target = scratch_path(spark, "report-objects")
    # Run 1: nothing in the target yet; one object per policy, latest row wins.
    first = L.Ledgers(scratch_path(spark, "report-1"))
    jobs.run_incremental(spark, src, "export", "modified_id", first, jobs.blob_sink(target))
    # Run 2: the same job from scratch against the real listing of the target;
    # every object is there with equal size, so nothing is written again.
    second = L.Ledgers(scratch_path(spark, "report-2"))
    listing = list_all_objects(spark, target, suffix=".pdf")
    jobs.run_incremental(spark, src, "export", "modified_id", second,
                         jobs.blob_sink(target, target_listing=listing))
    status = (spark.read.parquet(first.status).withColumn("run", F.lit(1).cast("bigint"))
              .unionByName(spark.read.parquet(second.status).withColumn("run", F.lit(2).cast("bigint"))))
    written = F.col("ok") & ~F.col("skipped")
    return status.groupBy("run").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(written).cast("bigint").alias("n_ok"),
        F.count_if(F.col("skipped")).cast("bigint").alias("n_skipped"),
        F.count_if(~F.col("ok")).cast("bigint").alias("n_failed"),
        F.coalesce(F.sum(F.when(written, F.col("size"))), F.lit(0)).cast("bigint").alias("bytes_written"),
        F.count_distinct("policy_id").cast("bigint").alias("n_policies"))


def transform_hook(spark, sf):
    src = roles.source_from_events(spark, sf, with_body=False)
    led = L.Ledgers(scratch_path(spark, "hook"))
    out = scratch_path(spark, "hook-json")

    def add_key_text(df: DataFrame) -> DataFrame:
        return K.with_key_text(df, list(roles.SOURCE_COLUMNS))

    jobs.run_incremental(spark, src, "hook", "id", led, jobs.json_sink(out), transform=add_key_text)
    schema = add_key_text(src).schema
    return read_json(spark, out, schema).select("ID", "CALCULATED_HASH")


def _counting_hook(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("bigint")
    def counted(ids: pd.Series) -> pd.Series:
        seen.add(len(ids))
        return ids

    return seen, lambda df: df.withColumn("ID", counted(F.col("ID").cast("bigint")))


def hook_once(spark, sf):
    # The hook counts the rows it sees: once each, whether the sink is JSON with the id,
    # JSON of one column without it, or objects.
    rows = []
    cases = (("json", "id", lambda out: jobs.json_sink(out), False),
             ("json_projected", "id", lambda out: jobs.json_sink(out, columns=["MODIFIED"]), False),
             ("objects", "modified_id", lambda out: jobs.blob_sink(out), True))
    for name, strategy, sink_of, with_body in cases:
        seen, hook = _counting_hook(spark)
        src = roles.source_from_events(spark, sf, with_body=with_body)
        led = L.Ledgers(scratch_path(spark, "once"))
        rep = jobs.run_incremental(spark, src, name, strategy, led, sink_of(scratch_path(spark, "once-out")), transform=hook)
        rows.append((name, rep.counts["n_rows"], seen.value))
    return spark.createDataFrame(rows, "sink string, n_rows long, n_evaluated long")


def stream_ingest(spark, sf):
    root = scratch_path(spark, "stream-src")
    sink = scratch_path(spark, "stream-sink")
    ckpt = scratch_path(spark, "stream-ckpt")
    docs = roles.table(spark, sf, "documents")
    key = F.concat_ws("/", "source", roles.doc_key("doc_id"))
    # Two arrivals: English documents first, then all others; a run after each.
    for wave in (F.col("lang") == "en", ~(F.col("lang") == "en") | F.col("lang").isNull()):
        st = export_bodies(docs.where(wave), root, key=key, body="text", src_id="doc_id")
        L.append_status(st, f"{root}-ledger/status", "stream", 1)
        ingest_new_objects(spark, root, sink, ckpt, suffix=".txt", max_files_per_trigger=2000)
    return read_ingested(spark, sink).select(F.col("filename").alias("key"), "size", "sha1")


def stream_registry(spark, sf):
    # The new-keys loader as a stream: two arrivals of documents, a run after
    # each, straight into a registry that already holds the labelled ones.
    root = scratch_path(spark, "stream-reg-src")
    reg_path = scratch_path(spark, "stream-registry")
    docs = roles.table(spark, sf, "documents")
    key = F.concat_ws("/", "source", roles.doc_key("doc_id"))
    labelled = roles.table(spark, sf, "labels").select("doc_id")
    start = (docs.join(labelled, "doc_id", "left_semi")
             .select(F.col("doc_id").alias("id"), K.derived_guid(key).alias("guid"),
                     key.alias("filename"), F.col("text").cast("binary").alias("document")))
    R.append(spark, reg_path, start)
    ckpt = scratch_path(spark, "stream-reg-ckpt")
    for wave in (F.col("lang") == "en", ~(F.col("lang") == "en") | F.col("lang").isNull()):
        st = export_bodies(docs.where(wave), root, key=key, body="text", src_id="doc_id")
        L.append_status(st, f"{root}-ledger/status", "stream", 1)
        stream_into_registry(spark, root, reg_path, ckpt, suffix=".txt", max_files_per_trigger=5000)
    reg = spark.read.parquet(reg_path)
    return reg.select(F.col("filename").alias("key"), K.byte_length("document").alias("size"),
                      K.body_sha1("document").alias("sha1"))


def stream_retry(spark, sf):
    # Long documents cannot be read in the first pass; the second takes them with its own new
    # objects. Then the labelled rows are deleted, and a pass without new files finds their objects again.
    root = scratch_path(spark, "retry-src")
    reg_path, ckpt = scratch_path(spark, "retry-registry"), scratch_path(spark, "retry-ckpt")
    led, gone = L.Ledgers(scratch_path(spark, "retry-state")), L.Ledgers(scratch_path(spark, "retry-sync"))
    docs = roles.table(spark, sf, "documents")
    key = F.concat_ws("/", "source", roles.doc_key("doc_id"))
    for wave, most in ((F.col("lang") == "en", 2000), (~(F.col("lang") == "en") | F.col("lang").isNull(), None)):
        L.append_status(export_bodies(docs.where(wave), root, key=key, body="text", src_id="doc_id"),
                        f"{root}-ledger/status", "stream", 1)
        stream_into_registry(spark, root, reg_path, ckpt, suffix=".txt", ledgers=led, sync_ledgers=gone, max_bytes=most)
    labelled = docs.join(roles.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select(key.alias("key"))
    kept = sync.drop_keys(list_all_objects(spark, root), labelled, "key")
    jobs.sync_registry(spark, spark.read.parquet(reg_path), kept, gone, allow_mass_delete=True)
    stream_into_registry(spark, root, reg_path, ckpt, suffix=".txt", ledgers=led, sync_ledgers=gone)
    reg = spark.read.parquet(reg_path)
    view = R.current_view(reg, tombstones=L.read_tombstones(spark, gone.tombstones))
    rows = reg.groupBy("filename").agg(F.count(F.lit(1)).alias("n_rows"))
    return view.join(rows, "filename").select(F.col("filename").alias("key"), K.byte_length("document").alias("size"),
                                              K.body_sha1("document").alias("sha1"), "n_rows")


def load_new_objects(spark, sf):
    root = _export_documents(spark, sf, "load-src")
    reg_path = scratch_path(spark, "load-registry")
    docs = roles.table(spark, sf, "documents")
    labelled = roles.table(spark, sf, "labels").select("doc_id")
    start = (docs.join(labelled, "doc_id", "left_semi")
             .select(F.col("doc_id").alias("id"),
                     K.derived_guid(F.concat_ws("/", "source", roles.doc_key("doc_id"))).alias("guid"),
                     F.concat_ws("/", "source", roles.doc_key("doc_id")).alias("filename"),
                     F.col("text").cast("binary").alias("document")))
    R.append(spark, reg_path, start)
    before = spark.read.parquet(reg_path).select("filename")
    jobs.load_new(spark, root, reg_path, suffix=".txt")
    after = spark.read.parquet(reg_path)
    added = sync.drop_keys(after, before, "filename")
    return added.select(F.col("filename").alias("key"), K.byte_length("document").alias("size"),
                        K.body_sha1("document").alias("sha1"))


def compact_registry(spark, sf):
    # Load all, delete the poor ones and compact, then the other labelled ones and compact again.
    root = _export_documents(spark, sf, "compact-src")
    reg_path = scratch_path(spark, "compact-registry")
    jobs.load_new(spark, root, reg_path, suffix=".txt")
    labelled = roles.table(spark, sf, "documents").join(roles.table(spark, sf, "labels"), "doc_id") \
        .select(F.concat_ws("/", "source", roles.doc_key("doc_id")).alias("filename"), "quality").groupBy("filename").agg(F.max("quality").alias("quality"))
    removed = []
    for poor in (True, False):
        gone = labelled.where((F.coalesce(F.col("quality"), F.lit(0)) == 0) == F.lit(poor))
        rows = R.read_registry(spark, reg_path).select("id", "filename").join(gone, "filename", "left_semi")
        removed.append(compact_files(spark, reg_path, rows.select(F.col("filename").alias("key"), "id"))["rows_removed"])
    return R.read_registry(spark, reg_path).select(
        F.col("filename").alias("key"), K.byte_length("document").alias("size"), K.body_sha1("document").alias("sha1"),
        F.lit(removed[0]).cast("long").alias("n_first"), F.lit(removed[1]).cast("long").alias("n_second"))


def incr_composite_nulls(spark, sf):
    # Rows with a null key: two runs of the composite bookmark, read back.
    src = roles.source_from_events(spark, sf, with_body=False)
    src = src.withColumn("COMPANY", F.when(F.col("COMPANY") != "error", F.col("COMPANY")))
    led = L.Ledgers(scratch_path(spark, "nulls"))
    out = scratch_path(spark, "nulls-json")
    for visible in (src.where(F.col("ID") <= ID_MARK), src):  # as it stood at each run
        jobs.run_incremental(spark, visible, "nulls", "composite", led, jobs.json_sink(out))
    return _src_cols(read_json(spark, out, src.schema))


def incr_late_nulls(spark, sf):
    # Three runs of the timestamp bookmark. Every seventh row of the second and third
    # arrival has no MODIFIED: it is behind the mark on arrival. Which run took each row?
    src = roles.source_from_events(spark, sf, with_body=False)
    led = L.Ledgers(scratch_path(spark, "late"))
    out = scratch_path(spark, "late-json")
    shown = F.when((F.col("MODIFIED") <= F.lit(RUN_CUTS[0].isoformat(sep=" ")).cast("timestamp_ntz"))
                   | (F.col("ID") % 7 != 0), F.col("MODIFIED")).alias("MODIFIED")
    for cut in RUN_CUTS:
        visible = src if cut is None else _events_before(src, cut)
        jobs.run_incremental(spark, visible.select("ID", "POLICY_ID", "COMPANY", "BROKER", shown), "late", "timestamp",
                             led, jobs.json_sink(out))
    runs = spark.read.parquet(led.status).select(F.col("src_id").alias("ID"), "run_no")
    rows = read_json(spark, out, src.schema).groupBy("ID", "MODIFIED").agg(F.count(F.lit(1)).alias("n_times"))
    return rows.join(runs, "ID")


def export_repeated_ids(spark, sf):
    # The id is the customer, so it repeats over policies and over versions.
    o = roles.table(spark, sf, "orders")
    src = o.select(F.col("o_custkey").alias("ID"),
                   F.concat_ws("-", "o_custkey", "o_orderstatus").alias("POLICY_ID"),
                   F.col("o_orderdate").alias("MODIFIED"),
                   F.concat_ws(":", "o_orderkey", "o_orderpriority").cast("binary").alias(K.BODY_COLUMN))
    led = L.Ledgers(scratch_path(spark, "repeated"))
    out = scratch_path(spark, "repeated-objects")
    jobs.run_incremental(spark, src, "repeated", "modified_id", led, jobs.blob_sink(out))
    return read_objects(spark, out).select("key", "size", K.body_sha1("content").alias("sha1"))


def sync_prefix(spark, sf):
    reg = roles.registry(spark, sf, with_body=False)
    led = L.Ledgers(scratch_path(spark, "sync-prefix"))
    jobs.sync_registry(spark, reg, roles.live_keys(spark, sf), led, allow_mass_delete=True,
                       prefix="doc_5")
    view = R.current_view(reg, tombstones=L.read_tombstones(spark, led.tombstones))
    return view.select("id", "filename")


def readd_after_delete(spark, sf):
    # Load all, delete the labelled ones, find their objects again and reload.
    root = _export_documents(spark, sf, "readd-src")
    reg_path = scratch_path(spark, "readd-registry")
    led = L.Ledgers(scratch_path(spark, "readd"))
    jobs.load_new(spark, root, reg_path, suffix=".txt")
    listing = list_all_objects(spark, root, suffix=".txt")
    labelled = roles.table(spark, sf, "documents").join(
        roles.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    gone = labelled.select(F.concat_ws("/", "source", roles.doc_key("doc_id")).alias("key"))
    jobs.sync_registry(spark, spark.read.parquet(reg_path), sync.drop_keys(listing, gone, "key"), led,
                       allow_mass_delete=True)
    tomb = L.read_tombstones(spark, led.tombstones)
    jobs.load_new(spark, root, reg_path, suffix=".txt", tombstones=tomb)
    view = R.current_view(spark.read.parquet(reg_path), tombstones=tomb)
    return view.select(F.col("filename").alias("key"), K.byte_length("document").alias("size"),
                       K.body_sha1("document").alias("sha1"))


QUERIES: dict[str, Query] = {
    "object_metadata": object_metadata,
    "reconcile_targets": reconcile_targets,
    "compact_registry": compact_registry,
    "incr_late_nulls": incr_late_nulls,
    "incr_composite_nulls": incr_composite_nulls,
    "export_repeated_ids": export_repeated_ids,
    "sync_prefix": sync_prefix,
    "readd_after_delete": readd_after_delete,
    "object_listing": object_listing,
    "listing_count": listing_count,
    "distinct_keys": distinct_keys,
    "blob_roundtrip": blob_roundtrip,
    "chunked_bodies": chunked_bodies,
    "complete_listing": complete_listing,
    "prefix_listing": prefix_listing,
    "file_listing": file_listing,
    "pending_blobs": pending_blobs,
    "blobs_by_id": blobs_by_id,
    "pruned_lookup": pruned_lookup,
    "save_by_id": save_by_id,
    "new_objects": new_objects,
    "orphan_keys": orphan_keys,
    "orphan_delete": orphan_delete,
    "size_skip_plan": size_skip_plan,
    "incr_timestamp": incr_timestamp,
    "incr_id": incr_id,
    "incr_composite": incr_composite,
    "incr_composite_keys": incr_composite_keys,
    "bookmark_runs": bookmark_runs,
    "retry_failures": retry_failures,
    "record_hash": record_hash,
    "safe_record_hash": safe_record_hash,
    "key_text": key_text,
    "apply_mapping": apply_mapping,
    "json_full": json_full,
    "json_projected": json_projected,
    "batch_report": batch_report_q,
    "ordered_first_n": ordered_first_n,
    "key_derivation": key_derivation,
    "registry_append": registry_append,
    "mark_uploaded": mark_uploaded,
    "latest_per_key": latest_per_key,
    "run_report": run_report,
    "transform_hook": transform_hook,
    "hook_once": hook_once,
    "stream_ingest": stream_ingest,
    "load_new_objects": load_new_objects,
    "stream_registry": stream_registry,
    "stream_retry": stream_retry,
}


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return QUERIES[name](spark, sf_dir)
