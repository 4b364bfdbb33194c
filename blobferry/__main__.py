"""Command line: one sub-command per job.

    python -m blobferry count --root R [--suffix .pdf] [--prefix P]
    python -m blobferry load-new --root R --registry REG [--suffix .pdf]
    python -m blobferry export-pending --registry REG --target T [--target-prefix P] [--strip TEXT]
    python -m blobferry export-incremental --source SRC --target T --ctx C --strategy S
    python -m blobferry export-json --source SRC --out O --ctx C --strategy S
    python -m blobferry sync --registry REG --root R [--allow-mass-delete]
    python -m blobferry save --registry REG --ids-table IDS --out O
    python -m blobferry ingest --root R (--sink S | --registry REG) --checkpoint C
    python -m blobferry status --state STATE [--ctx C]
    python -m blobferry compact (--state S --new-state S2 | --registry REG [--new-registry P] [--sync-state S])

A source is a Parquet path, or ``jdbc`` with ``--jdbc-url``, ``--jdbc-table``
and ``--jdbc-option key=value`` (user, password, driver, ...). Ledgers live in
``--state`` (default: below the session's shared checkpoint folder). Each
command prints one JSON line: what the run did.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json
import sys

from pyspark.sql import functions as F

from blobferry.functions import keys as K
from blobferry.operators.incremental import strategy_keys
from blobferry.plans import jobs
from blobferry.session import get_session, ship_to_executors, state_root
from blobferry.sinks import ledgers as L
from blobferry.sources import registry as R
from blobferry.sources.compaction import compact_files
from blobferry.sources.listing import list_all_objects


def _source(spark, a):
    if a.source == "jdbc":
        from blobferry.sources.jdbc import read_table

        opts = dict(kv.split("=", 1) for kv in a.jdbc_option)
        return read_table(spark, a.jdbc_url, a.jdbc_table, user=opts.pop("user", None),
                          password=opts.pop("password", None), driver=opts.pop("driver", None),
                          split_column=a.split_column, lower_bound=a.lower_bound,
                          upper_bound=a.upper_bound, num_partitions=a.num_partitions, extra=opts)
    return spark.read.parquet(a.source)


def _ledgers(spark, a, name: str) -> L.Ledgers:
    return L.Ledgers(a.state or f"{state_root(spark)}/jobs/{name}")


def _tombstones(spark, a):
    """Deletes recorded by ``sync``: in ``--sync-state``, else the job's own
    ``--state``, else where ``sync`` keeps them by default."""
    state = a.sync_state or a.state or f"{state_root(spark)}/jobs/sync"
    return L.read_tombstones(spark, L.Ledgers(state).tombstones)


def _json(obj) -> str:
    def default(o):
        if isinstance(o, (dt.datetime, dt.date)):
            return o.isoformat()
        return str(o)

    if dataclasses.is_dataclass(obj):
        obj = dataclasses.asdict(obj)
    return json.dumps(obj, default=default)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="blobferry")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    def src_args(sp):
        sp.add_argument("--source", required=True, help="Parquet path, or 'jdbc'")
        sp.add_argument("--jdbc-url")
        sp.add_argument("--jdbc-table")
        sp.add_argument("--jdbc-option", action="append", default=[])
        sp.add_argument("--split-column")
        sp.add_argument("--lower-bound")
        sp.add_argument("--upper-bound")
        sp.add_argument("--num-partitions", type=int)
        sp.add_argument("--ctx", required=True)
        sp.add_argument("--strategy", default="modified_id")
        sp.add_argument("--state")

    c = sub.add_parser("count", help="count matching objects")
    c.add_argument("--root", required=True)
    c.add_argument("--suffix", default=K.OBJECT_SUFFIX)
    c.add_argument("--prefix")

    ln = sub.add_parser("load-new", help="objects -> registry, new keys only")
    ln.add_argument("--root", required=True)
    ln.add_argument("--registry", required=True)
    ln.add_argument("--suffix", default=K.OBJECT_SUFFIX)
    ln.add_argument("--prefix")
    ln.add_argument("--state")
    ln.add_argument("--sync-state", help="state of the sync job whose tombstones apply")

    ep = sub.add_parser("export-pending", help="registry rows not yet exported -> objects")
    ep.add_argument("--registry", required=True)
    ep.add_argument("--target", required=True)
    ep.add_argument("--target-prefix", default="")
    ep.add_argument("--strip")
    ep.add_argument("--state")
    ep.add_argument("--sync-state", help="state of the sync job whose tombstones apply")

    ei = sub.add_parser("export-incremental", help="source rows past the bookmark -> objects")
    src_args(ei)
    ei.add_argument("--target", required=True)
    ei.add_argument("--name-prefix", default=K.OBJECT_NAME_PREFIX)
    ei.add_argument("--name-suffix", default=K.OBJECT_NAME_SUFFIX)
    ei.add_argument("--target-prefix", default="")
    ei.add_argument("--body", default=K.BODY_COLUMN)
    ei.add_argument("--compare-sha1", action="store_true",
                    help="skip by content: what earlier runs wrote, as far as the target still lists it")
    ei.add_argument("--verify", action="store_true", help="hash the objects that --compare-sha1 would skip")
    ei.add_argument("--metadata", nargs="*", default=[], metavar="COLUMN",
                    help="columns kept with each object, under their lower-case names")

    ej = sub.add_parser("export-json", help="source rows past the bookmark -> JSON")
    src_args(ej)
    ej.add_argument("--out", required=True)
    ej.add_argument("--key-text", action="store_true", help="add CALCULATED_HASH")

    sy = sub.add_parser("sync", help="tombstone registry rows whose object is gone")
    sy.add_argument("--registry", required=True)
    sy.add_argument("--root", required=True)
    sy.add_argument("--suffix", default=K.OBJECT_SUFFIX)
    sy.add_argument("--prefix")
    sy.add_argument("--allow-mass-delete", action="store_true")
    sy.add_argument("--max-share", type=float, default=0.5)
    sy.add_argument("--state")

    sv = sub.add_parser("save", help="documents of many ids -> a folder")
    sv.add_argument("--registry", required=True)
    sv.add_argument("--ids-table", required=True, help="Parquet table with an 'id' column")
    sv.add_argument("--out", required=True)
    sv.add_argument("--state")

    ig = sub.add_parser("ingest", help="stream new objects into a table or the registry (availableNow)")
    ig.add_argument("--root", required=True)
    dest = ig.add_mutually_exclusive_group(required=True)
    dest.add_argument("--sink", help="Parquet table of ingested objects")
    dest.add_argument("--registry", help="load new keys straight into this registry")
    ig.add_argument("--checkpoint", required=True)
    ig.add_argument("--suffix", default=K.OBJECT_SUFFIX)
    ig.add_argument("--max-files-per-trigger", type=int)
    ig.add_argument("--state", help="job state: objects that could not be read are tried again (with --registry)")
    ig.add_argument("--sync-state", help="state of the sync job whose tombstones apply (with --registry)")

    stt = sub.add_parser("status", help="per-run totals of a job's ledgers")
    stt.add_argument("--state", required=True)
    stt.add_argument("--ctx", help="bookmark context to report the mark of")
    stt.add_argument("--last", type=int, default=20, help="number of latest runs to show")

    cp = sub.add_parser("compact", help="rewrite a ledger or the registry view to a new path")
    what = cp.add_mutually_exclusive_group(required=True)
    what.add_argument("--state", help="job state to compact (status to latest per key)")
    what.add_argument("--registry", help="registry whose current view is written out")
    cp.add_argument("--new-state", help="new state folder for the next runs (with --state)")
    cp.add_argument("--new-registry", help="write the whole view there; else only files that hold deleted or newly marked rows are rewritten, in place")
    cp.add_argument("--sync-state", help="state of the sync job whose tombstones apply")
    cp.add_argument("--export-state", help="state of the export job whose successes mark rows")

    a = p.parse_args(argv)
    spark = get_session(a.master)
    if not spark.sparkContext.master.startswith("local"):
        ship_to_executors(spark)

    if a.cmd == "count":
        n = list_all_objects(spark, a.root, a.suffix, a.prefix).count()
        out = {"root": a.root, "n": n}
    elif a.cmd == "load-new":
        out = jobs.load_new(spark, a.root, a.registry, a.suffix, a.prefix,
                            ledgers=_ledgers(spark, a, "load"), tombstones=_tombstones(spark, a))
    elif a.cmd == "export-pending":
        led = _ledgers(spark, a, "export-pending")
        out = jobs.export_pending(spark, a.registry, a.target, led,
                                  target_prefix=a.target_prefix, strip=a.strip,
                                  ok_ledger=L.ok_guids(spark, led.status),
                                  tombstones=_tombstones(spark, a))
    elif a.cmd == "export-incremental":
        led = _ledgers(spark, a, a.ctx)
        prefix = a.target_prefix

        def key_of(b):
            name = K.template_key("POLICY_ID", a.name_prefix, a.name_suffix)
            return K.join_key(prefix, name) if prefix else name

        listing = list_all_objects(spark, a.target) if R.path_exists(a.target) is not False else None
        sink = jobs.blob_sink(a.target, target_listing=listing, key_of=key_of, body=a.body,
                              compare_sha1=a.compare_sha1, written=L.target_state(spark, led.status), verify=a.verify,
                              metadata={c.lower(): c for c in a.metadata})
        out = jobs.run_incremental(spark, _source(spark, a), a.ctx, a.strategy, led, sink)
    elif a.cmd == "export-json":
        led = _ledgers(spark, a, a.ctx)
        hook = (lambda df: K.with_key_text(df, strategy_keys(a.strategy))) if a.key_text else None
        out = jobs.run_incremental(spark, _source(spark, a), a.ctx, a.strategy, led,
                                   jobs.json_sink(a.out), transform=hook)
    elif a.cmd == "sync":
        led = _ledgers(spark, a, "sync")
        view = R.current_view(R.read_registry(spark, a.registry),
                              tombstones=L.read_tombstones(spark, led.tombstones))
        listing = list_all_objects(spark, a.root, a.suffix, a.prefix)
        out = jobs.sync_registry(spark, view, listing, led, a.allow_mass_delete, a.max_share,
                                 suffix=a.suffix, prefix=a.prefix)
    elif a.cmd == "status":
        led = L.Ledgers(a.state)
        status = R.read_table(spark, led.status)
        runs, n_runs = [], 0
        if status is not None:
            written = F.col("ok") & ~F.col("skipped")
            per_run = status.groupBy("run_no").agg(
                F.count(F.lit(1)).alias("n_rows"), F.count_if(written).alias("n_ok"),
                F.count_if(F.col("skipped")).alias("n_skipped"), F.count_if(~F.col("ok")).alias("n_failed"))
            n_runs = per_run.count()
            # The latest runs only: a bounded number of small rows.
            runs = [r.asDict() for r in per_run.orderBy(F.col("run_no").desc()).limit(a.last).collect()]
        out = {"n_runs": n_runs, "runs": runs}
        if a.ctx:
            out["last_run_no"], out["high_water"] = L.last_bookmark(spark, led.bookmarks, a.ctx)
    elif a.cmd == "compact":
        if a.state:
            if not a.new_state:
                p.error("--state needs --new-state")
            old, new = L.Ledgers(a.state), L.Ledgers(a.new_state)
            L.compact_status(spark, old.status, new.status)
            for path_old, path_new in ((old.bookmarks, new.bookmarks), (old.tombstones, new.tombstones),
                                       (old.taken, new.taken)):
                kept = R.read_table(spark, path_old)
                if kept is not None:
                    kept.write.mode("errorifexists").parquet(path_new)
            out = {"state": a.new_state}
        else:
            tomb = L.read_tombstones(spark, L.Ledgers(a.sync_state).tombstones) if a.sync_state else None
            oks = L.ok_guids(spark, L.Ledgers(a.export_state).status) if a.export_state else None
            if a.new_registry:
                view = R.current_view(R.read_registry(spark, a.registry), ok_ledger=oks, tombstones=tomb)
                out = {"registry": R.compact(view, a.new_registry)}
            else:
                out = {"registry": a.registry, **compact_files(spark, a.registry, tomb, oks)}
    elif a.cmd == "save":
        out = jobs.save_documents(spark, a.registry,
                                  spark.read.parquet(a.ids_table).select("id"), a.out,
                                  _ledgers(spark, a, "save"))
    else:
        from blobferry.streaming.ingest import ingest_new_objects, stream_into_registry

        if a.registry:
            out = stream_into_registry(spark, a.root, a.registry, a.checkpoint, a.suffix,
                                       a.max_files_per_trigger, ledgers=_ledgers(spark, a, "load"),
                                       sync_ledgers=L.Ledgers(a.sync_state) if a.sync_state else None)
        else:
            out = ingest_new_objects(spark, a.root, a.sink, a.checkpoint, a.suffix,
                                     a.max_files_per_trigger)
    print(_json(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
