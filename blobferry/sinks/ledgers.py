"""Append-only ledgers: export status, tombstones and bookmarks.

They replace flag updates, deletes and job bookmarks. Each run appends once
(one Spark write, committed atomically per task by the output committer) and
later runs read the latest row per key. Paths live below the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blobferry.operators import sync
from blobferry.sources.registry import read_table


@dataclass(frozen=True)
class Ledgers:
    """Ledger paths of one job context."""

    root: str

    @property
    def status(self) -> str:
        return f"{self.root}/status"

    @property
    def tombstones(self) -> str:
        return f"{self.root}/tombstones"

    @property
    def bookmarks(self) -> str:
        return f"{self.root}/bookmarks"

    @property
    def taken(self) -> str:
        """Rows without a place in the bookmark order that runs have taken."""
        return f"{self.root}/taken"


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


LEDGER_SCHEMA = ("run_id string, run_no bigint, ctx string, key string, src_id bigint, guid string, "
                 "policy_id string, size bigint, sha1 string, ok boolean, skipped boolean, "
                 "error string, elapsed_s double")
TOMBSTONE_SCHEMA = "run_id string, key string, id bigint"


def append_status(status: DataFrame, path: str, run_id: str, run_no: int,
                  ctx: str | None = None) -> DataFrame:
    """Write a run's status rows once and return them read back (no re-run)."""
    rows = status.select(F.lit(run_id).alias("run_id"), F.lit(run_no).cast("bigint").alias("run_no"),
                         F.lit(ctx).cast("string").alias("ctx"), *status.columns)
    append(rows, path)
    return read_status(status.sparkSession, path).where(F.col("run_id") == run_id)


def read_status(spark: SparkSession, path: str) -> DataFrame | None:
    """The status ledger; rows written before contexts were kept read as null."""
    return read_table(spark, path, LEDGER_SCHEMA)


def next_run_no(spark: SparkSession, path: str) -> int:
    """One more than the highest run number in a status ledger (1 if empty)."""
    led = read_status(spark, path)
    if led is None:
        return 1
    return int(led.agg(F.coalesce(F.max("run_no"), F.lit(0))).first()[0]) + 1


def last_status(spark: SparkSession, path: str) -> DataFrame | None:
    """Latest status row per context and key across runs (None if the ledger
    is empty)."""
    led = read_status(spark, path)
    if led is None:
        return None
    return sync.latest_per_key(led, ["ctx", "key"], ["run_no"],
                               payload=["run_id", "src_id", "guid", "policy_id", "size", "sha1", "ok",
                                        "skipped", "error"])


def failed_keys(spark: SparkSession, path: str, ctx: str | None = None) -> DataFrame | None:
    """Keys whose latest export failed, to be retried: those of one context
    (and of rows kept without one), or of all."""
    led = read_status(spark, path)
    if led is None:
        return None
    if ctx is not None:
        led = led.where(F.col("ctx").isNull() | (F.col("ctx") == ctx))
    last = sync.latest_per_key(led, ["key"] if ctx is not None else ["ctx", "key"], ["run_no"],
                               payload=["src_id", "policy_id", "ok"])
    return last.where(~F.col("ok")).select("key", "src_id", "policy_id")


LOAD_CTX = "load"  # context of the status rows that loads write: one for each object that could not be read


def owed_keys(spark: SparkSession, ledgers: Ledgers | None, sync_ledgers: Ledgers | None = None) -> DataFrame | None:
    """Keys that a load may have to look at again although no listing offers them as new: the latest
    load failed, or their rows were deleted. Loaded keys among them are for the load's anti-join to drop."""
    found = []
    led = read_status(spark, ledgers.status) if ledgers is not None else None
    if led is not None:
        last = sync.latest_per_key(led.where(F.col("ctx") == LOAD_CTX), "key", ["run_no"], payload=["ok"])
        found.append(last.where(~F.col("ok")).select("key"))
    dead = read_tombstones(spark, sync_ledgers.tombstones) if sync_ledgers is not None else None
    if dead is not None:
        found.append(dead.select("key"))
    return sync.accumulate(found, as_set=True).where("key is not null") if found else None


def compact_status(spark: SparkSession, path: str, new_path: str) -> str:
    """Write the latest status row per context and key to a new path. Later runs
    point at it, so the retry scan stays proportional to the live keys, not
    to the number of runs."""
    last = last_status(spark, path)
    if last is None:
        raise FileNotFoundError(path)
    cols = ["run_id", "run_no", "ctx", "key", "src_id", "guid", "policy_id", "size", "sha1", "ok",
            "skipped", "error"]
    last.select(*cols, F.lit(0.0).alias("elapsed_s")).write.mode("errorifexists").parquet(new_path)
    return new_path


def ok_guids(spark: SparkSession, path: str) -> DataFrame | None:
    """guids with a successful (or skipped-as-equal) export in any run."""
    led = read_table(spark, path)
    return None if led is None else led.where(F.col("ok") & F.col("guid").isNotNull()).select("guid")


def target_state(spark: SparkSession, path: str) -> DataFrame | None:
    """What the target holds according to our own writes: key, size, sha1 of
    the last successful write per key. Lets an export skip by content hash
    without reading target objects back."""
    led = read_table(spark, path)
    if led is None:
        return None
    wrote = led.where(F.col("ok") & ~F.col("skipped"))
    return sync.latest_per_key(wrote, "key", ["run_no"], payload=["size", "sha1"]).select(
        "key", "size", "sha1")


def append_tombstones(keys: DataFrame, path: str, run_id: str) -> None:
    """Names deleted by a run, each with the greatest row id it deletes (null,
    where ``keys`` has no ``id``: every row of the name)."""
    last = F.col("id").cast("bigint") if "id" in keys.columns else F.lit(None).cast("bigint")
    append(keys.select(F.lit(run_id).alias("run_id"), F.col("key"), last.alias("id")), path)


def read_tombstones(spark: SparkSession, path: str) -> DataFrame | None:
    # The schema is given: tombstones of older runs have no id and read as null.
    return read_table(spark, path, TOMBSTONE_SCHEMA)


# --------------------------------------------------------------------- taken

TAKEN_SCHEMA = "ctx string, run_no bigint, row string"


def append_taken(rows: DataFrame, path: str, ctx: str, run_no: int) -> None:
    """Record the rows (``row``: their identity) that a run of ``ctx`` took without the mark's help."""
    append(rows.select(F.lit(ctx).alias("ctx"), F.lit(run_no).cast("bigint").alias("run_no"), "row"), path)


def taken_rows(spark: SparkSession, path: str, ctx: str) -> DataFrame | None:
    """Identities taken by earlier runs of ``ctx`` (None: this context has no record yet)."""
    led = read_table(spark, path, TAKEN_SCHEMA)
    if led is None:
        return None
    led = led.where(F.col("ctx") == ctx)
    return None if led.isEmpty() else led.select("row").distinct()


# ----------------------------------------------------------------- bookmarks

def last_bookmark(spark: SparkSession, path: str, ctx: str) -> tuple[int, tuple | None]:
    """(last run number, high-water tuple) of a context; (0, None) if none."""
    led = read_table(spark, path)
    if led is None:
        return 0, None
    row = (led.where(F.col("ctx") == ctx)
           .agg(F.max(F.struct("run_no", "high_water")).alias("last")).first())
    last = row["last"] if row else None
    if last is None:
        return 0, None
    hw = last["high_water"]
    return int(last["run_no"]), (None if hw is None else tuple(hw))


def commit_bookmark(spark: SparkSession, path: str, ctx: str, run_no: int, strategy: str,
                    high_water: tuple | None, high_water_field: T.StructField,
                    n_rows: int, n_ok: int, n_failed: int) -> tuple | None:
    """Append the run's bookmark row and return the mark. Call only after the
    sink succeeded. The mark is written with the key columns' own struct type
    (``high_water_field``), built from typed literals on the JVM side."""
    from blobferry.operators.incremental import typed_lit

    # Nullable whatever the source says: a typed literal's cast is.
    st = T.StructType([T.StructField(f.name, f.dataType, True) for f in high_water_field.dataType.fields])
    if high_water is None:
        hw = F.lit(None).cast(st)
    else:
        hw = F.struct(*[typed_lit(v, f.dataType.simpleString()).alias(f.name)
                        for f, v in zip(st.fields, high_water)]).cast(st)
    row = spark.range(1).select(
        F.lit(ctx).alias("ctx"), F.lit(run_no).cast("bigint").alias("run_no"),
        F.lit(strategy).alias("strategy"), hw.alias("high_water"),
        F.lit(n_rows).cast("bigint").alias("n_rows"), F.lit(n_ok).cast("bigint").alias("n_ok"),
        F.lit(n_failed).cast("bigint").alias("n_failed"))
    append(row.coalesce(1), path)
    return high_water
