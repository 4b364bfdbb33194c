"""The blob registry as a Parquet table plus append-only ledgers.

Files take no UPDATE or DELETE, so the registry's current state is a view:
``registry`` minus tombstoned keys, with ``uploaded_to_s3`` set where the
status ledger holds a successful export. :func:`compact` writes that view to a
new path; :mod:`blobferry.sources.compaction` rewrites only the files that hold deleted rows, and
:func:`read_registry` reads a registry with such rewrites applied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from blobferry.functions import keys as K
from blobferry.operators import sync
from blobferry.operators.batching import rows_per_partition
from blobferry.session import materialize

# The registry's columns, as existing tables hold them.
REGISTRY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("guid", T.StringType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("document", T.BinaryType(), False),
    T.StructField(K.FLAG_COLUMN, T.BooleanType(), True),
])


# One row per file that a compaction took out: the file it put in instead (null: no row was left).
VERSION_SCHEMA = "run_id string, old_file string, new_file string, n_kept long, n_dead long, n_marked long, top_id long"


def path_exists(path: str) -> bool | None:
    """Whether a table folder exists (checked through the object-store
    client); None when that client does not know the path's scheme."""
    from pyarrow import fs as pafs

    from blobferry.sources.objectstore import open_fs

    try:
        fs, base = open_fs(path)
    except Exception:  # noqa: BLE001 - a scheme only Hadoop knows
        return None
    return fs.get_file_info(base).type != pafs.FileType.NotFound


def read_table(spark: SparkSession, path: str,
               schema: T.StructType | str | None = None) -> DataFrame | None:
    """Read a Parquet table, or None if it does not exist yet."""
    if path_exists(path) is False:
        return None
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def versions_path(path: str) -> str:
    return f"{path.rstrip('/')}/_versions"


def live_files(spark: SparkSession, path: str) -> list[str]:
    """The registry's files as of its last compaction: those in the folder, less those taken
    out, and those put in. Names only, which Spark's own listing of a scan holds as well."""
    listed = spark.read.schema(REGISTRY_SCHEMA).parquet(path).inputFiles()
    seen = read_table(spark, versions_path(path), VERSION_SCHEMA)
    if seen is None:
        return listed
    runs = list(seen.select("old_file", "new_file").toLocalIterator())  # one row per rewritten file
    # By base name, which holds a job's or a task's own random part: a path is spelled in several ways.
    out = {r["old_file"].rpartition("/")[2] for r in runs}
    return [f for f in [*listed, *(r["new_file"] for r in runs if r["new_file"])] if f.rpartition("/")[2] not in out]


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry at ``path``, compactions applied."""
    if read_table(spark, versions_path(path), VERSION_SCHEMA) is None:
        return spark.read.parquet(path)
    files = live_files(spark, path)
    return spark.read.schema(REGISTRY_SCHEMA).parquet(*files) if files else spark.createDataFrame([], REGISTRY_SCHEMA)


def last_id(spark: SparkSession, path: str, rows: DataFrame) -> tuple[int, int]:
    """Rows of the registry, and the greatest id it ever held (0: none): an id
    of a row that was compacted away is not given again, or its tombstone would delete the new row."""
    n, top = rows.agg(F.count(F.lit(1)), F.coalesce(F.max("id"), F.lit(0))).first()
    seen = read_table(spark, versions_path(path), VERSION_SCHEMA)
    gone = None if seen is None else seen.agg(F.max("top_id")).first()[0]
    return n, max(top, gone or 0)


def create_if_absent(spark: SparkSession, path: str) -> DataFrame:
    """The registry at ``path``; an empty one with the fixed schema if absent."""
    if read_table(spark, path) is None:
        empty = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                        for f in REGISTRY_SCHEMA.fields])
        empty.write.mode("append").parquet(path)
    return read_registry(spark, path)


def check_rows(keys: DataFrame, existing: DataFrame) -> int:
    """Number of new rows, once they hold what the registry demands: no null guid, filename or body, guids
    and given ids that are unique among them and in the registry. ``keys``: the staged rows without bodies."""
    has_id = "id" in keys.columns
    lacks = F.col("guid").isNull() | F.col("filename").isNull() | F.col("_no_body")
    n, n_bad, n_no_id = keys.agg(F.count(F.lit(1)), F.count_if(lacks),
                                 F.count_if(F.col("id").isNull()) if has_id else F.lit(0)).first()
    if n_bad or n_no_id:
        raise ValueError("registry append: null guid, filename or document" if n_bad else "registry append: null id")
    for name in ("guid", "id") if has_id else ("guid",):
        g = keys.select(name)
        if not g.groupBy(name).count().where(F.col("count") > 1).isEmpty():
            raise ValueError(f"registry append: duplicate {name} in the new rows")
        # The new keys are usually few: counted, they are broadcast, and the
        # registry's column is scanned in place instead of shuffled.
        right = F.broadcast(g) if n <= sync.BROADCAST_MAX_ROWS else g
        if not existing.select(name).join(right, name, "left_semi").isEmpty():
            raise ValueError(f"registry append: {name} already in the registry")
    return n


def append(spark: SparkSession, path: str, rows: DataFrame, check: bool = True) -> int:
    """Append registry rows (guid, filename, document[, id][, uploaded_to_s3]); returns how many.

    ``rows`` are evaluated once: they are staged in the shared folder, and checks, ids and the write read from
    there, the checks without the bodies. Rows without ``id`` get ids in the order in which the tasks
    staged them, without a gap: each task's rows take a block behind the greatest id the registry ever
    held, so that neither an id nor a body goes through a shuffle.
    """
    existing = create_if_absent(spark, path)
    names = [f.name for f in REGISTRY_SCHEMA.fields if f.name in rows.columns]
    types = {f.name: f.dataType for f in REGISTRY_SCHEMA.fields}
    staged = materialize(rows.select(*[F.col(c).cast(types[c]).alias(c) for c in names]).select(
        "*", F.col("document").isNull().alias("_no_body"), F.monotonically_increasing_id().alias("_mid")), "append")
    keys = staged.drop("document")
    n = check_rows(keys, existing) if check else keys.count()
    if "id" not in names:
        # monotonically_increasing_id = (partition number << 33) + row number in it.
        part, at = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND((1 << 33) - 1)
        blocks, start = [], last_id(spark, path, existing)[1] + 1
        # One row per task that staged something: a few bytes each, whatever the rows hold.
        for p, size in sorted(rows_per_partition(keys, part).items()):
            blocks.append((p, start))
            start += size
        block = F.broadcast(spark.createDataFrame(blocks, "_part long, _first long"))
        staged = staged.withColumn("_part", part).join(block, "_part").withColumn("id", F.col("_first") + at)
    if K.FLAG_COLUMN not in names:
        staged = staged.withColumn(K.FLAG_COLUMN, F.lit(False))
    staged.select(*[F.col(f.name) for f in REGISTRY_SCHEMA.fields]).write.mode("append").parquet(path)
    return n


def pending(registry: DataFrame) -> DataFrame:
    """Rows not yet exported: guid, filename, document."""
    return registry.where(K.is_pending(K.FLAG_COLUMN)).select("guid", "filename", "document")


def existing_keys(registry: DataFrame) -> DataFrame:
    """Distinct filenames of the registry, as ``key``."""
    return sync.distinct_keys(registry, "filename")


def current_view(registry: DataFrame, ok_ledger: DataFrame | None = None,
                 tombstones: DataFrame | None = None) -> DataFrame:
    """Registry as of the ledgers: tombstoned rows removed, exports marked.

    A tombstone holds a name and the greatest row id it deletes; rows added
    later under that name stay. Without an id (or a registry without ids) it
    deletes every row of the name.
    """
    view = registry
    if tombstones is not None:
        versioned = "id" in tombstones.columns and "id" in registry.columns
        upto = F.max(F.coalesce(F.col("id"), F.lit((1 << 63) - 1))) if versioned else F.count(F.lit(1))
        dead = tombstones.groupBy(F.col("key").alias("_dead")).agg(upto.alias("_upto"))
        match = F.col("filename") == F.col("_dead")
        if versioned:
            match = match & (F.col("id") <= F.col("_upto"))
        view = view.join(dead, match, "left_anti")
    if ok_ledger is not None:
        view = sync.with_flag_from(view, ok_ledger, key="guid")
    return view


def compact(view: DataFrame, new_path: str) -> str:
    """Write the current view to a new path (never over the one being read)."""
    view.write.mode("errorifexists").parquet(new_path)
    return new_path
