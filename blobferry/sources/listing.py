"""Object listings: (key, size, mtime) frames.

* :func:`list_all_objects` lists by pages in rounds of tasks and sees every object
  (hidden, zero-length). The key prefix prunes what is opened, and object names go
  straight into task output, never through the driver. The jobs use it. The data
  source ``blobferry_listing`` walks folders lazily, as part of a plan.
* :func:`read_objects` reads the bodies of a complete listing in its tasks, less the
  names that Spark's file index hides (starting with ``_`` or ``.``).
* :func:`list_objects` gives the objects of a complete listing that Spark's file sources would list: neither
  names starting with ``_`` or ``.`` nor empty objects. Only a root of a scheme that nothing but Hadoop knows
  is listed by Spark's file index, which keeps every file status on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobferry.functions import keys as K
from blobferry.session import materialize
from blobferry.sources.blobs import TASK_BYTES, read_bodies
from blobferry.sources.objectstore import open_fs, qualified_root
from blobferry.sources.paging import FolderStore, in_prefix, list_paged

LISTING_SCHEMA = "key string, size bigint, mtime timestamp"


def key_from_path(path_col: str, root: str) -> F.Column:
    """Object key = file path with the root and its slash removed."""
    q = qualified_root(root) + "/"
    p = F.col(path_col)
    return F.when(p.startswith(q), F.substring(p, len(q) + 1, 1 << 30))


def list_objects(spark: SparkSession, root: str, suffix: str | None = None,
                 prefix: str | None = None, case_sensitive: bool = True) -> DataFrame:
    """The objects below ``root`` (recursively) that Spark's file sources would list, as key, size, mtime.

    ``suffix`` (case-sensitive by default) and a string ``prefix`` of the key filter the listing of the whole
    tree, which the tasks write to the shared folder (:func:`list_all_objects`): the driver holds no file status.
    """
    try:
        open_fs(root)
    except Exception:  # noqa: BLE001 - a scheme only Hadoop knows
        df = _indexed_by_spark(spark, root, suffix, case_sensitive)
    else:
        df = visible(list_all_objects(spark, root, suffix, case_sensitive=case_sensitive))
        df = df.where(~F.col("key").rlike(_HIDDEN_FILE) & (F.col("size") > 0)).select(
            "key", "size", F.date_trunc("millisecond", "mtime").alias("mtime"))
    if prefix:
        df = df.where(K.has_prefix("key", prefix))
    return df


def _indexed_by_spark(spark: SparkSession, root: str, suffix: str | None, case_sensitive: bool) -> DataFrame:
    """:func:`list_objects` by ``binaryFile`` with ``content`` pruned, so no body is opened. The suffix is also
    given to the file index as a glob so non-matching files are dropped while listing."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix and case_sensitive and not any(ch in suffix for ch in "*?[]{}\\"):
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    df = reader.load(root).select(
        key_from_path("path", root).alias("key"), F.col("length").alias("size"),
        F.col("modificationTime").alias("mtime"))
    if suffix:
        df = df.where(K.has_suffix("key", suffix, case_sensitive))
    return df


# Names that Spark's file sources pass over, at any depth of a key.
_HIDDEN = r"(^|/)(?!_metadata|_common_metadata)(\.[^/]*|_[^/=]*|[^/]*\._COPYING_)(/|$)"
# Of those, the names that they open as folders only.
_HIDDEN_FILE = r"(^|/)_(metadata|common_metadata)[^/=]*$"
OBJECTS_PER_READ = 10_000  # objects one task reads, one after the other


def visible(listing: DataFrame) -> DataFrame:
    """Rows of a complete listing that Spark's file sources would list too."""
    return listing.where(~F.col("key").rlike(_HIDDEN))


def required_body() -> F.Column:
    """``content`` of a read body; one that could not be read fails the job, as Spark's file sources do."""
    return F.when(F.col("ok"), F.col("content")).otherwise(
        F.raise_error(F.concat_ws(": ", "key", "error")).cast("binary"))


def read_objects(spark: SparkSession, root: str, suffix: str | None = None,
                 max_length: int | None = None) -> DataFrame:
    """Keys and bodies of every object below ``root``: key, size, mtime, content.

    For loading whole folders. The complete listing is staged and the bodies are read by the tasks
    (:func:`blobferry.sources.blobs.read_bodies`), so the driver holds no file status. Zero-length bodies are
    dropped by the listed length and never opened. A body that cannot be read fails the job. A root of a scheme
    that only Hadoop knows is read through Spark's ``binaryFile``, whose file index is the driver's.
    """
    try:
        open_fs(root)
    except Exception:  # noqa: BLE001 - a scheme only Hadoop knows
        return _read_through_spark(spark, root, suffix, max_length)
    listed = visible(list_all_objects(spark, root, suffix)).select(
        "key", F.col("size").alias("length"), F.date_trunc("millisecond", "mtime").alias("mtime"))
    listed = materialize(listed, "listed")
    keys = listed.where(F.col("length") > 0)
    if max_length is not None:
        keys = keys.where(F.col("length") <= max_length)
    n, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(1, min(n, spark.sparkContext.defaultParallelism), -(-n // OBJECTS_PER_READ), -(-total // TASK_BYTES))
    bodies = read_bodies(keys.repartition(tasks), root)
    return bodies.select("key", "size", "mtime", required_body().alias("content"))


def _read_through_spark(spark: SparkSession, root: str, suffix: str | None, max_length: int | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    df = reader.load(root).where(F.col("length") > 0)
    if max_length is not None:
        df = df.where(F.col("length") <= max_length)
    return df.select(key_from_path("path", root).alias("key"), F.col("length").alias("size"),
                     F.col("modificationTime").alias("mtime"), "content")


# ----------------------------------------------------------- complete listing

try:  # Python data sources arrived in PySpark 4.0
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
except ImportError:  # pragma: no cover
    DataSource = object  # type: ignore[assignment,misc]
    DataSourceReader = object  # type: ignore[assignment,misc]
    InputPartition = object  # type: ignore[assignment,misc]


class _Part(InputPartition):  # type: ignore[misc]
    def __init__(self, folder: str, recursive: bool):
        self.folder = folder
        self.recursive = recursive


class _ListingReader(DataSourceReader):  # type: ignore[misc]
    """Each task walks one folder. Folders outside a pushed key prefix are not
    opened. The driver keeps folder names only."""

    def __init__(self, options):
        self.root = options["path"]
        self.max_depth = int(options.get("maxDepth", "4"))
        self.min_partitions = int(options.get("minPartitions", "1"))
        self.prefix = ""

    def pushFilters(self, filters):
        """Takes one ``key LIKE 'prefix%'``; every filter is still applied by Spark."""
        from pyspark.sql.datasource import StringStartsWith

        for f in filters:
            if isinstance(f, StringStartsWith) and f.attribute == ("key",) and not self.prefix:
                self.prefix = f.value
            yield f

    def partitions(self):
        """Open folders level by level until there are enough of them to keep
        the cluster busy (or ``maxDepth`` is reached). Each folder on the way
        lists its own loose objects; the last level's folders are walked whole."""
        store = FolderStore(self.root)
        if not store.exists():
            raise FileNotFoundError(f"listing root not found: {self.root}")
        parts, frontier, depth = [], [self.prefix.rpartition("/")[0]], 0
        while frontier and depth < self.max_depth and len(parts) + len(frontier) < self.min_partitions:
            nxt = []
            for folder in frontier:
                parts.append(_Part(folder, recursive=False))  # its own loose objects
                nxt += [e[0] for e in store.entries(folder) if e[3] and in_prefix(e[0], self.prefix)]
            frontier, depth = nxt, depth + 1
        parts += [_Part(folder, recursive=True) for folder in frontier]
        return parts

    def read(self, partition):
        import datetime as dt

        store, todo = FolderStore(self.root), [partition.folder]
        zero = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
        while todo:
            for key, size, mtime, is_folder in store.entries(todo.pop()):
                if is_folder:
                    if partition.recursive and in_prefix(key, self.prefix):
                        todo.append(key)
                elif key.startswith(self.prefix):
                    # zone-aware (UTC), so it means the same instant in any worker's time zone
                    yield (key, size, zero + dt.timedelta(microseconds=mtime))


class ObjectListingSource(DataSource):  # type: ignore[misc]
    """``spark.read.format("blobferry_listing").load(root)``: every object."""

    @classmethod
    def name(cls):
        return "blobferry_listing"

    def schema(self):
        return LISTING_SCHEMA

    def reader(self, schema):
        return _ListingReader(self.options)


def register_sources(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ObjectListingSource)


def list_all_objects(spark: SparkSession, root: str, suffix: str | None = None,
                     prefix: str | None = None, case_sensitive: bool = True,
                     min_partitions: int | None = None, pages_per_task: int | None = None,
                     store=None) -> DataFrame:
    """Complete listing (hidden and empty objects included), by pages on the
    executors (:func:`blobferry.sources.paging.list_paged`): the prefix prunes the folders
    that are opened, or goes to the store, and large folders of a store with sorted
    keys are split over the tasks. Listed once, when called; ``min_partitions``
    is the number of tasks of a round (default: three per core)."""
    df = list_paged(spark, root, prefix or "", store, pages_per_task, min_partitions)
    if suffix:
        df = df.where(K.has_suffix("key", suffix, case_sensitive))
    return df
