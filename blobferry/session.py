"""Spark session and shared-folder helpers.

Scratch output and job state live below the cluster's shared checkpoint
folder (``spark.checkpoint.dir``), never in a machine-local temp folder. Only
when the session names none (tests, local runs) do we make one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. ANSI mode keeps casts honest, UTC keeps
# timestamps comparable with the SQL oracle, AQE re-plans joins at run time
# (broadcast when the measured side is under the threshold, skew splits).
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Bodies ride in Arrow batches to Python tasks: bound a batch by bytes
    # as well as rows so a task never holds thousands of large bodies.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def get_session(master: str | None = None, app_name: str = "blobferry",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process (``local`` masters, not ``local-cluster``)."""
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Unset: a local run or a test. Make our own folder.
        configured = tempfile.mkdtemp(prefix="blobferry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/")] + [p.strip("/") for p in parts])


def state_root(spark: SparkSession) -> str:
    """Shared folder for ledgers and tables of this engine: below the configured
    folder itself, not the one that Spark makes there anew for each session."""
    own = ensure_checkpoint_dir(spark).rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    return _join(configured or own.rpartition("/")[0], "blobferry")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return _join(state_root(spark), "scratch", f"{purpose}-{uuid.uuid4().hex}")


def to_local(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can use the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def materialize(df, purpose: str = "stage"):
    """Write ``df`` once as a Parquet table below the shared folder and read it
    back: lineage is cut, a lost executor costs no recomputation, and (unlike
    an RDD checkpoint) the plan runs only once."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out.written_to = path
    return out


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What a write in this block shuffles goes when the write ends, not when the driver happens to collect its
    garbage. Spark before 4.1 does not know the setting and keeps the files as ever."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def discard(*tables) -> None:
    """Delete tables as :func:`materialize` returned them, which no frame still to be run reads:
    what was made from them is written itself."""
    from blobferry.sources.objectstore import open_fs

    for table in tables:
        fs, path = open_fs(table.written_to)
        fs.delete_dir(path)


def ship_to_executors(spark: SparkSession) -> str:
    """Zip this package into the shared folder and add it to every executor's
    Python path (what ``--py-files`` does). Executor-side code - body reads
    and writes in ``mapInPandas``, the listing data source - imports it."""
    import io
    import zipfile

    from blobferry.sources.objectstore import open_fs

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    target = scratch_path(spark, "pyfiles") + "/blobferry.zip"
    fs, path = open_fs(target)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(buf.getvalue())
    spark.sparkContext.addPyFile(target)
    return target


_SHIPPED: set = set()


def ship_once(spark: SparkSession) -> None:
    """Ship the package once per Spark application: also to the Python workers of a local
    master, which do not share the driver's ``sys.path``."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        ship_to_executors(spark)
    _SHIPPED.add(app)
