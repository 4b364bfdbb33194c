"""Batch numbering over a total order, without a single-partition window.

``row_number()`` over an unpartitioned window pulls every row into one task.
Here the rows are range-partitioned on the order keys, numbered inside each
partition, and shifted by the row count of all earlier partitions. There is one count per
partition (at most ``spark.sql.shuffle.partitions``), so the offsets travel as a
literal array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blobferry.functions import keys as K
from blobferry.session import materialize


def rows_per_partition(df: DataFrame, part: str | Column) -> dict[int, int]:
    """Rows by the partition number in ``part``: one small row per partition that holds any comes to the driver."""
    return dict(df.groupBy(K._c(part).alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).collect())


def global_index(df: DataFrame, order: Sequence[str], name: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ascending ``order`` (which must be a
    total order: add a unique tie-break column if needed).

    Without ``num_partitions`` the range partitioning leaves the count to
    AQE, which only merges neighbouring ranges (so order holds) and sizes
    them by the data: a hundred keys do not become thousands of tasks and files.
    """
    order = list(order)
    cols = [F.col(c) for c in order]
    ranged = (df.repartitionByRange(num_partitions, *cols) if num_partitions
              else df.repartitionByRange(*cols))
    tagged = (ranged.sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    # Written once to the shared folder: both passes below see the same
    # numbering, and a lost executor does not force a re-sort.
    tagged = materialize(tagged, "index")
    # One count per partition: at most spark.sql.shuffle.partitions small rows,
    # so they may come to the driver and go back as a literal array of offsets.
    counts = rows_per_partition(tagged, "_pid")
    offsets, run = [], 0
    for pid in range(max(counts, default=-1) + 1):
        offsets.append(run)
        run += counts.get(pid, 0)
    if not offsets:
        return tagged.withColumn(name, F.lit(None).cast("bigint")).drop("_pid", "_mid")
    table = F.array(*[F.lit(o).cast("bigint") for o in offsets])
    # monotonically_increasing_id = (partition id << 33) + row number in it.
    in_part = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.withColumn(name, (F.element_at(table, F.col("_pid") + 1) + in_part).cast("bigint"))
            .drop("_pid", "_mid"))


def with_batch_numbers(df: DataFrame, order: Sequence[str], batch_size: int,
                       name: str = "batch_no") -> DataFrame:
    """Slice the ordered rows into batches of ``batch_size``, numbered from 1."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    idx = global_index(df, order, name="_idx")
    return idx.withColumn(name, (F.floor(F.col("_idx") / F.lit(batch_size)) + 1).cast("bigint"))


def batch_report(df: DataFrame, order: Sequence[str], batch_size: int,
                 size_col: str | None = None) -> DataFrame:
    """Rows (and bytes) per batch: batch_no, n_files[, n_bytes]."""
    cols = list(order) + ([size_col] if size_col else [])
    b = with_batch_numbers(df.select(*cols), order, batch_size)
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_files")]
    if size_col:
        aggs.append(F.sum(size_col).cast("bigint").alias("n_bytes"))
    return b.groupBy("batch_no").agg(*aggs)
