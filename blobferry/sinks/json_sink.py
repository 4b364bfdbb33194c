"""JSON export of rows (all columns or a projection).

Spark's JSON writer cuts timestamps to milliseconds by default; both formats
are set to microseconds here and on read, so a round trip keeps every value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_json(df: DataFrame, path: str, columns: Sequence[str] | None = None,
               partition_by: Sequence[str] | None = None, mode: str = "append") -> None:
    """Write rows as JSON lines (one file per task; optional partition keys)."""
    out = df.select(*columns) if columns else df
    w = (out.write.mode(mode).option("timestampNTZFormat", TS_NTZ_FORMAT)
         .option("timestampFormat", TS_FORMAT))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read JSON written by :func:`write_json` with a given schema (no inference)."""
    return (spark.read.schema(schema).option("timestampNTZFormat", TS_NTZ_FORMAT)
            .option("timestampFormat", TS_FORMAT).json(path))
