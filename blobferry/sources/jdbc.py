"""Database tables over JDBC (registry or source documents).

Connection details are arguments only. Filters written with the DataFrame API
(the pending flag, the keyset predicate of a bookmark) and the column
selection reach the database as ``WHERE`` and the select list; a split
column spreads the read over ``num_partitions`` tasks.

Not exercised by the test suite: it needs a database, and this environment
allows none to be started.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, *, user: str | None = None,
               password: str | None = None, driver: str | None = None,
               split_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None, predicates: Sequence[str] | None = None,
               fetch_size: int = 1000, extra: dict | None = None) -> DataFrame:
    """Read ``table``; with ``split_column`` (numeric, date or timestamp) and
    bounds the read is split into ranges, with ``predicates`` into one task
    per predicate (e.g. ``MOD(CRC32(k), 16) = i`` for a text key)."""
    props = {"fetchsize": str(fetch_size)}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver is not None:
        props["driver"] = driver
    props.update(extra or {})
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if split_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("split_column needs lower_bound, upper_bound and num_partitions")
        return spark.read.jdbc(url, table, column=split_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def write_table(df: DataFrame, url: str, table: str, *, user: str | None = None,
                password: str | None = None, driver: str | None = None,
                batch_size: int = 1000, column_types: str | None = None) -> None:
    """Append rows in batches of ``batch_size`` per round trip."""
    w = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    w = w.option("batchsize", str(batch_size))
    for k, v in (("user", user), ("password", password), ("driver", driver),
                 ("createTableColumnTypes", column_types)):
        if v is not None:
            w = w.option(k, v)
    w.save()
