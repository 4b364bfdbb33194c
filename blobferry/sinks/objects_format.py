"""Blob export through Spark's write API: ``df.write.format("blobferry_objects")``.

    df.write.format("blobferry_objects").mode("append") \\
        .option("path", root).option("keyColumn", "key").option("bodyColumn", "body").save()

The option ``metadataColumns`` (names, comma between) keeps those columns with each object.
Each task writes its rows' bodies to ``root/key`` (same safe, idempotent write
as :func:`blobferry.sinks.export.export_bodies`) and reports counts in its
commit message. Unlike ``export_bodies`` there are no per-row status rows: a
failed object fails the task, and after retries the job - the usual contract
of a Spark sink. Use ``export_bodies`` when failures must be kept per key.
"""

from __future__ import annotations

from dataclasses import dataclass

try:  # Python data sources arrived in PySpark 4.0
    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
except ImportError:  # pragma: no cover
    DataSource = object  # type: ignore[assignment,misc]
    DataSourceWriter = object  # type: ignore[assignment,misc]
    WriterCommitMessage = object  # type: ignore[assignment,misc]

from pyspark.sql import SparkSession


@dataclass
class _Written(WriterCommitMessage):  # type: ignore[misc]
    objects: int
    bytes: int


class _ObjectWriter(DataSourceWriter):  # type: ignore[misc]
    def __init__(self, options):
        self.root = options["path"]
        self.key = options.get("keyColumn", "key")
        self.body = options.get("bodyColumn", "body")
        self.meta = [c.strip() for c in options.get("metadataColumns", "").split(",") if c.strip()]

    def write(self, iterator):
        from blobferry.sinks.export import ObjectWriter
        from blobferry.sources.metadata import open_meta
        from blobferry.sources.objectstore import check_name

        at = open_meta(self.root) if self.meta else None
        writer = ObjectWriter(self.root)
        n = size = 0
        try:
            for row in iterator:
                key, body = row[self.key], row[self.body]
                err = check_name(key) or (None if body is not None else "no body")
                if err:
                    raise ValueError(f"object {key!r}: {err}")
                data = bytes(body)
                if at:
                    at.put(key, data, {c: str(row[c]) for c in self.meta if row[c] is not None})
                else:
                    writer.put(key, data)
                n += 1
                size += len(data)
        finally:
            writer.close()
        return _Written(n, size)

    def commit(self, messages):
        # Every object is in place once its task has finished; nothing to move.
        pass

    def abort(self, messages):
        # Objects already put stay (the writes are idempotent); a retry of the
        # job writes the same keys again.
        pass


class ObjectSinkSource(DataSource):  # type: ignore[misc]
    @classmethod
    def name(cls):
        return "blobferry_objects"

    def writer(self, schema, overwrite):
        return _ObjectWriter(self.options)


def register_sink(spark: SparkSession) -> None:
    spark.dataSource.register(ObjectSinkSource)
