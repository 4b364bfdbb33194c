"""Role mapping: how the shared test tables stand in for the engine's inputs.

* ``documents`` -> blob registry: id = doc_id, filename = ``doc_{id}.txt``,
  document = UTF-8 bytes of ``text``; ``labels`` marks rows already loaded and,
  where quality = 1, already uploaded. ``n_chars`` plays the size of the copy
  already in the target store.
* ``pages`` -> object listing: key = url, size = bytes of html; ``page_id``
  names the live registry keys (``doc_{page_id}.txt``).
* ``events`` / ``orders`` -> source document tables with the columns
  ID, POLICY_ID, COMPANY, BROKER, MODIFIED, BINDER_DOC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobferry.functions import keys as K

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doc_key(doc_id) -> F.Column:
    """Registry object key of a document id."""
    return F.concat(F.lit("doc_"), K._c(doc_id).cast("string"), F.lit(".txt"))


def registry(spark: SparkSession, sf_dir: str, with_body: bool = True,
             extra: tuple[str, ...] = (), facts: bool = False) -> DataFrame:
    """Blob registry rows: id, guid, filename, document, uploaded_to_s3
    (plus ``extra`` document columns, e.g. to drive fault injection).

    With ``facts`` the body is replaced by its ``size`` and ``sha1``, computed
    at the scan: a join that follows then moves 48 bytes per row, not bodies.
    """
    docs = table(spark, sf_dir, "documents")
    if facts:
        docs = docs.select("doc_id", *extra, K.byte_length("text").alias("size"),
                           K.body_sha1("text").alias("sha1"))
        with_body = False
    uploaded = (table(spark, sf_dir, "labels")
                .where(F.col("quality") == 1).select("doc_id").distinct()
                .withColumn("_up", F.lit(True)))
    cols = [F.col("doc_id").alias("id"), K.derived_guid(doc_key("doc_id")).alias("guid"),
            doc_key("doc_id").alias("filename")]
    if with_body:
        cols.append(F.col("text").cast("binary").alias("document"))
    cols.append(F.coalesce(F.col("_up"), F.lit(False)).alias(K.FLAG_COLUMN))
    cols.extend(F.col(c) for c in extra)
    if facts:
        cols.extend([F.col("size"), F.col("sha1")])
    return docs.join(uploaded, "doc_id", "left").select(*cols)


def loaded_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys already in the registry (documents that have a label row)."""
    return table(spark, sf_dir, "labels").select(doc_key("doc_id").alias("key"))


def target_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies already in the target store: labelled documents, size n_chars."""
    docs = table(spark, sf_dir, "documents")
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    return (docs.join(labelled, "doc_id", "left_semi")
            .select(doc_key("doc_id").alias("key"), F.col("n_chars").cast("bigint").alias("size")))


def page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object listing from pages: key = url, size = bytes of html."""
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("key"), K.byte_length("html").alias("size"),
        F.lit(None).cast("timestamp").alias("mtime"))


def live_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys present in the object store: one per page_id."""
    return table(spark, sf_dir, "pages").select(doc_key("page_id").alias("key"))


# The source table's key columns, in their given order.
SOURCE_COLUMNS = ("ID", "POLICY_ID", "COMPANY", "BROKER", "MODIFIED")


def source_from_events(spark: SparkSession, sf_dir: str, with_body: bool = True) -> DataFrame:
    """Source document rows from ``events``."""
    ev = table(spark, sf_dir, "events")
    cols = [F.col("event_id").alias("ID"), F.col("user_id").alias("POLICY_ID"),
            F.col("event_type").alias("COMPANY"), F.col("props").alias("BROKER"),
            F.col("ts").alias("MODIFIED")]
    if with_body:
        cols.append(F.col("props").cast("binary").alias(K.BODY_COLUMN))
    return ev.select(*cols)


def source_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source document rows from ``orders`` (many ties in MODIFIED)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("POLICY_ID"),
                    F.col("o_orderstatus").alias("COMPANY"),
                    F.col("o_orderpriority").alias("BROKER"),
                    F.col("o_orderdate").alias("MODIFIED"))
