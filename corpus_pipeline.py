"""The corpus pipeline: five operators, each stage written and read again.

language ID -> line dedup -> SimHash near-dedup -> benchmark decontamination
-> packing. Every stage takes all its predecessor kept; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from blobferry.llm import decontaminate, language, line_dedup, packing, queries, simhash
from blobferry.llm.common import broadcast_if_small, broadcast_within, fresh_name, materialize


MAX_DROPPED = 64 << 20  # bytes of dropped rows' marks joined by broadcast, else shuffled


def _mark():
    """128 bits of SHA-256 that stand for a row's id and text, nulls told apart: stages that drop rows name
    them by it, so that no copy of the documents has to be written with a key."""
    row = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                   F.when(F.col("text").isNull(), "-").otherwise("="), F.coalesce("text", F.lit("")))
    return F.unhex(F.substring(F.sha2(row, 256), 1, 32))


def _marked(docs: DataFrame, gone: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose mark is in ``gone``, a written table of marks (``left_semi``), or is not (``left_anti``)."""
    mark = fresh_name(docs.columns, "row_mark")
    return docs.withColumn(mark, _mark()).join(broadcast_within(gone.toDF(mark), MAX_DROPPED), mark, how).select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. A null or empty text goes by its source and declared language;
    repeated rows share one decision; columns named as the operator's results are kept and not looked at."""
    rows = language.identify(docs, language.train(docs), declared_col="lang", host_col="source")
    return rows.where(F.col(rows.columns[-1])).select(docs.columns)


def line_dedup_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines an earlier one has; ``n_chars`` follows the text (null where it is null).
    Null ids, repeated rows and extra columns stay as they are; of equal lines one stays in the whole corpus."""
    rows = line_dedup.dedup_lines(docs)
    return rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: one with the smallest id (a null id only where all are null).
    Of rows with this id and the same text the least in its other columns stays."""
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "text", F.col("doc_id").alias("id"), _mark().alias("mark"))
    rows = materialize(simhash.near_duplicates(keyed, shingle=3, max_bits=2, id_col="key", keep=("id", "mark")), "groups")
    many = materialize(rows.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id"),
                       "large-groups")
    shared = materialize(rows.join(broadcast_if_small(many, line_dedup.MAX_BROADCAST), "component_id", "left_semi")
                         .groupBy("component_id", "mark").agg(F.count(F.lit(1)).alias("n"), F.min(
                             F.struct(F.col("id").isNull(), "id", F.col("doc_id").alias("key"))).alias("place")), "shared-groups")
    first = shared.groupBy("component_id").agg(F.min("place")["key"].alias("first"))
    shared = materialize(shared.join(first, "component_id").select("mark", "n", (F.col("place.key") == F.col("first")).alias("stays")),
                         "shared-marks")
    gone = materialize(shared.where("not stays or n > 1").select("mark"), "dropped-rows")
    twins = materialize(shared.where("stays and n > 1").select("mark"), "twins")
    out = _marked(docs, gone, "left_anti")
    if twins.isEmpty():
        return out
    others = F.to_json(F.struct(*[c for c in docs.columns if c != "text"]))
    return out.unionAll(_marked(docs, twins, "left_semi").groupBy(_mark()).agg(F.min_by(F.struct(*docs.columns), others).alias("row"))
                        .select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. A null or empty text has none; null and repeated ids are judged
    row by row; extra columns stay."""
    rows = decontaminate.contamination(docs.select("text", _mark().alias("mark")), queries.table(spark, sf_dir, "benchmark"),
                                       window=10, id_col="mark")
    return _marked(docs, materialize(rows.where("n_hit > 0").select("doc_id").distinct(), "dropped-rows"), "left_anti")


def packing_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full windows, ids included. A null or empty text is its end id alone; equal ids and repeated
    rows are packed each by itself; a text longer than a window has several pieces; extra columns are dropped."""
    return packing.pack(docs, queries.tokenizer_path(), window=1024, end_id=0)


BATCH_ROWS = 1024  # texts that go to a Python task at once, as in our own sessions (session.DEFAULT_CONF)
_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _in_small_batches(stage):
    """``stage`` in a session whose Arrow batches have at most ``BATCH_ROWS`` rows. Spark's own 10,000 whole texts
    lie beside each other in the executor, in its buffers and in the Python worker."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(_ROWS_KEY)) <= BATCH_ROWS:
            spark.conf.set(_ROWS_KEY, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


STAGES = [(name, _in_small_batches(stage)) for name, stage in (
    ("language_id", language_id), ("line_dedup", line_dedup_), ("simhash", simhash_dedup),
    ("decontamination", decontamination), ("packing", packing_))]

#: Stages train models, hash and tokenize, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
