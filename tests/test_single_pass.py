"""A run's rows, and the caller's hook, are evaluated once."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from blobferry.plans import jobs
from blobferry.sinks import ledgers as L
from blobferry.sinks.json_sink import read_json


def source(spark, n=60):
    rows = spark.range(n).select(
        F.col("id").alias("ID"), F.when(F.col("id") % 9 != 0, F.concat(F.lit("p"), F.col("id"))).alias("POLICY_ID"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00.000001' + make_interval(0, 0, 0, 0, 0, int(id))").alias("MODIFIED"),
        F.encode(F.concat(F.lit("body "), F.col("id")), "utf-8").alias(jobs.K.BODY_COLUMN))
    return rows


def counting(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("bigint")
    def look(ids: pd.Series) -> pd.Series:
        seen.add(len(ids))
        return ids

    return seen, lambda df: df.withColumn("ID", look("ID"))


@pytest.mark.parametrize("columns", [None, ["ID", "POLICY_ID"], ["modified"], ["id", "MODIFIED"]])
def test_json_rows_are_evaluated_once(spark, tmp_root, columns):
    seen, hook = counting(spark)
    src = source(spark).drop(jobs.K.BODY_COLUMN)
    led = L.Ledgers(f"{tmp_root}/state")
    rep = jobs.run_incremental(spark, src, "j", "id", led, jobs.json_sink(f"{tmp_root}/out", columns=columns), transform=hook)
    assert seen.value == 60 and rep.counts["n_rows"] == rep.counts["n_ok"] == 60
    status = spark.read.parquet(led.status).select("src_id", "policy_id").collect()
    assert len(status) == 60 and {tuple(r) for r in status} == {(r["ID"], r["POLICY_ID"]) for r in src.collect()}
    assert read_json(spark, f"{tmp_root}/out", src.schema).count() == 60
    again = jobs.run_incremental(spark, src, "j", "id", led, jobs.json_sink(f"{tmp_root}/out", columns=columns), transform=hook)
    assert again.counts["n_rows"] == 0 and seen.value == 60


def test_objects_see_the_hook_once(spark, tmp_root):
    seen, hook = counting(spark)
    src = source(spark).where("POLICY_ID is not null")
    rep = jobs.run_incremental(spark, src, "o", "modified_id", L.Ledgers(f"{tmp_root}/state"),
                               jobs.blob_sink(f"{tmp_root}/out"), transform=hook)
    assert rep.counts["n_ok"] == src.count() == seen.value


def test_a_hook_that_drops_all_rows(spark, tmp_root):
    led = L.Ledgers(f"{tmp_root}/state")
    rep = jobs.run_incremental(spark, source(spark).drop(jobs.K.BODY_COLUMN), "n", "id", led, jobs.json_sink(f"{tmp_root}/out"),
                               transform=lambda df: df.where("ID < 0"))
    assert rep.counts["n_rows"] == 0 and rep.committed
