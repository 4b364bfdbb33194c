"""An append evaluates its input once, checks it and gives ids without moving a body."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from blobferry.sources import registry as R

SCHEMA = "guid string, filename string, document binary"


def rows(spark, lo, hi, parts=5):
    return spark.range(lo, hi, 1, parts).select(
        F.concat(F.lit("g"), "id").alias("guid"), F.concat(F.lit("f"), F.col("id") % 7).alias("filename"),
        F.concat(F.lit("body "), "id").cast("binary").alias("document"))


@pytest.mark.parametrize("with_id", [False, True])
def test_the_input_runs_once(spark, tmp_root, with_id):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def look(guids: pd.Series) -> pd.Series:
        seen.add(len(guids))
        return guids

    new = rows(spark, 0, 50).withColumn("guid", look("guid"))
    if with_id:
        new = new.withColumn("id", F.substring("guid", 2, 9).cast("long") + 100)
    assert R.append(spark, f"{tmp_root}/reg", new) == 50
    assert seen.value == 50


def test_ids_are_blocks_behind_the_greatest(spark, tmp_root):
    path = f"{tmp_root}/reg"
    assert R.append(spark, path, rows(spark, 0, 23)) == 23
    assert R.append(spark, path, rows(spark, 23, 24).withColumn("id", F.lit(1000).cast("long"))) == 1
    assert R.append(spark, path, rows(spark, 24, 61, parts=7).repartition(11)) == 37
    assert R.append(spark, path, rows(spark, 0, 0)) == 0
    got = spark.read.parquet(path).orderBy("id").collect()
    assert [r.id for r in got] == [*range(1, 24), 1000, *range(1001, 1038)]
    assert all(bytes(r.document).decode() == f"body {r.guid[1:]}" and r.uploaded_to_s3 is False for r in got)
    assert sorted(int(r.guid[1:]) for r in got) == list(range(61))


def test_what_is_refused_leaves_the_registry_alone(spark, tmp_root):
    path = f"{tmp_root}/reg"
    R.append(spark, path, spark.createDataFrame([(5, "g5", "a", b"")], "id long, " + SCHEMA))
    bad = [([(None, "a", b"1")], SCHEMA, "null guid"), ([("g", None, b"1")], SCHEMA, "null guid"), ([("g", "a", None)], SCHEMA, "null guid"),
           ([("g", "a", b"1"), ("g", "b", b"2")], SCHEMA, "duplicate guid"), ([("g5", "b", b"2")], SCHEMA, "guid already"),
           ([(1, "g", "a", b"1"), (1, "h", "a", b"1")], "id long, " + SCHEMA, "duplicate id"),
           ([(5, "g", "a", b"1")], "id long, " + SCHEMA, "id already"), ([(None, "g", "a", b"1")], "id long, " + SCHEMA, "null id")]
    for data, schema, why in bad:
        with pytest.raises(ValueError, match=why):
            R.append(spark, path, spark.createDataFrame(data, schema))
    assert [r.id for r in spark.read.parquet(path).collect()] == [5]
    more = spark.createDataFrame([(True, "extra", "g6", "a", b"")], "uploaded_to_s3 boolean, other string, " + SCHEMA)
    assert R.append(spark, path, more) == 1  # a flag is kept, other columns are not
    assert [r.uploaded_to_s3 for r in spark.read.parquet(path).where("guid = 'g6'").collect()] == [True]


def test_no_body_is_shuffled_whatever_the_size(spark, tmp_root, monkeypatch):
    from blobferry.operators import sync

    monkeypatch.setattr(sync, "BROADCAST_MAX_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert R.append(spark, f"{tmp_root}/reg", rows(spark, 0, 40)) == 40
        assert R.append(spark, f"{tmp_root}/reg", rows(spark, 40, 60)) == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [r.id for r in spark.read.parquet(f"{tmp_root}/reg").orderBy("id").collect()] == list(range(1, 61))
