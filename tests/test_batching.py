import random

from blobferry.operators.batching import batch_report, global_index, with_batch_numbers


def test_global_index_matches_sorted_position(spark):
    keys = random.Random(7).sample(range(100000), 2500)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(13)
    got = {r.k: r.idx for r in global_index(df, ["k"], num_partitions=11).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_batches_of_n(spark):
    df = spark.range(0, 250).withColumnRenamed("id", "k")
    rep = sorted(tuple(r) for r in batch_report(df, ["k"], 100).collect())
    assert rep == [(1, 100), (2, 100), (3, 50)]
    b = {r.k: r.batch_no for r in with_batch_numbers(df, ["k"], 100).collect()}
    assert b[0] == 1 and b[99] == 1 and b[100] == 2 and b[249] == 3


def test_empty_input(spark):
    df = spark.range(0, 0).withColumnRenamed("id", "k")
    assert batch_report(df, ["k"], 5).count() == 0


def test_global_index_with_many_shuffle_partitions(spark):
    """AQE may merge the range partitions; neighbours only, so order holds."""
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        keys = random.Random(11).sample(range(10**6), 3000)
        df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(7)
        got = {r.k: r.idx for r in global_index(df, ["k"]).collect()}
        assert got == {k: i for i, k in enumerate(sorted(keys))}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
