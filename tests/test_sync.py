import pytest
from pyspark.sql import functions as F

from blobferry.operators import sync


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_new_objects_keeps_duplicates_and_null_safe(spark):
    listing = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "key string")
    existing = spark.createDataFrame([("b",), (None,)], "key string")
    got = [r[0] for r in sync.new_objects(listing, existing).collect()]
    assert sorted(got, key=str) == sorted(["a", "a", None], key=str)


def test_orphans_is_a_set(spark):
    existing = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "key string")
    listing = spark.createDataFrame([("b",), ("b",)], "key string")
    assert rows(sync.orphans(existing, listing), "key") == [("a",), ("c",)]


def test_orphans_and_kept_partition_the_registry(spark):
    existing = spark.range(0, 200).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listing = existing.where(F.col("key").endswith("3"))
    orph = {r[0] for r in sync.orphans(existing, listing).collect()}
    kept = {r[0] for r in sync.pick(existing, listing, "key").collect()}
    assert orph.isdisjoint(kept)
    assert orph | kept == {r[0] for r in existing.collect()}


def test_size_plan_and_sha1_option(spark):
    src = spark.createDataFrame([("a", 3, "h1"), ("b", 3, "h2"), ("c", 3, "h3"), ("d", 1, "h4")],
                                "key string, size bigint, sha1 string")
    tgt = spark.createDataFrame([("a", 3, "h1"), ("b", 3, "zz"), ("d", 2, "h4")],
                                "key string, size bigint, sha1 string")
    by_size = dict(rows(sync.size_plan(src, tgt), "key", "action"))
    assert by_size == {"a": "skip", "b": "skip", "c": "upload_new", "d": "upload_changed"}
    by_hash = dict(rows(sync.size_plan(src, tgt, compare_sha1="sha1"), "key", "action"))
    assert by_hash["b"] == "upload_changed" and by_hash["a"] == "skip"


def test_size_plan_overlapping_listing_counts_once(spark):
    src = spark.createDataFrame([("a", 3)], "key string, size bigint")
    tgt = spark.createDataFrame([("a", 3), ("a", 3)], "key string, size bigint")
    assert rows(sync.size_plan(src, tgt), "key", "action") == [("a", "skip")]


def test_latest_per_key_ties_nulls_and_hot_key(spark):
    data = [("p1", 5, 1, "old"), ("p1", 5, 2, "new"), ("p2", None, 9, "null-ts"), ("p2", 1, 3, "real")]
    data += [("hot", i % 7, i, f"v{i}") for i in range(3000)]
    df = spark.createDataFrame(data, "key string, m bigint, id bigint, v string").repartition(8)
    got = {r["key"]: r["v"] for r in sync.latest_per_key(df, "key", ["m", "id"], ["v"]).collect()}
    best_hot = max(((i % 7, i) for i in range(3000)))[1]
    assert got == {"p1": "new", "p2": "real", "hot": f"v{best_hot}"}


def test_latest_per_key_plan_combines_map_side(spark):
    df = spark.createDataFrame([("a", 1, 1)], "key string, m bigint, id bigint")
    from conftest import plan_text

    plan = plan_text(sync.latest_per_key(df, "key", ["m", "id"], []))
    assert "partial_max" in plan
    assert "Window" not in plan


def test_with_flag_from(spark):
    reg = spark.createDataFrame([("g1", False), ("g2", None), ("g3", True)], "guid string, up boolean")
    ok = spark.createDataFrame([("g2",), ("g2",)], "guid string")
    assert rows(sync.with_flag_from(reg, ok, flag="up"), "guid", "up") == [
        ("g1", False), ("g2", True), ("g3", True)]


def test_mass_delete_guard():
    with pytest.raises(RuntimeError):
        sync.mass_delete_guard(10, 10, 0, 0.5, False)
    with pytest.raises(RuntimeError):
        sync.mass_delete_guard(10, 6, 4, 0.5, False)
    sync.mass_delete_guard(10, 6, 4, 0.5, True)
    sync.mass_delete_guard(10, 2, 8, 0.5, False)


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from("abcdefg"), max_size=12), st.lists(st.sampled_from("abcdefg"), max_size=12))
def test_new_and_orphans_match_python_sets(spark, listed, existing):
    L = spark.createDataFrame([(k,) for k in listed], "key string")
    E = spark.createDataFrame([(k,) for k in existing], "key string")
    want = sorted(k for k in listed if k not in set(existing))
    assert sorted(r.key for r in sync.new_objects(L, E).collect()) == want
    assert sorted(r.key for r in sync.new_objects_by_probe(L, E).collect()) == want
    assert sorted(r.key for r in sync.orphans(E, L).collect()) == sorted(set(existing) - set(listed))


def test_probe_falls_back_above_the_bound(spark, monkeypatch):
    monkeypatch.setattr(sync, "BROADCAST_MAX_ROWS", 2)
    L = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    E = spark.createDataFrame([("b",)], "key string")
    df = sync.new_objects_by_probe(L, E)
    assert sorted(r.key for r in df.collect()) == ["a", "c"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]),
                          st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 10**6)),
                min_size=1, max_size=60, unique_by=lambda r: r[2]))
def test_latest_per_key_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "key string, m bigint, id bigint")
    got = {r.key: (r.m, r.id) for r in sync.latest_per_key(df, "key", ["m", "id"], []).collect()}
    want = {}
    for k, m, i in rows:  # nulls sort lowest, as in Spark's struct order
        rank = (m is not None, m if m is not None else 0, i)
        if k not in want or rank > want[k][0]:
            want[k] = (rank, (m, i))
    assert got == {k: v for k, (_, v) in want.items()}
