import pytest

from blobferry.functions import keys as K


def one(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_strip_text_every_and_leading(spark):
    df = spark.createDataFrame([("pre/a/pre/b",), ("x",), (None,)], "n string")
    assert one(df, K.strip_text("n", "pre/")) == ["a/b", "x", None]
    assert one(df, K.strip_text("n", "pre/", leading_only=True)) == ["a/pre/b", "x", None]


def test_template_and_join(spark):
    df = spark.createDataFrame([(7,), (None,)], "p bigint")
    assert one(df, K.template_key("p")) == ["binder_7.pdf", None]
    assert one(df, K.join_key("out", K.template_key("p"))) == ["out/binder_7.pdf", None]


def test_split_uri(spark):
    df = spark.createDataFrame([("s3://bucket/a/b/c",), ("s3://bucket",), ("s3://bucket/",)], "u string")
    b, p = K.split_uri("u")
    assert [tuple(r) for r in df.select(b, p).collect()] == [("bucket", "a/b/c"), ("bucket", ""), ("bucket", "")]


def test_record_hash_collides_safe_hash_does_not(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), (None, "3"), ("", "3")], "a string, b string")
    plain = one(df, K.record_hash(["a", "b"]))
    assert plain[0] == plain[1]
    assert plain[2] == plain[3]  # null and '' also collide
    safe = one(df, K.safe_record_hash(["a", "b"]))
    assert len(set(safe)) == 4


def test_key_text_skips_nulls(spark):
    df = spark.createDataFrame([(1, None, "c")], "a bigint, b string, c string")
    assert one(df, K.key_text(["a", "b", "c"])) == ["1|c"]


@pytest.mark.parametrize("name,ok", [
    ("a/b.pdf", True), ("../x", False), ("/abs/x", False), ("a/../b", False), ("..", False),
    ("a/..b", True), ("", False), ("_x", True), (".x", True), ("C:\\x", False)])
def test_safe_names(spark, name, ok):
    df = spark.createDataFrame([(name,)], "n string")
    assert one(df, K.is_safe_name("n")) == [ok]


def test_suffix_case(spark):
    df = spark.createDataFrame([("a.PDF",), ("a.pdf",)], "k string")
    assert one(df, K.has_suffix("k", ".pdf")) == [False, True]
    assert one(df, K.has_suffix("k", ".pdf", case_sensitive=False)) == [True, True]


def test_pending_and_empty_body(spark):
    df = spark.createDataFrame([(None, b""), (False, b"x"), (True, None)], "u boolean, d binary")
    assert one(df, K.is_pending("u")) == [True, True, False]
    assert one(df, K.non_empty_body("d")) == [False, True, False]


def test_apply_mapping(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", "drop")], "ID bigint, m string, z string")
    out = K.apply_mapping(df, [("id", "bigint", "ID", "string"), ("m", "string", "MODIFIED", "string")])
    assert out.columns == ["ID", "MODIFIED"]
    assert out.collect()[0]["ID"] == "1"
    with pytest.raises(ValueError):
        K.apply_mapping(df, [("nope", "bigint", "x", "bigint")])


def test_derived_guid_is_repeatable(spark):
    df = spark.createDataFrame([("a.pdf",), ("a.pdf",), ("b.pdf",)], "k string")
    g = one(df, K.derived_guid("k"))
    assert g[0] == g[1] != g[2]
    assert [len(p) for p in g[0].split("-")] == [8, 4, 4, 4, 12]


def test_random_guid_differs_per_row(spark):
    g = [r[0] for r in spark.range(50).select(K.random_guid()).collect()]
    assert len(set(g)) == 50 and all(len(x) == 36 for x in g)


@pytest.mark.parametrize("name,ok", [("a:b.pdf", True), ("x/a:b.pdf", True), ("C:/x", False), ("C:\\x", False), ("/x", False),
                                     ("é:/x", True), ("a/../b", False)])
def test_one_name_rule_for_sql_and_python(spark, name, ok):
    from blobferry.sources.objectstore import check_name

    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(K.is_safe_name("n")).first()[0] == ok == (check_name(name) is None)
