import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from blobferry.llm import decontaminate, queries
from blobferry.session import materialize
from llm.test_duplicates import check_lines, reference_fingerprint
from llm.test_tokens_and_packing import check_pieces, whole

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, docs):
    out = {"documents": docs}
    for name, f in corpus_pipeline.STAGES:
        docs = out[name] = materialize(f(spark, docs, SF), "stage")
    return out


def test_stage_names_and_columns(stages, docs):
    assert list(STAGE) == ["language_id", "line_dedup", "simhash", "decontamination", "packing"]
    for name in list(STAGE)[:-1]:
        assert stages[name].dtypes == docs.dtypes


def test_language_stage_keeps_clean_documents(stages):
    assert stages["language_id"].count() >= 0.99 * stages["documents"].count()


def test_line_stage_equals_brute_force(stages):
    rows = stages["line_dedup"].collect()
    check_lines(rows, stages["language_id"].collect())
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_simhash_stage_keeps_one_of_each_group(stages):
    docs = stages["line_dedup"].collect()
    fp = {r["doc_id"]: reference_fingerprint(r["text"], 3) for r in docs}
    ids = sorted(fp)
    up = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if j < i and bin(fp[i] ^ fp[j]).count("1") <= 2:
                a, b = i, j
                while up[a] != a:
                    a = up[a]
                while up[b] != b:
                    b = up[b]
                up[max(a, b)] = min(a, b)
    assert {r["doc_id"] for r in stages["simhash"].collect()} == {i for i in ids if up[i] == i}


def test_decontamination_stage_equals_brute_force(spark, stages):
    grams = set()
    for r in queries.table(spark, SF, "benchmark").collect():
        w = decontaminate.words(r["text"])
        grams |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9) if w else 0)}
    sizes = {len(g) for g in grams}

    def dirty(text):
        w = decontaminate.words(text)
        return any(tuple(w[k:k + n]) in grams for n in sizes for k in range(len(w) - n + 1))

    assert {r["doc_id"] for r in stages["decontamination"].collect()} == \
        {r["doc_id"] for r in stages["simhash"].collect() if not dirty(r["text"])}


def test_packing_stage_covers_all_its_input(stages):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    check_pieces(stages["packing"].collect(),
                 [(r["doc_id"], whole(tok, r["text"], 0)) for r in stages["decontamination"].collect()])


def test_stages_take_odd_rows_and_empty_tables(spark, docs, odd, empty):
    """Also with columns named as the operators' results: they stay, and decide nothing."""
    clash = odd.withColumn("accepted", F.lit(False)).withColumn("posterior", F.lit("p")).withColumn("n_hit", F.lit(9)) \
        .withColumn("component_id", F.lit(1)).withColumn("row_key", F.lit(1))
    mixed = clash.unionByName(docs, allowMissingColumns=True)
    for rows in (mixed, clash, empty):
        shape = rows.dtypes
        for name, f in corpus_pipeline.STAGES:
            n = rows.count()
            rows = materialize(f(spark, rows, SF), "stage")
            if name != "packing":
                assert rows.dtypes == shape, name
            if name == "language_id" and n > 100:
                assert rows.count() >= 0.9 * n


def test_columns_named_as_results_change_no_decision(spark, docs):
    plain = STAGE["language_id"](spark, docs, SF)
    clash = docs.withColumn("accepted", F.lit(False)).withColumn("language", F.lit("zz")).withColumn("posterior", F.lit(0))
    got = STAGE["language_id"](spark, clash, SF)
    assert got.columns == clash.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in plain.collect())


def test_decisions_take_effect_on_null_and_repeated_ids(spark, docs):
    passage = next(r["text"] for r in queries.table(spark, SF, "benchmark").collect() if len(decontaminate.words(r["text"])) >= 10)
    clean, other = ("".join(f"{w}{k} " for k in range(40)) for w in ("alpha", "omega"))
    rows = [(None, passage), (None, clean), (1, clean), (1, passage), (2, other), (2, other), (None, other), (None, "x " + passage),
            (3, None), (None, "zeta eta theta iota kappa"), (None, "zeta eta theta iota kappa")]
    df = spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], docs.schema)
    pairs = lambda out: sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert pairs(STAGE["decontamination"](spark, df, SF)) == sorted((r for r in rows if passage not in (r[1] or "")), key=str)
    kept = pairs(STAGE["simhash"](spark, df, SF))
    assert [x for x in kept if x[1] == clean] == [(1, clean)]
    assert [x for x in kept if x[1] == other] == [(2, other)]
    assert [x for x in kept if x[1] == rows[-1][1]] == [(None, rows[-1][1])]
    assert [x for x in kept if x[1] is None] == [(3, None)]


def test_run_chains_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = lambda df: collections.Counter((r["doc_id"], r["start"], r["length"]) for r in df.collect())
    total = lambda df: sum(r["length"] for r in df.collect())
    assert total(got) == total(stages["packing"]) and key(got)


def test_stages_bound_their_batches_in_any_session(spark):
    """A session that keeps Spark's 10,000 rows a batch gets the bound; a smaller one stays."""
    import corpus_pipeline

    key, old = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for had, want in (("10000", "1024"), ("0", "1024"), ("100", "100")):
            spark.conf.set(key, had)
            seen = []
            corpus_pipeline._in_small_batches(lambda s, d, p: seen.append(s.conf.get(key)))(spark, None, "")
            assert seen == [want]
    finally:
        spark.conf.set(key, old)


def test_deciding_stages_write_no_copy_of_the_documents(spark, docs):
    """marks and decisions go to disk, texts do not."""
    import os

    from blobferry.session import state_root, to_local

    scratch = os.path.join(to_local(state_root(spark)), "scratch")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    for name in ("simhash", "decontamination"):
        assert STAGE[name](spark, docs, SF).count() > 0
    new = [x for x in set(os.listdir(scratch)) - before if not x.startswith("pyfiles")]
    assert len(new) > 5
    assert [x for x in new if "text" in spark.read.parquet(os.path.join(scratch, x)).columns] == []


def test_of_rows_with_one_id_and_text_one_stays(spark, docs):
    """Also where their other columns differ, and beside the same text of another id; the rest of the table is whole."""
    a, b = ("".join(f"{w}{k} " for k in range(40)) for w in ("alpha", "omega"))
    rows = [(1, a, "en", None, 7), (1, a, "en", None, 7), (1, a, "de", "s", 8), (2, a, "en", None, 7), (None, a, "en", None, 7),
            (None, b, "fr", None, 1), (None, b, None, "t", 1), (5, "zeta eta theta", None, None, 2)]
    df = spark.createDataFrame([(r[0], r[1], *r[2:]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r) for r in STAGE["simhash"](spark, df, SF).collect()]
    assert sorted((r[:2] for r in got), key=str) == sorted([(1, a), (None, b), (5, "zeta eta theta")], key=str)
    assert set(got) <= set(rows)
    many = df.where("doc_id = 5").unionAll(df.where("doc_id = 5").withColumn("n_chars", F.lit(3).cast("long")))
    assert [r["doc_id"] for r in STAGE["simhash"](spark, many, SF).collect()] == [5]


def test_decontamination_of_marks_in_several_blocks(spark, docs, monkeypatch):
    """Rows named by binary marks give the decisions of rows named by numbers, with one block of the benchmark and several."""
    bench = queries.table(spark, SF, "benchmark")
    few = docs.limit(200).unionByName(bench.select(F.col("item_id").cast("long").alias("doc_id"), "text"), allowMissingColumns=True)
    few = materialize(few, "few")
    want = sorted(r["n_hit"] for r in decontaminate.contamination(few, bench).collect())
    for block in (decontaminate.BLOCK_BYTES, 2000):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = decontaminate.contamination(few.withColumn("m", corpus_pipeline._mark()), bench, id_col="m")
        assert dict(got.dtypes)["doc_id"] == "binary"
        assert sorted(r["n_hit"] for r in got.collect()) == want and max(want) > 0
