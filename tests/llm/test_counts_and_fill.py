import hashlib
import random
import re

import pytest

from blobferry.llm import fill_middle as fm, queries, token_counts as tc

PARTS = ["a", "the", " ", "  ", "\n", "Hello", "world,", "don't", " it's", "123", "12", "é", "ü", "漢字", "’s", "—", "\t", "\r\n",
         "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "▁", "x²", "Ⅷ", "́", "😀", "नमस्ते", "!!!", "...", "$", "_", "　",
         "Привет", " however", " government", "ing", "\0", "\x1c", "Ᲊ", "Ꟛ!", "aᲉ.", "԰x"]
VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]


def library(name):
    """Token count by the unmodified library."""
    path = queries.tokenizer_path(name)
    if name.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(sp.encode(t or ""))
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    return lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)


def counter(name):
    path = queries.tokenizer_path(name)
    c = tc.counter_of(path, tc.read_spec(path))
    return c.counter(c.whole_tokens())


@pytest.mark.parametrize("name", VOCABULARIES)
def test_counts_of_random_texts_equal_the_library(name):
    rng = random.Random(3)
    count, want = counter(name), library(name)
    texts = ["".join(rng.choice(PARTS) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(14))) for _ in range(4000)]
    assert [(t, count(t)) for t in texts] == [(t, want(t)) for t in texts]


def test_small_memory_and_segments_change_nothing(monkeypatch, docs):
    monkeypatch.setattr(tc, "MEMO", 50)
    monkeypatch.setattr(tc, "SEGMENT", 100)
    count, want = counter(VOCABULARIES[0]), library(VOCABULARIES[0])
    texts = [r["text"] for r in docs.limit(60).collect()] + ["x" * 1000 + " y  z" * 500, "\n a" * 300]
    assert [count(t) for t in texts] == [want(t) for t in texts]


def test_every_listed_string_is_one_token():
    path = queries.tokenizer_path()
    texts, _ = tc.counter_of(path, tc.read_spec(path)).whole_tokens()
    want = library(VOCABULARIES[0])
    assert len(texts) > 25_000 and all(want(" " + t) == 1 for t in texts)


def test_query_equals_the_library_on_whole_texts(spark, docs):
    want = library(VOCABULARIES[0])
    got = queries.op12_token_counts(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(r["doc_id"], len((r["text"] or "").encode()), want(r["text"])) for r in docs.collect()]
    assert sorted(tuple(r) for r in got.collect()) == sorted((*r, r[2] > 512) for r in expected)


@pytest.mark.parametrize("name", VOCABULARIES)
def test_counts_of_odd_rows(spark, odd, empty, name):
    """Null ids, null and empty texts, repeated rows, a very long text, columns named as results."""
    want = library(name)
    rows = odd.withColumnRenamed("n_lines", "n_tokens").withColumnRenamed("_gone", "Over_Limit")
    got = tc.token_counts(rows, queries.tokenizer_path(name), limit=3)
    assert sorted(map(str, got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())) == sorted(
        f"Row(doc_id={r['doc_id']}, n_bytes={len((r['text'] or '').encode())}, n_tokens={want(r['text'])}, "
        f"over_limit={want(r['text']) > 3})" for r in odd.collect())
    assert got.columns.count("n_tokens") == 1 and "ids" in got.columns and "text" not in got.columns
    assert tc.token_counts(empty, queries.tokenizer_path(name)).collect() == []


# -- fill in the middle --------------------------------------------------------------------------

def expected_form(doc_id, text):
    """By the rules, without an index."""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    text = text or ""
    n = len(text)
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, "<S>" + suf + "<P>" + pre + "<M>" + mid
    return n, "psm", a, b - a, "<P>" + pre + "<S>" + suf + "<M>" + mid


@pytest.mark.parametrize("unit", [None, r"\S+", r".*\n", r"\S+\s*"])
def test_ranks_equal_a_scan(unit):
    rng = random.Random(4)
    pattern = re.compile(unit) if unit else None
    for size in [0, 1, 5, 63, 64, 65, 500, 5000, 70_000]:
        text = "".join(rng.choice("ab \n漢😀") for _ in range(size))
        ends = list(range(len(text) + 1)) if unit is None else [0] + [m.end() for m in pattern.finditer(text) if m.end() > m.start()]
        if ends[-1] < len(text):
            ends.append(len(text))
        index = fm.SkipList(text, pattern)
        assert index.n == len(ends) - 1
        assert all(len(lane) <= len(low) // fm.SKIP + 1 for low, lane in zip(index.lanes, index.lanes[1:]))
        for rank in {0, index.n, *(rng.randrange(index.n + 1) for _ in range(50))}:
            assert index.place(rank) == ends[rank]


def check_fill(docs):
    out = fm.fill_in_middle(docs)
    got = out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fm.restored("output", "form").alias("back"))
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(
        ((r["doc_id"], *expected_form(r["doc_id"], r["text"]), r["text"] or "") for r in docs.collect()), key=key)


def test_forms_equal_the_rules(docs):
    check_fill(docs)


def test_forms_of_odd_rows(spark, odd, empty):
    """Null ids and texts, empty texts, repeated rows, clashing names; marks whole, cut and nested at the joints."""
    check_fill(odd.withColumnRenamed("rid", "output").withColumnRenamed("kept", "form"))
    tricky = ["<P>", "a<S>b", "<M", "<", "<<P", "P>", "S><", "<S", "><P", "a<P b>S>", "\0<\0", "😀" * 200, "<P<S<M" * 9]
    check_fill(spark.createDataFrame([(100 * k + j, t) for k, t in enumerate(tricky) for j in range(40)], "doc_id long, text string"))
    assert fm.fill_in_middle(empty).collect() == []


def test_units_by_pattern_keep_the_text(docs):
    out = fm.fill_in_middle(docs, seed=7, plain=0, spm=50, unit=r"\S+\s*")
    rows = {r["doc_id"]: r for r in out.select("doc_id", "n", "form", "prefix_chars", fm.restored("output", "form").alias("back")).collect()}
    for d in docs.collect():
        r = rows[d["doc_id"]]
        assert r["back"] == (d["text"] or "")
        if r["form"] != "plain":
            assert r["n"] == len(re.findall(r"\S+\s*", d["text"])) + (not re.fullmatch(r"(\s*\S+\s*)*", d["text"]))
            cut = r["prefix_chars"]
            assert cut in (0, len(d["text"])) or not d["text"][cut].isspace()
    assert {r["form"] for r in rows.values()} == {"plain", "psm", "spm"} or {r["form"] for r in rows.values()} == {"psm", "spm"}


def test_id_of_another_type_is_kept(spark):
    rows = fm.fill_in_middle(spark.createDataFrame([("x-1", "some text"), ("x-2", "")], "doc_id string, text string"))
    assert {r["doc_id"] for r in rows.collect()} == {"x-1", "x-2"}
