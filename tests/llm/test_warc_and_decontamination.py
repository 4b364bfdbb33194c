import collections
import gzip
import hashlib

import pytest

from blobferry.llm import decontaminate as D
from blobferry.llm import warc
from blobferry.sources.objectstore import open_fs

SF = "/root/testdata/sf0.001"


def check_pages(rows, pages):
    want = collections.Counter()
    least = {}
    for r in pages:
        raw = (r["html"] or "").encode()
        if len(raw) >= 100 and r["page_id"] is not None:
            least[raw] = min(r["page_id"], least.get(raw, r["page_id"]))
    for r in pages:
        raw = (r["html"] or "").encode()
        ref = least.get(raw)
        revisit = ref is not None and r["page_id"] is not None and r["page_id"] > ref
        want[(r["page_id"], len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
              ref if revisit else None)] += 1
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                               for r in rows) == want


def test_archives_round_trip(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    check_pages(warc.archive_pages(pages).collect(), pages.collect())


def test_archives_odd_rows(spark):
    body = "x" * 200
    rows = [(1, "http://a/1", body), (3, "http://a/3", body), (2, None, body), (None, "http://a/n", body), (4, "u\r\nv ü%41", ""),
            (5, "http://a", None), (6, "http://b", "short"), (7, "http://b", "short"), (1, "http://a/1", body),
            (8, "http://c", "é\r\n\r\n" * 400_000), (-9, "", "WARC/1.1\r\n\r\n" * 20)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, first int")
    check_pages(warc.archive_pages(pages).collect(), pages.collect())
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_selected_records_by_byte_range(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    index = warc.write_archives(pages, warc.scratch_path(spark, "warc"))
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    some = index.where("page_id in (3, 17, 44)")
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(some).collect()} == \
        {i: html[i] for i in (3, 17, 44)}
    r = index.first()
    folder, _, name = r["archive"].rpartition("/")
    fs, base = open_fs(folder)
    raw = gzip.decompress(fs.open_input_file(f"{base}/{name}").read_at(r["length"], r["offset"]))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response") and raw.endswith(b"\r\n\r\n")


def brute(docs, items, n):
    grams = {}
    for i, text in items:
        w = D.words(text) if i is not None else []
        for k in range(max(1, len(w) - n + 1) if w else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for doc_id, text in docs:
        w = D.words(text)
        hit, found = [False] * len(w), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                got = grams.get(tuple(w[k:k + size]))
                if got:
                    hit[k:k + size] = [True] * size
                    found |= got
        out.append((doc_id, len(w), sum(hit), tuple(sorted(found))))
    return collections.Counter(out)


def rows_of(df):
    rows = df.collect()
    for r in rows:
        assert sum(b - a for a, b in r["spans"]) == r["n_hit"]
    return collections.Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows)


@pytest.mark.parametrize("n", [3, 10])
def test_contamination_equals_brute_force(spark, docs, n, monkeypatch):
    monkeypatch.setattr(D, "SEGMENT_WORDS", 5000)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()],
                 [(r["item_id"], r["text"]) for r in bench.collect()], n)
    assert rows_of(D.contamination(docs, bench, n)) == want
    assert any(k[2] for k in want)


def test_contamination_odd_rows(spark, odd, empty):
    items = [(1, "alpha beta gamma delta alpha beta gamma delta alpha beta gamma"), (1, "ONE line"), (2, None), (None, "alpha"),
             (3, ""), (4, "x"), (5, "É ü"), (6, "é ü"), (7, "..."), (8, "no-id;HERE"), (8, "no-id;HERE"),
             (9, "gamma alpha beta gamma delta alpha beta gamma delta alpha beta gamma")]
    bench = spark.createDataFrame([(*x, "q") for x in items], "item_id long, text string, word string")
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect()], items, 10)
    assert rows_of(D.contamination(odd, bench)) == want
    assert D.contamination(empty, bench).count() == 0
    assert {k[2] for k in rows_of(D.contamination(odd, bench.limit(0)))} == {0}


def test_contamination_in_blocks_of_the_benchmark(spark, docs, odd, monkeypatch):
    """A benchmark above the block size has the result of one block, rows with null and repeated ids included."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").unionAll(spark.createDataFrame(
        [(1, "alpha beta gamma"), (9, "beta gamma delta alpha"), (8, "two blanks"), (7, "no id here")], "item_id long, text string"))
    rows = docs.select("doc_id", "text").unionAll(odd.select("doc_id", "text"))
    one = {(r["doc_id"], r["n_words"]): r for r in D.contamination(rows, bench, 3, slop=4).collect()}
    size = sum(len((r["text"] or "").encode()) for r in bench.collect())
    monkeypatch.setattr(D, "BLOCK_BYTES", size // 3, raising=False)
    monkeypatch.setattr(D, "MAX_WORDS", size // 24, raising=False)
    got = D.contamination(rows, bench, 3, slop=4).collect()
    assert len(got) == rows.count()
    assert all(r == one[r["doc_id"], r["n_words"]] for r in got) and any(len(r["items"]) > 1 for r in got)
    want = brute([(r["doc_id"], r["text"]) for r in rows.collect()], [(r["item_id"], r["text"]) for r in bench.collect()], 3)
    assert rows_of(D.contamination(rows, bench, 3)) == want


def test_words_split_bytes_as_defined():
    assert D.words("A-b_c é ü 9x\x7fZ") == ["a".encode(), b"b", b"c", "é ü".encode(), b"9x", b"z"]
    assert D.words(None) == D.words("") == D.words(" .,") == []


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "red green blue sky over the red sea"), (2, "sky blue and green then red"),
                                  (3, "red one two three four five six seven green blue sky"), (4, "red green blue")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(7, "red green blue sky")], "item_id long, text string")
    got = {r["doc_id"]: (r["items"], r["near_items"]) for r in D.contamination(docs, bench, 4, slop=5).collect()}
    assert got == {1: ([7], [7]), 2: ([], [7]), 3: ([], []), 4: ([], [])}
