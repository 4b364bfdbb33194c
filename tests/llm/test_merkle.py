import hashlib
import random
import zlib

import numpy as np
import pytest

from blobferry.llm import merkle, queries

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, text):
    values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        run = i // 16 * 16
        yield "".join(level[run:i]), "".join(level[i + 1:run + 16])
        i //= 16


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), r) for r in groups[s]),
                         key=lambda x: x[:3]) for s in names}
    trees = {s: tree([x[2] for x in ordered[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for g, s in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(ordered[s]):
            pairs = [*path(trees[s], i), *path(top, g)]
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = text.translate(LOWER)
            node = leaf_of(r, text)
            for left, right in pairs:
                node = sha(left + node + right)
            out.append((r["doc_id"], leaf, trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in pairs)), node,
                        node == top[-1][0]))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, 0 if x is None else x) for x in r))


def check(docs):
    got = queries.op11_of(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert in_order(tuple(r) for r in got.collect()) == in_order(brute(docs.collect()))


def test_manifest_equals_brute_force(docs):
    check(docs)


def test_odd_rows(odd):
    """Null and repeated ids, null and empty fields, rows equal in all fields, a very long text, clashing names."""
    check(odd.withColumnRenamed("rid", "place").withColumnRenamed("ids", "leaf").withColumnRenamed("kept", "root"))


def test_empty_table_and_single_row(empty, odd):
    assert queries.op11_of(empty).collect() == []
    check(odd.where("doc_id = 6"))


def test_dense_sparse_and_repeated_ids_in_a_hot_group(spark):
    """Bitmaps of both forms, spans far apart, ids below zero, thousands of rows of one id and of the null id."""
    rng = random.Random(5)
    rows = [(k * 7, f"T{k}", "en", 3, "hot") for k in range(5000)]
    rows += [(rng.choice([None, 3, 70, 2 ** 40, -5, -2 ** 62, 2 ** 62]), rng.choice(["A b", f"T{rng.randrange(900)}", None, ""]),
              "en", rng.choice([1, 2, None]), rng.choice(["hot", "hot", None, "x", "é", "", "zz"])) for _ in range(4000)]
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars int, source string"))


def test_trees_of_more_than_one_slot_array(spark):
    """More leaves in one group, and more groups, than an array has slots; a last run of one."""
    rows = [(k, f"X{k}", "en", 1, "big") for k in range(merkle.SLOTS + 1)]
    rows += [(k, "y", None, 1, f"s{k}") for k in range(merkle.SLOTS + 16)]
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars int, source string"))


def test_proof_text_is_returned_and_untouched_rows_verify(docs):
    rows = merkle.manifest(docs).collect()
    assert all(r["verified"] and r["folded_root"] == r["root"] and len(r["proof"]) % 64 == 0 for r in rows)
    assert len({(r["source"], r["place"]) for r in rows}) == len(rows) == docs.count()


@pytest.mark.parametrize("n", [1, 5, 255, 256, 300, 4096])
def test_bitmap_round_trip_and_rank(n):
    values = np.sort(np.random.default_rng(n).choice(merkle.BITS, n, replace=False))
    raw = merkle.pack_bits(values)
    assert len(raw) <= merkle.BITS // 8 and merkle.unpack_bits(raw).tolist() == values.tolist()
    probe = np.arange(merkle.BITS)
    assert merkle.rank(raw, merkle.popcounts(raw), probe).tolist() == np.searchsorted(values, probe).tolist()


def test_directory_adds_up_all_earlier_spans(spark):
    rng = random.Random(2)
    spans = [(g, s, rng.randrange(1, 50)) for g in (0, 1) for s in sorted({rng.choice(
        [rng.randrange(-5, 5), rng.randrange(-2 ** 51, 2 ** 51), rng.randrange(2 ** 14), 2 ** 51 - 1, -2 ** 51]) for _ in range(200)})]
    got = merkle.first_places(spark.createDataFrame(spans, "gno long, span long, n long")).collect()
    assert {(r["gno"], r["span"]): r["base"] for r in got} == \
        {(g, s): sum(n for h, t, n in spans if h == g and t < s) for g, s, _ in spans}
