import collections

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from blobferry.llm import lattice, line_dedup, simhash
from blobferry.llm.components import components


def partition(pairs, nodes):
    up = {n: n for n in nodes}

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in pairs:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "empty"])
def test_components(spark, kind):
    rng = np.random.default_rng(5)
    pairs = {"chain": [(i, i + 1) for i in range(60)][::-1], "star": [(500, i) for i in range(100)],
             "random": rng.integers(0, 300, (200, 2)).tolist(), "empty": []}[kind]
    df = spark.createDataFrame([tuple(p) for p in pairs] + [(None, 1), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    linked = [(a, b) for a, b in pairs if a != b]
    assert got == partition(linked, {x for p in linked for x in p})


def reference_fingerprint(text, k):
    w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def check_simhash(rows, docs, k, d):
    fp = {}
    for r in docs:
        fp.setdefault((r["doc_id"], reference_fingerprint(r["text"], k)), 0)
        fp[(r["doc_id"], reference_fingerprint(r["text"], k))] += 1
    got = collections.Counter((r["doc_id"], int(r["fingerprint"], 16)) for r in rows)
    assert got == fp
    values = sorted({f for _, f in fp})
    root = partition([(a, b) for i, a in enumerate(values) for b in values[i + 1:] if bin(a ^ b).count("1") <= d], values)
    least = {}
    for i, f in fp:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    for r in rows:
        assert r["component_id"] == least.get(root[int(r["fingerprint"], 16)])


@pytest.mark.parametrize("d", [0, 1, 2, 3])
def test_simhash_equals_brute_force(docs, d):
    check_simhash(simhash.near_duplicates(docs, 3, d).collect(), docs.collect(), 3, d)


def test_simhash_odd_rows(odd, empty):
    check_simhash(simhash.near_duplicates(odd).collect(), odd.collect(), 3, 2)
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_links_every_close_pair(spark):
    rng = np.random.default_rng(9)
    base = rng.integers(-2 ** 62, 2 ** 62, 40)
    fps = {int(b) for b in base} | {int(b ^ np.int64(1 << int(i))) for b in base for i in rng.integers(0, 62, 5)}
    fps |= {int(x ^ np.int64((1 << 3) | (1 << 40))) for x in base}
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for d in (1, 2, 3):
        got = {r["node"]: r["root"] for r in components(simhash.links(df, d)).collect()}
        vals = sorted(fps)
        pairs = [(a, b) for i, a in enumerate(vals) for b in vals[i + 1:] if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= d]
        want = partition(pairs, {x for p in pairs for x in p})
        assert got == want


def check_lines(rows, docs):
    occ = [(r["doc_id"], i, x) for r in docs for i, x in line_dedup.split_lines(r["text"])]
    uniq = list(dict.fromkeys(x for _, _, x in occ))
    sets = [line_dedup.shingles(x) for x in uniq]
    inv, pairs = {}, []
    for i, s in enumerate(sets):
        c = collections.Counter(j for g in s for j in inv.get(g, ()))
        pairs += [(i, j) for j, n in c.items() if n / (len(s) + len(sets[j]) - n) >= line_dedup.SIMILARITY]
        for g in s:
            inv.setdefault(g, []).append(i)
    root = partition(pairs, range(len(uniq)))
    comp = {x: root[i] for i, x in enumerate(uniq)}
    seen = set()
    want = {}
    for r in sorted(docs, key=lambda r: (r["doc_id"] is None, r["doc_id"])):
        out = []
        for x in (r["text"] or "").split("\n"):
            if x and not x.isspace():
                if comp[x] in seen:
                    continue
                seen.add(comp[x])
            out.append(x)
        want[r["doc_id"]] = None if r["text"] is None else "\n".join(out)
    assert {r["doc_id"]: r["text"] for r in rows} == want
    return len(uniq) - len(set(comp.values()))


def test_line_dedup_equals_brute_force(docs):
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns + ["n_lines", "n_dropped"]
    assert check_lines(out.collect(), docs.collect()) > 0  # some distinct lines are similar


def test_line_dedup_broken_band_loses_no_link(spark):
    """A chain a-b-c in which only neighbours are similar, among many lines of one band."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(60)]
    lines = [" ".join(words[:k] + [w + "q" for w in words[k:]]) for k in range(0, 60, 3)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    check_lines(line_dedup.dedup_lines(df).collect(), df.collect())


@pytest.mark.parametrize("letters", ["abcdé", "abc漢字🙂\ud800"])
def test_shingle_codes_equal_sets(letters, monkeypatch):
    """Packed and numbered shingles, and the index over them, against plain sets."""
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcdefg hij"), n)) for n in rng.integers(1, 150, 12)]
    lines = list(base)
    for _ in range(80):
        x = list(base[rng.integers(len(base))])
        for _ in range(rng.integers(0, 4)):
            x[rng.integers(len(x))] = letters[rng.integers(len(letters))]
        lines.append("".join(x))
    sets, codes = [line_dedup.shingles(x) for x in lines], line_dedup.Codes(lines)
    want = {(i, j) for i in range(len(lines)) for j in range(len(lines)) if line_dedup.similar(sets[i], sets[j])}
    assert len(want) > 2 * len(lines)
    assert {(i, j) for i in range(len(lines)) for j in range(len(lines)) if codes.similar(i, j)} == want
    monkeypatch.setattr(line_dedup, "COLUMNS", 30)
    left, right = np.arange(0, len(lines), 2), np.arange(len(lines))
    i, j = codes.similar_pairs(left, right)
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a, b in want if a % 2 == 0}
    assert line_dedup.Codes([]).sets == []


def test_line_dedup_of_a_crowded_template(spark, monkeypatch):
    """Many lines of one template, similar to some of the others only, in blocks of a few lines."""
    monkeypatch.setattr(line_dedup, "CROWD", 16)
    rng = np.random.default_rng(6)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnop"), n))
    ends = [word(40) for _ in range(9)]
    lines = ["the same long opening of every line in this table, " * 2 + ends[rng.integers(9)] + word(6) for _ in range(120)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    assert check_lines(line_dedup.dedup_lines(df).collect(), df.collect()) > 50


def test_line_dedup_odd_rows(odd, empty):
    out = line_dedup.dedup_lines(odd)
    assert out.columns == odd.columns + ["_n_lines", "n_dropped"]
    rows = out.collect()
    assert len(rows) == odd.count()
    texts = collections.defaultdict(list)
    for r in rows:
        texts[r["doc_id"]].append(r["text"])
    assert texts[1] == [None] and texts[2] == [""] and texts[3] == ["  \n\t\n"]
    assert texts[4] == ["one line\nother line"] * 2  # rows that repeat id and text are one document
    assert texts[5] == [""] and texts[-7] == ["x"]
    assert line_dedup.dedup_lines(empty).count() == 0


def brute_vectors(ids, vecs, labels, t=0.98):
    n = len(ids)
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
          and labels[i] is not None and ids[i] is not None for i, v in enumerate(vecs)]
    links = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and labels[i] == labels[j] and len(vecs[i]) == len(vecs[j]):
                a, b = np.array(vecs[i], float), np.array(vecs[j], float)
                links[i, j] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= t
    return links


def near_copies(n_groups, size, dim, seed, noise=0.012):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n_groups):
        c = rng.normal(size=dim)
        c /= np.linalg.norm(c)
        out += [(c + rng.normal(size=dim) * noise).tolist() for _ in range(size)]
    return out


def test_lattice_recall_and_precision(spark):
    vecs = near_copies(25, 8, 64, 1) + near_copies(300, 1, 64, 2)
    labels = [i % 3 if i < 200 else 0 for i in range(len(vecs))]
    df = spark.createDataFrame([(i, v, l) for i, (v, l) in enumerate(zip(vecs, labels))],
                               "vec_id long, embedding array<float>, label int")
    rows = {r["vec_id"]: r for r in lattice.near_vectors(df).collect()}
    stored = [[float(np.float32(x)) for x in v] for v in vecs]
    links = brute_vectors(list(range(len(vecs))), stored, labels)
    got, want = sum(r["n_links"] for r in rows.values()), links.sum()
    assert all(rows[i]["n_links"] <= links[i].sum() for i in rows)
    assert want > 300 and got >= 0.97 * want
    root = partition(np.argwhere(links).tolist(), range(len(vecs)))
    same = np.mean([rows[i]["component_id"] == root[i] for i in rows])
    assert same >= 0.97 and all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows.values())


def test_lattice_crowded_cells_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lattice, "CROWD", 16)
    vecs = near_copies(1, 150, 64, 3, 0.004)
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>, label int")
    rows = lattice.near_vectors(df).collect()
    links = brute_vectors(list(range(150)), vecs, [1] * 150)
    assert {r["vec_id"]: r["n_links"] for r in rows} == dict(enumerate(links.sum(axis=1)))
    assert {r["component_id"] for r in rows} == {0}


def test_lattice_odd_rows(spark):
    e = [1.0] + [0.0] * 7
    rows = [(1, None, 1), (2, [], 1), (3, [0.0] * 8, 1), (4, [1.0, None] + [0.0] * 6, 1), (5, [float("nan")] * 8, 1),
            (6, [float("inf")] + [0.0] * 7, 1), (None, e, 1), (8, e, None), (9, e, 1), (9, e, 1), (10, [5e-300] + [-0.0] * 7, 1),
            (11, [1e300] + [0.0] * 7, 1), (12, [-1.0] + [0.0] * 7, 1), (13, [1.0], 1), (14, [2.0], 1), (15, e, 2)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, cid string")
    got = collections.defaultdict(list)
    for r in lattice.near_vectors(df).collect():
        got[r["vec_id"]].append((r["n_links"], r["component_id"], r["kept"]))
    assert got.pop(None) == [(0, None, True)]
    assert got.pop(9) == [(3, 9, True)] * 2 and got.pop(10) == [(3, 9, False)] and got.pop(11) == [(3, 9, False)]
    assert got.pop(13) == [(1, 13, True)] and got.pop(14) == [(1, 13, False)]
    assert all(v == [(0, k, True)] for k, v in got.items())
    assert lattice.near_vectors(df.limit(0)).count() == 0


def test_e8_decoder_is_nearest():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8)) * 2
    p = lattice.decode_e8(x)
    assert np.all((p * 2 == np.rint(p * 2)) & (p.sum(axis=1, keepdims=True) % 2 == 0))
    d = ((x - p) ** 2).sum(axis=1)
    roots = lattice._roots()
    assert len(roots) == 240
    for r in roots:  # no neighbour is nearer
        assert np.all(d <= ((x - p - r) ** 2).sum(axis=1) + 1e-9)


def test_no_query_limits_its_tables():
    import inspect

    from blobferry.llm import queries

    assert ".limit(" not in inspect.getsource(queries) and "sample(" not in inspect.getsource(queries)
    assert F is not None


def test_line_dedup_drops_the_tables_it_has_read(spark, tmp_path, monkeypatch):
    from blobferry import session

    monkeypatch.setattr(session, "state_root", lambda spark: str(tmp_path))
    lines = [f"the {k}th line of a text, long enough to have many shingles" for k in range(40)]
    docs = spark.createDataFrame([(i, "\n".join(lines[i:i + 5])) for i in range(30)], "doc_id long, text string")
    out = line_dedup.dedup_lines(docs)
    left = {p.name.rpartition("-")[0] for p in (tmp_path / "scratch").iterdir()}
    assert "dropped-lines" in left and not left & {"signatures", "chains", "occurrences", "named-lines", "lines"}
    assert out.count() == 30


def test_pairs_of_one_block_are_those_of_plain_python():
    rng = np.random.default_rng(11)
    base = ["".join(rng.choice(list("abcdef "), 60)) for _ in range(12)]
    lines = [b[:k] + "x" + b[k + 1:] for b in base for k in (0, 59)] + ["only here and nowhere else at all"]
    codes, own = line_dedup.Codes(lines), np.arange(len(lines))
    i, j = codes.similar_pairs(own, own)
    sets = [line_dedup.shingles(x) for x in lines]
    want = {(a, b) for a in own for b in own if a != b and line_dedup.similar(sets[a], sets[b])}
    assert want and {(a, b) for a, b in zip(i.tolist(), j.tolist()) if a != b} == want


def test_chains_of_a_task_and_across_tasks_link_every_line_of_a_band(monkeypatch):
    """Lines that share a band are linked whatever the batches; the least of a band goes on once for all batches of a chain."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    lid = rng.integers(0, 60, 300)
    keys = rng.integers(1, 25, (60, line_dedup.BANDS))[lid]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(lid[rows]), pa.array(keys[rows].tolist(), pa.list_(pa.int64()))],
                                          names=["lid", "bands"])

    def groups(n_lines):
        monkeypatch.setattr(line_dedup, "CHAIN_LINES", n_lines)
        tasks = [pa.Table.from_batches(line_dedup._chains(iter([batch(slice(k, k + 10)) for k in range(lo, lo + 100, 10)])))
                 for lo in (0, 100, 200)]
        t = pa.concat_tables(tasks)
        link = [(a, b) for a, b in zip(t["a"].to_pylist(), t["b"].to_pylist()) if b is not None]
        firsts = sorted((k, a) for k, a, b in zip(*(t[c].to_pylist() for c in ("band", "a", "b"))) if b is None)
        cut = [pa.RecordBatch.from_arrays([pa.array([x[0] for x in firsts[k:k + 7]]), pa.array([x[1] for x in firsts[k:k + 7]])],
                                          names=["band", "b"]) for k in range(0, len(firsts), 7)]
        for p in line_dedup._across(iter(cut)):
            link += zip(p["a"].to_pylist(), p["b"].to_pylist())
        return len(firsts), link

    few, whole = groups(1000)
    many, split = groups(10)
    assert few < many
    for link in (whole, split):
        up = list(range(60))
        for a, b in link:
            assert a != b and set(keys[lid.tolist().index(a)]) & set(keys[lid.tolist().index(b)])
            up = [up[b] if x == up[a] else x for x in up]
        linked = {x for pair in link for x in pair}
        for k in range(1, 25):  # every line of a band is a candidate, and the band is in one piece
            rows = {int(x) for x, y in zip(lid, keys) if k in y}
            assert len(rows) < 2 or (rows <= linked and len({up[x] for x in rows}) == 1)


def test_line_texts_are_read_once(spark, monkeypatch):
    """Lines compared in broken bands are candidates already: no second pass over the documents."""
    calls = []
    whole = line_dedup._with_texts
    monkeypatch.setattr(line_dedup, "_with_texts", lambda *a: calls.append(1) or whole(*a))
    base = "abcdefghijklmnopqrstuvwxyz0123456789" * 3
    docs = spark.createDataFrame([(i, base[:100 - 5 * i] + str(i) * 5 * i) for i in range(20)], "doc_id long, text string")
    line_dedup.dedup_lines(docs).count()
    assert len(calls) == 1


def test_windows_are_those_of_horner():
    for dtype, base in ((np.uint64, 0x9E3779B97F4A7C15), (np.int64, 512)):
        c = np.random.default_rng(1).integers(0, 500, 40).astype(dtype)
        want = [sum(int(x) * base ** (6 - j) for j, x in enumerate(c[i:i + 7])) % (1 << 64) for i in range(34)]
        assert [int(x) % (1 << 64) for x in line_dedup.windows(c, base)] == want
        assert len(line_dedup.windows(c[:7], base)) == 1


def test_dealt_chains_give_the_links_of_plain_ones(monkeypatch):
    """bands and lines go through the shuffle as a few packed rows, and no band or pair is lost in any number of buckets."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    lid = rng.integers(-40, 40, 400)
    keys = rng.integers(-1 << 63, 1 << 63, (80, line_dedup.BANDS))
    keys[:, 0] = rng.choice([-1 << 63, -1, 0, 1, (1 << 63) - 1], 80)  # crowded bands, at the ends and edges of buckets too
    keys[:, 1] = keys[rng.integers(0, 20, 80), 1]
    monkeypatch.setattr(line_dedup, "CHAIN_LINES", 50)

    def batches():
        for k in range(0, 400, 25):
            rows = slice(k, k + 25)
            yield pa.RecordBatch.from_arrays([pa.array(lid[rows]), pa.array(keys[lid[rows] + 40].tolist(), pa.list_(pa.int64()))],
                                             names=["lid", "bands"])

    chained = pa.Table.from_batches(line_dedup._chains(batches())).to_pylist()
    by_band = {}
    for r in chained:
        if r["b"] is None:
            by_band.setdefault(r["band"], []).append(r["a"])
    inside = {(r["a"], r["b"]) for r in chained if r["b"] is not None}
    for n in (1, 2, 7, 64):
        dealt = pa.Table.from_batches(line_dedup._dealt(n)(batches()))
        assert dealt.num_rows == 8 * n and set(dealt["bucket"].to_pylist()) == set(range(n))
        got = set()
        for t in line_dedup._across_dealt(iter(dealt.sort_by("bucket").combine_chunks().to_batches(max_chunksize=3))):
            got |= set(zip(t["a"].to_pylist(), t["b"].to_pylist()))
        assert inside <= got and all(a < b for a, b in got)
        own = partition(got, set(lid.tolist()))
        for rows in by_band.values():  # a band's lines, one for each chain, are in one piece
            assert len({own[x] for x in rows}) == 1
        assert all(any(a in x and b in x for x in by_band.values()) for a, b in got - inside)


def test_sets_of_a_batch_are_those_of_each_line():
    lines = ["a", "abcdefg", "aaaaaaaaaaaaaaa", "the same opening, the same opening, the same opening", "\u00e9" * 20, "\0" * 9, "zz top"]
    for part in (lines, lines[:1], lines[-1:], lines[::-1]):
        assert [len(x) for x in line_dedup.Codes(part).sets] == [len(line_dedup.shingles(x)) for x in part]
        assert all((np.diff(x) > 0).all() for x in line_dedup.Codes(part).sets)
