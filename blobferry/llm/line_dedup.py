"""Fuzzy line deduplication: MinHash, banding, exact Jaccard, connected components.

A line is the text between newlines. Lines whose sets of ``SHINGLE``-character
shingles have a Jaccard similarity of ``SIMILARITY`` or more are the same
line; one occurrence of each component of such lines stays, the first by
document id and position.

1. Each distinct line gets a MinHash signature (``BANDS`` bands of ``ROWS``
   values; a pair at similarity 0.8 shares a band with probability 0.995).
2. Lines that share a band are linked in a chain, first inside each task (so a
   band that many lines share sends one row per task on), then across tasks.
   Every link is verified by exact Jaccard, and components are taken.
3. A chain may break at a pair that is not similar although others of its
   band are. Bands with such a pair are compared in full, in blocks, by an inverted
   index of a block's shingles, so no link between components is lost.

Only line hashes move in 1 and 2; texts are fetched for candidate lines alone.
Lines are known by the 64-bit XXH64 of their bytes: among n distinct lines two
share it with probability n^2 / 2^65, about one pair in 10^9.7 lines.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from blobferry.llm.common import broadcast_if_small, broadcast_within, by_group, discard, fresh_name, materialize, tidy
from blobferry.llm.components import components

SHINGLE, SIMILARITY = 7, 0.8
BANDS, ROWS = 10, 4
CROWD = 256          # lines of a broken band compared by one task
CHAIN_LINES = 100_000  # lines of a task whose bands are chained at once
COLUMNS = 4096       # shingles of an inverted index counted at a time
CHUNK_CHARS = 1 << 17  # signed at once
BUCKET_BANDS = 1 << 19  # bands, about, that a task links across tasks at once
MAX_BROADCAST = 2_000_000  # ids of 8 bytes; beyond it the join is shuffled
SEED = 3

SIGNED = T.StructType([
    T.StructField("lid", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])
DEALT = T.StructType([T.StructField("bucket", T.IntegerType())] + [
    T.StructField(c, T.BinaryType()) for c in ("bands", "lids", "a", "b")])
OCCURS = "rid long, doc_id long, pos int, lid long"


def shingles(line: str) -> set:
    line = line.ljust(SHINGLE, "\0")  # a shorter line is one shingle
    return {line[i:i + SHINGLE] for i in range(len(line) - SHINGLE + 1)}


def similar(a: set, b: set) -> bool:
    """Exact Jaccard similarity of at least ``SIMILARITY``; sizes alone rule most pairs out."""
    if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return False
    both = len(a & b)
    return both / (len(a) + len(b) - both) >= SIMILARITY


NARROW = 512  # code points below it take 9 bits, so that seven of them are one number


def windows(c, base: int):
    """Sum of ``c[i + j] * base ** (SHINGLE - 1 - j)`` of each window of ``SHINGLE`` (seven) values, modulo 2^64."""
    base, square = c.dtype.type(base), c.dtype.type(base * base % (1 << 64))
    two = c[:-1] * base
    two += c[1:]
    four = two[:-2] * square
    four += two[2:]
    seven = four[:-3] * square  # six values, then the last; in place, as fresh pages cost more than the sums
    seven += two[4:-1]
    seven *= base
    seven += c[SHINGLE - 1:]
    return seven


class Codes:
    """Shingle sets of many lines as sorted arrays of numbers, one number for each distinct shingle, exactly.

    A shingle of code points below ``NARROW`` is packed into 63 bits. Where a line has others,
    shingles are numbered as they come, so such a batch of lines is compared among itself only.
    """

    def __init__(self, lines: list):
        import numpy as np

        raw = "".join(x.ljust(SHINGLE, "\0") for x in lines).encode("utf-32-le", "surrogatepass")
        c = np.frombuffer(raw, "<u4")
        if not len(c):
            self.sets = []
        elif c.max() < NARROW:
            size = np.array([max(len(x), SHINGLE) for x in lines], np.int64)
            end = np.cumsum(size)
            packed = windows(c.astype(np.int64), 1 << 9)
            new = np.ones(len(packed), bool)
            for at, to in zip((end - size).tolist(), (end - SHINGLE + 1).tolist()):
                packed[at:to].sort()
            new[1:] = packed[1:] != packed[:-1]
            new[(end - size)] = True
            for d in range(1, SHINGLE):  # windows that reach into the next line are in no set
                new[end[:-1] - d] = False
            total = np.concatenate(([0], np.cumsum(new)))
            packed = packed[new]
            self.sets = [packed[i:j] for i, j in zip(total[end - size].tolist(), total[end - SHINGLE + 1].tolist())]
        else:
            number: dict = {}
            self.sets = [np.sort(np.array([number.setdefault(s, len(number)) for s in shingles(x)], np.int64)) for x in lines]

    def similar(self, i: int, j: int) -> bool:
        """As :func:`similar`."""
        import numpy as np

        a, b = self.sets[i], self.sets[j]
        if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
            return False
        c = np.concatenate((a, b))
        c.sort()
        both = int(np.count_nonzero(c[1:] == c[:-1]))
        return both / (len(a) + len(b) - both) >= SIMILARITY

    def similar_pairs(self, left, right):
        """Index pairs (one of ``left``, one of ``right``) that are similar, by an inverted index: shared shingles
        are counted from the shingles that both sides hold, ``COLUMNS`` of them at a time. With one object
        for both sides, a line may miss from the pairs with itself."""
        import numpy as np

        rows = (left,) if right is left else (left, right)
        n = [sum(len(self.sets[i]) for i in r) for r in rows]
        col = np.unique(np.concatenate([self.sets[i] for r in rows for i in r]), return_inverse=True)[1].astype(np.int32)
        at = [np.repeat(np.arange(len(r), dtype=np.int32), [len(self.sets[i]) for i in r]) for r in rows]
        col = np.split(col, n[:-1])
        if right is left:  # a shingle of one line alone is shared with no other
            shared = np.bincount(col[0]) > 1
        else:
            most = max(int(c.max()) for c in col) + 1
            shared = (np.bincount(col[0], minlength=most) > 0) & (np.bincount(col[1], minlength=most) > 0)
        number = np.cumsum(shared, dtype=np.int32) - 1
        col, at = zip(*((number[c[shared[c]]], r[shared[c]]) for c, r in zip(col, at)))
        both = np.zeros((len(left), len(right)), np.int64)
        for lo in range(0, int(number[-1]) + 1, COLUMNS):
            m = []
            for c, r, own in zip(col, at, rows):
                hit = (c >= lo) & (c < lo + COLUMNS)
                x = np.zeros((len(own), min(COLUMNS, int(number[-1]) + 1 - lo)), np.float32)
                x[r[hit], c[hit] - lo] = 1
                m.append(x)
            both += np.rint(m[0] @ m[-1].T).astype(np.int64)  # at most COLUMNS ones a sum: exact in single precision
        na = np.array([len(self.sets[i]) for i in left])[:, None]
        nb = np.array([len(self.sets[i]) for i in right])[None, :]
        i, j = np.nonzero(both / (na + nb - both) >= SIMILARITY)
        return np.asarray(left)[i], np.asarray(right)[j]


class Signer:
    def __init__(self, bands=BANDS, rows=ROWS, seed=SEED):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.mult = rng.integers(1, 1 << 31, bands * rows, dtype=np.int64).astype(np.uint32) * 2 + 1
        self.mix = rng.integers(1, 1 << 62, (bands, rows), dtype=np.int64).astype(np.uint64) * 2 + 1

    def keys(self, lines: list):
        """(lines, bands) band keys, by numpy over the concatenated code points."""
        import numpy as np

        out = []
        start = 0
        while start < len(lines):
            size, end = 0, start
            while end < len(lines) and (size < CHUNK_CHARS or end == start):
                size += len(lines[end]) + 1
                end += 1
            out.append(self._chunk(lines[start:end]))
            start = end
        return np.concatenate(out) if out else np.zeros((0, self.bands), np.int64)

    def _chunk(self, lines):
        import numpy as np

        raw = ("\n".join(x.ljust(SHINGLE, "\0") for x in lines) + "\n").encode("utf-32-le", "surrogatepass")
        c = np.frombuffer(raw, "<u4").astype(np.uint64)
        h = windows(c, 0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h >>= np.uint64(32)
        g = h.astype(np.uint32)
        nl = np.flatnonzero(c == 10)
        whole = np.ones(len(c), bool)
        for d in range(SHINGLE):  # windows that reach a newline are no shingles
            whole[nl - d] = False
        g = g[whole[:len(g)]]
        first = np.r_[0, nl[:-1] + 1]
        at = np.r_[0, np.cumsum(nl - first - SHINGLE + 1)[:-1]]
        keys = np.zeros((len(lines), self.bands), np.uint64)
        buf = np.empty_like(g)
        for k in range(self.bands * self.rows):
            least = np.minimum.reduceat(np.multiply(g, self.mult[k], out=buf), at).astype(np.uint64)
            b, r = divmod(k, self.rows)
            keys[:, b] += (least + np.uint64(1)) * self.mix[b, r]
        keys ^= keys >> np.uint64(31)
        return keys.view(np.int64)


def split_lines(text):
    """(position, line) of the lines that are not blank."""
    return [(i, x) for i, x in enumerate((text or "").split("\n")) if x and not x.isspace()]


def line_id(line: str) -> int:
    import xxhash

    h = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), SEED)
    return h - (1 << 64) if h >> 63 else h


def _sign(batches):
    import pyarrow as pa

    signer = Signer()
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            lines = {x: None for t in batch.column(0).slice(i, 512).to_pylist() for _, x in split_lines(t)}
            lines = list(lines)
            keys = signer.keys(lines)
            off = pa.array(range(0, keys.size + 1, signer.bands), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([line_id(x) for x in lines], pa.int64()),
                 pa.ListArray.from_arrays(off, pa.array(keys.ravel()))], names=SIGNED.names)


def _occurrences(batches):
    import pyarrow as pa

    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            rid, doc, pos, lid = [], [], [], []
            for r, d, t in zip(*(c.to_pylist() for c in batch.slice(k, 512).columns)):
                for i, x in split_lines(t):
                    rid.append(r)
                    doc.append(d)
                    pos.append(i)
                    lid.append(line_id(x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid, pa.int64()), pa.array(doc, pa.int64()), pa.array(pos, pa.int32()),
                 pa.array(lid, pa.int64())], names=["rid", "doc_id", "pos", "lid"])


def _texts(batches):
    import pyarrow as pa

    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            lines = list({x: None for t in batch.column(0).slice(i, 512).to_pylist() for _, x in split_lines(t)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([line_id(x) for x in lines], pa.int64()), pa.array(lines, pa.string())], names=["lid", "line"])


def _distinct_pairs(x, y):
    import numpy as np

    order = np.lexsort((y, x))
    pairs = np.stack([x[order], y[order]], axis=1)
    return pairs[np.r_[True, (pairs[1:] != pairs[:-1]).any(axis=1)]] if len(pairs) else pairs


def _chains(batches):
    """Within ``CHAIN_LINES`` lines of a task, link the lines of a band in a chain; the least goes on to the shuffle (b null)."""
    import numpy as np
    import pyarrow as pa

    def chain(lids, keys):
        key, lid = np.concatenate(keys), np.repeat(np.concatenate(lids), BANDS)
        order = np.argsort(key)
        key, lid = key[order], lid[order]
        same = key[1:] == key[:-1]
        many = np.flatnonzero(np.r_[same, False] | np.r_[False, same])  # only bands of several rows need their lines in order
        lid[many] = lid[many][np.lexsort((lid[many], key[many]))]
        first = np.r_[True, key[1:] != key[:-1]]
        link = ~first & np.r_[False, lid[1:] != lid[:-1]]
        pairs = _distinct_pairs(lid[np.flatnonzero(link) - 1], lid[link])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.r_[key[first], np.zeros(len(pairs), np.int64)]), pa.array(np.r_[lid[first], pairs[:, 0]]),
             pa.array(np.r_[np.zeros(first.sum(), np.int64), pairs[:, 1]],
                      mask=np.r_[np.ones(first.sum(), bool), np.zeros(len(pairs), bool)])],
            names=["band", "a", "b"])

    lids, keys, n = [], [], 0
    for batch in batches:
        lids.append(batch.column(0).to_numpy())
        keys.append(batch.column(1).flatten().to_numpy())
        n += batch.num_rows
        if n >= CHAIN_LINES:
            yield chain(lids, keys)
            lids, keys, n = [], [], 0
    if n:
        yield chain(lids, keys)


def _across(batches):
    """From ``(band, b)`` sorted by band, link lines of a band that follow each other: its chain, tasks' least lines in any order."""
    import numpy as np
    import pyarrow as pa

    last = np.zeros((2, 0), np.int64)
    for batch in batches:
        both = np.concatenate([last, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
        last = both[:, -1:]
        link = (both[0, 1:] == both[0, :-1]) & (both[1, 1:] != both[1, :-1])
        x, y = both[1, :-1][link], both[1, 1:][link]
        pairs = _distinct_pairs(np.minimum(x, y), np.maximum(x, y))
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _dealt(n_buckets: int):
    """:func:`_chains` with its rows packed: for each of ``n_buckets`` ranges of bands one row of the bands, their least
    lines, and an even share of the pairs, as little-endian arrays, so that Spark shuffles a few large values."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        edge = np.array([(k << 64) // n_buckets - (1 << 63) for k in range(1, n_buckets)], np.int64)
        for t in _chains(batches):
            first = t.column(2).is_null().to_numpy(zero_copy_only=False)
            band, a = t.column(0).to_numpy()[first], t.column(1).to_numpy()
            pairs = np.stack([a[~first], t.column(2).filter(pa.array(~first)).to_numpy()])
            cut = np.r_[0, np.searchsorted(band, edge), len(band)]  # a chain's bands come in order
            part = np.linspace(0, pairs.shape[1], n_buckets + 1).astype(np.int64)
            a = a[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n_buckets, dtype=np.int32)),
                 *(pa.array([x[i:j].astype("<i8").tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary())
                   for x, at in ((band, cut), (a, cut), (pairs[0], part), (pairs[1], part)))], names=DEALT.names)

    return run


def _across_dealt(batches):
    """From rows of :func:`_dealt` sorted by bucket, the links of all chains: those inside a task and :func:`_across` tasks."""
    import numpy as np
    import pyarrow as pa

    def linked(table):
        band, lid, a, b = (np.frombuffer(b"".join(table.column(c).to_pylist()), "<i8") for c in DEALT.names[1:])
        order = np.argsort(band)
        batch = pa.RecordBatch.from_arrays([pa.array(band[order]), pa.array(lid[order])], names=["band", "b"])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _distinct_pairs(a, b).T], names=["a", "b"])
        yield from _across(iter([batch]))

    for t, starts, ends in by_group(batches, ["bucket"]):
        for lo, hi in zip(starts, ends):
            yield from linked(t.slice(lo, hi - lo))


def _verify(batches):
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            x, y = part.column(2).to_pylist(), part.column(3).to_pylist()
            where = {line: i for i, line in enumerate(dict.fromkeys(x + y))}  # the pairs of a line come together
            codes = Codes(list(where))
            same = [codes.similar(where[p], where[q]) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(same, pa.bool_())],
                                             names=["a", "b", "same"])


def _compare(batches):
    """Links of a block pair that join what is not yet in one component: a spanning forest of its similar pairs."""
    import numpy as np
    import pyarrow as pa

    for t, starts, ends in by_group(batches, ["band", "p", "q"]):
        lid, root, blk = (t.column(c).to_numpy() for c in ("lid", "root", "blk"))
        p, q, line = t.column("p").to_numpy(), t.column("q").to_numpy(), t.column("line")
        found = []
        for lo, hi in zip(starts, ends):
            up = {r: r for r in root[lo:hi].tolist()}
            if len(up) < 2:
                continue

            def top(r):
                while up[r] != r:
                    up[r] = up[up[r]]
                    r = up[r]
                return r

            codes = Codes(line.slice(lo, hi - lo).to_pylist())
            own = np.arange(hi - lo)
            left, right = (own, own) if p[lo] == q[lo] else (own[blk[lo:hi] == p[lo]], own[blk[lo:hi] == q[lo]])
            if not len(left) or not len(right):
                continue
            i, j = codes.similar_pairs(left, right)
            apart = root[lo + i] != root[lo + j]
            for i, j in zip((lo + i[apart]).tolist(), (lo + j[apart]).tolist()):
                x, y = top(int(root[i])), top(int(root[j]))
                if x != y:
                    up[x] = y
                    found.append((int(lid[i]), int(lid[j])))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)],
                                         names=["a", "b"])


def _with_texts(docs: DataFrame, text_col: str, lids: DataFrame) -> DataFrame:
    """Written ``(lid, line)`` of the wanted lines, one row each."""
    lines = docs.select(text_col).mapInArrow(tidy(_texts), "lid long, line string")
    return materialize(lines.join(broadcast_if_small(lids, MAX_BROADCAST), "lid", "left_semi")
                       .groupBy("lid").agg(F.first("line").alias("line")), "lines")


def line_components(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(node, root)`` over line ids: lines similar to another distinct line, and their component."""
    signed = materialize(docs.select(text_col).mapInArrow(tidy(_sign), SIGNED), "signatures")
    buckets = max(1, -(-signed.count() * BANDS // BUCKET_BANDS))
    cand = materialize(signed.mapInArrow(tidy(_dealt(buckets)), DEALT).repartition("bucket").sortWithinPartitions("bucket")
                       .mapInArrow(tidy(_across_dealt), "a long, b long").distinct(), "candidates")
    lids = materialize(cand.select(F.col("a").alias("lid")).unionAll(cand.select("b")).distinct(), "candidate-lines")
    texts = _with_texts(docs, text_col, lids)
    x, y = texts.toDF("a", "x"), texts.toDF("b", "y")
    tested = materialize(cand.join(x, "a").join(y, "b").select("a", "b", "x", "y")
                         .mapInArrow(tidy(_verify), "a long, b long, same boolean"), "tested")
    discard(cand, lids)
    links = tested.where("same").select("a", "b")
    comp = materialize(components(links), "line-components")

    # bands with a pair that stayed apart: compare the rest of the band
    own = materialize(tested.where("not same").select("a", "b")
                      .join(comp.toDF("a", "ra"), "a", "left").join(comp.toDF("b", "rb"), "b", "left")
                      .where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"), "apart")
    ends = materialize(own.select(F.col("a").alias("lid")).unionAll(own.select("b")).distinct(), "apart-lines")
    keys = materialize(signed.join(broadcast_if_small(ends, MAX_BROADCAST), "lid", "left_semi")
                       .groupBy("lid").agg(F.first("bands").alias("bands")), "apart-bands")
    broken = own.join(keys.toDF("a", "ka"), "a").join(keys.toDF("b", "kb"), "b") \
        .select(F.explode(F.array_intersect("ka", "kb")).alias("band")).distinct()
    broken = materialize(broken, "broken-bands")
    members = signed.select("lid", F.explode("bands").alias("band")) \
        .join(broadcast_if_small(broken, MAX_BROADCAST), "band", "left_semi").distinct()
    members = materialize(members.join(comp.toDF("lid", "root"), "lid", "left")
                          .select("band", "lid", F.coalesce("root", "lid").alias("root")), "members")
    discard(signed)
    crowd = materialize(members.groupBy("band").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("r0"),
                                                    F.max("root").alias("r1"))
                        .where("m > 2 and r0 != r1").select("band", "m"), "crowds")  # of two, the pair was tested
    n_blk = F.ceil(F.col("m") / CROWD).cast("int")
    grid = members.join(crowd, "band").withColumn("blk", F.pmod(F.xxhash64("lid"), n_blk).cast("int")) \
        .withColumn("o", F.explode(F.sequence(F.lit(0), n_blk - 1))) \
        .select("band", "lid", "root", "blk", F.least("blk", "o").alias("p"), F.greatest("blk", "o").alias("q"))
    grid = materialize(grid, "grid")
    group = ["band", "p", "q"]  # a line that shares a band was a candidate, so its text is at hand
    more = grid.join(texts, "lid").repartition(*group) \
        .sortWithinPartitions(*group, "lid").mapInArrow(tidy(_compare), "a long, b long")
    more = materialize(more, "more-links")
    discard(members, grid, texts)
    return comp if more.isEmpty() else components(links.unionAll(more))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with repeated lines taken out of ``text_col``, plus
    ``n_lines`` and ``n_dropped`` (underscores in front where such a column exists).

    Blank lines are never dropped. The occurrence that stays is the first by
    document id (nulls last), then document, then position. Rows that repeat
    both id and text are one document and get the same result. Null text stays
    null with no lines; a text all of whose lines go becomes empty. Empty
    table: no row.
    """
    comp = line_components(docs, text_col)
    rid = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))
    occurs = materialize(
        docs.select(rid.alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col))
        .mapInArrow(tidy(_occurrences), OCCURS), "occurrences")
    named = occurs.join(comp.select(F.col("node").alias("lid"), "root"), "lid", "left") \
        .select("rid", "pos", F.coalesce("root", "lid").alias("line"), F.col("doc_id").isNull().alias("no_id"), "doc_id")
    place = F.struct("no_id", "doc_id", "rid", "pos")
    named = materialize(named, "named-lines")
    discard(occurs)
    written = materialize(named.groupBy("line").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                          .where("first != last").select("line", "first.rid", "first.pos"), "first-lines")
    first = written.select("line", F.col("rid").alias("rid0"), F.col("pos").alias("pos0"))
    drop = named.join(first, "line").where("rid != rid0 or pos != pos0").groupBy("rid") \
        .agg(F.collect_set("pos").alias("gone"))
    drop = materialize(drop, "dropped-lines")
    discard(named, written)
    gone, key, total, lost = (fresh_name(docs.columns, n) for n in ("gone", "rid", "n_lines", "n_dropped"))
    out = docs.withColumn(key, rid).join(
        broadcast_within(drop.select(F.col("rid").alias(key), F.col("gone").alias(gone))), key, "left")

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def rebuild(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        rows = []
        for text, g in zip(texts, gone):
            n = len(split_lines(text))
            if g is None or text is None:
                rows.append((text, n, 0))
            else:
                skip = set(g.tolist())
                rows.append(("\n".join([x for i, x in enumerate(text.split("\n")) if i not in skip]), n, len(skip)))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    new = fresh_name(docs.columns, "rebuilt")
    out = out.withColumn(new, rebuild(F.col(text_col), F.col(gone)))
    return out.withColumns({text_col: F.col(f"{new}.text"), total: F.col(f"{new}.n_lines"),
                            lost: F.col(f"{new}.n_dropped")}).drop(new, gone, key)
