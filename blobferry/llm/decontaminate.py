"""Benchmark decontamination with a positional inverted index of the training text.

The corpus is cut into segments of whole documents (about ``SEGMENT_WORDS``
words). One pass stores, per segment, the postings (document, position) of
every word that the benchmark uses, sorted by word: a written table with one
row per segment. Corpus counts of those words come from the stored lists.

A query then walks each segment's lists. For every benchmark window (``n``
consecutive words of an item) it starts with the list of the rarest word,
shifts it by the word's offset in the window, and intersects it with the
shifted lists of the other words, rarest first, until nothing is left or all
words agree: exact phrases. With ``slop`` it also gives proximity matches:
places where every word of the window lies within ``slop`` words of the rarest
one, in any order.

The benchmark is the stated query set. Its distinct words and windows go to
the tasks in blocks of items of about ``BLOCK_BYTES`` of text, one pass over
the corpus each; a block is all the driver holds. A benchmark of one block
moves no document: neither build nor query shuffles anything but word counts.
Of several, the spans and items of documents with hits are united by a
grouped aggregate over a number that each row gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from blobferry.llm.common import fresh_name, materialize, tidy  # noqa: F401

WINDOW = 10
SEGMENT_WORDS = 2_000_000
BLOCK_BYTES = 16_000_000
#: Bytes that separate words become blanks and A-Z become a-z; bytes of other letters stay.
_FOLD = bytes(32 if b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F
              else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

SEGMENT = T.StructType([
    T.StructField("word", T.BinaryType()), T.StructField("first", T.BinaryType()),
    T.StructField("doc", T.BinaryType()), T.StructField("pos", T.BinaryType()),
    T.StructField("doc_id", T.ArrayType(T.LongType())), T.StructField("n_words", T.ArrayType(T.LongType()))])
HITS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.LongType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("near_items", T.ArrayType(T.LongType()))])


def _ids(docs: DataFrame, id_col: str):
    """Ids are whole numbers, or binary values, which stay as they are."""
    binary = isinstance(docs.select(id_col).schema[0].dataType, T.BinaryType)
    return (F.col(id_col) if binary else F.col(id_col).cast("long")).alias("doc_id")


def _with_ids(schema: T.StructType, ids: T.DataType) -> T.StructType:
    """``schema`` with ``doc_id``, or its items, of the type ``ids``."""
    return T.StructType([T.StructField(f.name, f.dataType if f.name != "doc_id" else
                                       T.ArrayType(ids) if isinstance(f.dataType, T.ArrayType) else ids) for f in schema.fields])


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class Queries:
    """Windows of the benchmark items over a numbered vocabulary."""

    def __init__(self, items: list, n: int):
        import numpy as np

        self.vocab: dict = {}
        self.n = n
        win, item, size = [], [], []
        for item_id, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words(text)]
            for i in range(max(1, len(ids) - n + 1) if ids else 0):
                part = ids[i:i + n]
                win.append(part + [-1] * (n - len(part)))
                item.append(item_id)
                size.append(len(part))
        self.windows = np.array(win, np.int32).reshape(-1, n)
        self.size = np.array(size, np.int64)
        self.item = item

    def order(self, counts):
        """Offsets of each window's words, rarest word first (ties: leftmost); padding last."""
        import numpy as np

        c = np.where(self.windows >= 0, counts[self.windows], np.iinfo(np.int64).max)
        return np.argsort(c, axis=1, kind="stable")


def blocks(benchmark: DataFrame, n: int, id_col="item_id", text_col="text"):
    """``(number of blocks, iterator of their Queries)``, at least one. Items with
    a null id or text, or without words, have no window."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")) \
        .where("i is not null and t is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    if count > 1:
        rows = materialize(rows.distinct().withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(count))), "items")
    parts = (rows.where(F.col("b") == b) if count > 1 else rows.distinct() for b in range(count))
    return count, (Queries([(r["i"], r["t"]) for r in part.select("i", "t").collect()], n) for part in parts)


def build_index(docs: DataFrame, vocab: dict, id_col="doc_id", text_col="text") -> DataFrame:
    """Written table of segments: postings of the words in ``vocab`` (word -> number)."""
    bc = docs.sparkSession.sparkContext.broadcast(vocab)
    rows = docs.select(_ids(docs, id_col), F.col(text_col).alias("text"))
    schema = _with_ids(SEGMENT, rows.schema["doc_id"].dataType)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        get, kind = bc.value.get, pa.int64()
        ids, sizes, found, total = [], [], [], 0

        def segment():
            w = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int32)
            p = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.int32)
            d = np.repeat(np.arange(len(found), dtype=np.int32), [len(x[0]) for x in found])
            order = np.argsort(w, kind="stable")  # by word, then document, then position
            w = w[order]
            word, first = np.unique(w, return_index=True)
            row = [[word.astype("<i4").tobytes()], [np.r_[first, len(w)].astype("<i8").tobytes()],
                   [d[order].astype("<i4").tobytes()], [p[order].astype("<i4").tobytes()], [ids], [sizes]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(row, [pa.binary()] * 4 + [pa.list_(kind), pa.list_(pa.int64())])],
                names=SEGMENT.names)

        for batch in batches:
            kind = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ws = words(text.as_py())
                n = np.fromiter((get(w, -1) for w in ws), np.int32, len(ws))
                at = np.flatnonzero(n >= 0).astype(np.int32)
                ids.append(doc_id)
                sizes.append(len(ws))
                found.append((n[at], at))
                total += len(ws)
                if total >= SEGMENT_WORDS:
                    yield segment()
                    ids, sizes, found, total = [], [], [], 0
        if ids:
            yield segment()

    return materialize(rows.mapInArrow(tidy(run), schema), "postings")


def word_counts(index: DataFrame, n_vocab: int):
    """Corpus count of each vocabulary word, from the lengths of the stored lists;
    the result is bounded by the benchmark's vocabulary."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        out = np.zeros(n_vocab, np.int64)
        for batch in batches:
            for word, first in zip(batch.column(0), batch.column(1)):
                out[np.frombuffer(word.as_buffer(), "<i4")] += np.diff(np.frombuffer(first.as_buffer(), "<i8"))
        w = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(out[w])], names=["w", "n"])

    counts = np.zeros(n_vocab, np.int64)
    rows = index.select("word", "first").mapInArrow(tidy(run), "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    for r in rows.collect():
        counts[r["w"]] = r["n"]
    return counts


class Lists:
    """Posting lists of one segment; places are document * 2^32 + position."""

    def __init__(self, word, first, doc, pos, n_vocab: int):
        import numpy as np

        word = np.frombuffer(word, "<i4")
        first = np.frombuffer(first, "<i8")
        self.lo = np.zeros(n_vocab + 1, np.int64)
        self.hi = np.zeros(n_vocab + 1, np.int64)  # the last entry: no word
        self.lo[word], self.hi[word] = first[:-1], first[1:]
        self.place = (np.frombuffer(doc, "<i4").astype(np.int64) << 32) + np.frombuffer(pos, "<i4")

    def get(self, w: int):
        return self.place[self.lo[w]:self.hi[w]]


def _in(sorted_, values):
    """Mask of ``values`` that occur in the sorted array."""
    import numpy as np

    at = np.searchsorted(sorted_, values)
    at[at == len(sorted_)] = 0
    return sorted_[at] == values if len(sorted_) else np.zeros(len(values), bool)


def exact(lists: Lists, window, order, size: int):
    """Places of the window's first word where all its words follow in order."""
    start = None
    for k in order[:size]:
        places = lists.get(window[k])
        if start is None:
            start = places - k
        else:
            start = start[_in(places, start + k)]
        if not len(start):
            break
    return start


def near(lists: Lists, window, order, size: int, slop: int):
    """Places of the rarest word with every other word of the window within ``slop`` words."""
    import numpy as np

    at = lists.get(window[order[0]])
    for k in order[1:size]:
        places = lists.get(window[k])
        i = np.searchsorted(places, at - slop)
        ok = i < len(places)
        ok[ok] = places[i[ok]] <= at[ok] + slop
        at = at[ok]
        if not len(at):
            break
    return at


def find(index: DataFrame, q: Queries, slop: int | None = None) -> DataFrame:
    """Per document: word count, words inside any exact occurrence, items that
    occur, merged hit spans ``[first word, past the last]``, and the items with
    proximity matches (empty without ``slop``)."""
    import numpy as np

    n_vocab = len(q.vocab)
    counts = word_counts(index, n_vocab) if n_vocab else np.zeros(0, np.int64)
    order = q.order(counts) if len(q.windows) else np.zeros((0, q.n), np.int64)
    bc = index.sparkSession.sparkContext.broadcast((q.windows, q.size, np.array(q.item, np.int64), order))

    def run(batches):
        import pyarrow as pa

        windows, size, item, order = bc.value
        r = np.arange(len(windows))
        rare = [windows[r, order[:, j]] if len(r) else r for j in (0, min(1, windows.shape[1] - 1))]
        for batch in batches:
            kind = batch.column(4).type.value_type
            for word, first, doc, pos, ids, n_words in zip(*batch.columns):
                lists = Lists(word.as_buffer(), first.as_buffer(), doc.as_buffer(), pos.as_buffer(), n_vocab)
                ids, n_words = ids.as_py(), np.array(n_words.as_py(), np.int64)
                base = np.r_[0, np.cumsum(n_words)]
                edge = np.zeros(base[-1] + 1, np.int32)  # +1 where a hit starts, -1 past its end
                hits: dict = {}
                close: dict = {}
                has = lists.hi > lists.lo
                some = has[rare[0]] & (has[rare[1]] | (size < 2)) if len(r) else r
                for i in np.flatnonzero(some):
                    at = exact(lists, windows[i], order[i], size[i])
                    if len(at):
                        d = at >> 32
                        p = base[d] + (at & 0xFFFFFFFF)
                        np.add.at(edge, p, 1)
                        np.add.at(edge, p + size[i], -1)
                        for x in np.unique(d):
                            hits.setdefault(int(x), set()).add(int(item[i]))
                    if slop is not None:
                        for x in np.unique(near(lists, windows[i], order[i], size[i], slop) >> 32):
                            close.setdefault(int(x), set()).add(int(item[i]))
                hit = np.cumsum(edge[:-1]) > 0
                rows = []
                for k, doc_id in enumerate(ids):
                    own = hit[base[k]:base[k + 1]] if k in hits else hit[:0]
                    step = np.flatnonzero(np.diff(np.r_[0, own.view(np.int8), 0])).reshape(-1, 2)
                    rows.append((doc_id, int(n_words[k]), int(own.sum()), sorted(hits.get(k, ())), step.tolist(),
                                 sorted(close.get(k, ()))))
                ll = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (kind, pa.int64(), pa.int64(), ll,
                                                                pa.list_(ll), ll))], names=HITS.names)

    return index.mapInArrow(tidy(run), _with_ids(HITS, index.schema["doc_id"].dataType.elementType))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_hit, items, spans, near_items)``, one row per document row.

    A null or empty text has no words and no hit; null and repeated ids keep a
    row each. An item of fewer than ``window`` words, but not none, is one
    window. Items that repeat count once. An empty benchmark leaves every
    document without hits; an empty corpus gives no row. Ids are whole numbers or
    binary values. Other columns are not read.
    """
    count, several = blocks(benchmark, window)
    if count == 1:
        q = next(several)
        return find(build_index(docs, q.vocab, id_col, text_col), q, slop)
    rows = materialize(docs.select(_ids(docs, id_col), F.col(text_col).alias("text")).withColumn("row", F.monotonically_increasing_id()), "numbered")
    base, parts = None, None
    for q in several:
        found = materialize(find(build_index(rows, q.vocab, "row", "text"), q, slop).withColumnRenamed("doc_id", "row"), "hits")
        base = found.select("row", "n_words") if base is None else base
        some = found.where("n_hit > 0 or size(near_items) > 0").drop("n_words", "n_hit")
        parts = some if parts is None else parts.unionAll(some)
    return _united(rows.select("row", "doc_id").join(base, "row"), parts)


def _united(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Hits of all blocks for each of ``rows`` (row, doc_id, n_words): spans merged, items once."""
    every = lambda c: F.flatten(F.collect_list(c))
    ids = lambda c: F.sort_array(F.array_distinct(every(c))).alias(c)
    hits = parts.groupBy("row").agg(F.sort_array(every("spans")).alias("all"), ids("items"), ids("near_items"))
    none, nothing = (F.lit([]).cast(t) for t in ("array<array<bigint>>", "array<bigint>"))

    @F.udf("array<array<bigint>>")
    def merged(spans):
        out = []
        for a, b in spans or []:
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return out

    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return rows.join(hits, "row", "left").withColumn("spans", F.when(F.col("all").isNull(), none).otherwise(merged("all"))) \
        .select("doc_id", "n_words", length.alias("n_hit"), F.coalesce("items", nothing).alias("items"), "spans",
                F.coalesce("near_items", nothing).alias("near_items"))
