"""Lexical retrieval packing: windows filled with BM25 neighbours of their seed.

1. Every text is encoded once; ids go to a written table.
2. Corpus statistics: document count, mean length, and in how many documents
   each token id occurs (at most one row per vocabulary entry, summed in the
   tasks first). Token ids are the terms of the index.
3. Documents go to index shards by their heaviest term, the one with the most
   BM25 weight, so likely neighbours meet. Only a term that is the heaviest of
   more than ``KEY_ROWS`` documents is salted, by content: by the second
   heaviest term, then, for keys still too large, by the third, by the ids and
   at last by the row. So no shard key holds more than about ``KEY_ROWS`` rows,
   and near copies part only in a group of copies larger than that.
4. Each task walks its shards in blocks of at most ``BLOCK_TOKENS`` ids and
   builds the inverted index of a block. Windows are filled greedily: the
   seed, then its unused neighbours by falling BM25 score, then the next
   unused document. The document that overfills a window is cut there and
   seeds the next one, so windows are full; only the last ids of a task form
   shorter sequences, of a power of two each.

Terms in over half of all documents have no positive BM25 weight and are
skipped in queries; they are most of a posting list's length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from blobferry.llm.common import binary_array, broadcast_if_small, discard, materialize, tidy
from blobferry.llm.encoder import encoder, forget, read_spec

KEY_ROWS = 4096
BLOCK_TOKENS = 2_000_000
CACHED_PIECES = 150_000  # of the encoder in a task, twice: this operator runs beside what earlier stages left in memory
BLOCK_DOCS = 1024
ROWS_AT_ONCE = 512   # documents whose terms are sorted at once
DENSE_CELLS = 6_000_000  # of a block's table of shared terms and documents (48 MB); above it, posting lists
MAX_BROADCAST = 500_000  # large keys joined by broadcast up to this count, else shuffled
K1, B = 1.2, 0.75

IDS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.BinaryType()),
                    T.StructField("n", T.LongType())])
TOP = ["term", "second", "third"]
KEYED = T.StructType(IDS.fields + [T.StructField(c, T.IntegerType()) for c in TOP])
PIECES = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("start", T.LongType()), ("length", T.LongType()), ("doc_tokens", T.LongType()),
    ("sequence_id", T.LongType()), ("offset", T.LongType()), ("ids", T.BinaryType()))])


def encode_table(docs: DataFrame, tokenizer_path: str, end_id: int, id_col="doc_id", text_col="text",
                 cached_pieces: int = CACHED_PIECES) -> DataFrame:
    """Written table ``(doc_id, ids, n)``: little-endian ids with ``end_id`` after each document."""
    import numpy as np

    text = read_spec(tokenizer_path)
    spec = docs.sparkSession.sparkContext.broadcast(text)
    dtype = id_dtype(text, end_id)
    end = np.array([end_id], dtype).tobytes()

    def run(batches):
        import pyarrow as pa

        enc = encoder(spec.value)
        enc.keep = cached_pieces
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                rows = enc.encode(batch.column(1).slice(i, 2048).to_pylist())
                if enc.dtype != dtype:
                    rows = [np.frombuffer(r, enc.dtype).astype(dtype).tobytes() for r in rows]
                n = np.array([len(r) for r in rows], np.int64) + len(end)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 2048), binary_array(end.join(rows) + end, n),
                     pa.array(n // len(end))], names=IDS.names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(tidy(run), IDS), "ids")


def id_dtype(spec: str, end_id: int) -> str:
    return "<u2" if encoder(spec).width == 2 and end_id < 1 << 16 else "<u4"


def term_counts(table: DataFrame, dtype: str):
    """(document count, mean length, {token id: documents that hold it}); the
    result is bounded by the vocabulary, not by the corpus."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        forget()  # the pieces served this worker's encoding tasks and would stay through all later stages
        df = np.zeros(0, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS_AT_ONCE):
                n = np.bincount(distinct_rows([np.frombuffer(raw.as_buffer(), dtype)
                                               for raw in batch.column(0).slice(i, ROWS_AT_ONCE)])[0])
                if len(n) > len(df):
                    df, n = n, df
                df[:len(n)] += n
        t = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(df[t])], names=["term", "df"])

    rows = table.select("ids").mapInArrow(tidy(run), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r["term"]: r["df"] for r in rows.collect()}  # one row per vocabulary entry
    n, mean = table.agg(F.count(F.lit(1)), F.avg("n")).first()
    return n, mean or 1.0, df


def idf_table(n: int, df: dict):
    """Robertson idf by token id, 0 where it would not be positive."""
    import numpy as np

    out = np.zeros(max(df, default=0) + 1)
    if df:
        t = np.fromiter(df.keys(), np.int64)
        d = np.fromiter(df.values(), np.float64)
        out[t] = np.maximum(0, np.log((n - d + 0.5) / (d + 0.5)))
    return out


def distinct_rows(rows: list):
    """Of many documents at once: their sorted distinct ids, how often each occurs, and the row of each."""
    import numpy as np

    ids = np.concatenate(rows)
    kind, shift = (np.uint32, 16) if ids.dtype.itemsize == 2 and len(rows) <= 1 << 16 else (np.uint64, 32)
    key = np.repeat(np.arange(len(rows), dtype=kind) << kind(shift), [len(r) for r in rows]) | ids
    key.sort()
    at = np.flatnonzero(key[1:] != key[:-1])
    at = np.concatenate(([0], at + 1)) if len(key) else at
    tf = np.diff(at, append=len(key))
    key = key[at]
    return (key & kind((1 << shift) - 1)).astype(ids.dtype), tf, (key >> kind(shift)).astype(np.intp)


def distinct(ids):
    """Sorted distinct ids of a document and how often each occurs."""
    return distinct_rows([ids])[:2]


def weights(rows: list, idf, mean: float):
    """Distinct ids of each document that count in a query, their BM25 weights, and the row of each."""
    import numpy as np

    t, tf, row = distinct_rows(rows)
    by = idf[t]
    keep = by > 0
    t, tf, row, by = t[keep], tf[keep], row[keep], by[keep]
    n = np.array([len(r) for r in rows], np.int64)[row]
    return t, by * tf * (K1 + 1) / (tf + K1 * (1 - B + B * n / mean)), row


def top_terms(rows: list, idf, mean: float):
    """The heaviest terms of each document, one column each document and -1 where it has no more; of ties the smallest id."""
    import numpy as np

    top = np.full((len(TOP), len(rows)), -1, np.int32)
    t, w, row = weights(rows, idf, mean)
    for k in range(len(TOP)):
        if not len(t):
            break
        start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        most = np.maximum.reduceat(w, start)
        at = np.flatnonzero(w == np.repeat(most, np.diff(start, append=len(w))))
        at = at[np.r_[True, row[at][1:] != row[at][:-1]]]
        top[k, row[at]] = t[at]
        left = np.ones(len(t), bool)
        left[at] = False
        t, w, row = t[left], w[left], row[left]
    return top


class Block:
    """Inverted index of a block of documents; ``scores`` and ``ranked`` give the neighbours of one."""

    def __init__(self, docs: list, idf, mean: float):
        import numpy as np

        self.n, self.idf = len(docs), idf
        t, w, doc = weights(docs, idf, mean) if docs else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.intp))
        self.terms = np.split(t, np.searchsorted(doc, np.arange(1, self.n))) if docs else []
        order = np.argsort(t, kind="stable")
        t, w, doc = t[order].astype(np.int64), w[order], doc[order]
        self.start = np.searchsorted(t, np.arange(len(idf) + 1))
        shared = np.flatnonzero(np.diff(self.start) > 1)  # a term of one document links it with no other
        self.row = None
        if len(shared) * self.n <= DENSE_CELLS:
            self.row = np.full(len(idf), -1, np.intp)
            self.row[shared] = np.arange(len(shared))
            own = self.row[t] >= 0
            self.dense = np.zeros((len(shared), self.n))
            self.dense[self.row[t[own]], doc[own]] = w[own]
        else:  # posting lists: weight and document as one number each, so that lists are put together once
            self.postings = w + 1j * doc

    def scores(self, i: int):
        """Score of each document of the block as a neighbour of ``i``; 0 without a shared term, and for ``i``.
        Terms are added in ascending order either way, so both ways give the same sums."""
        import numpy as np

        t = self.terms[i].astype(np.int64)
        if not len(t):
            return np.zeros(self.n)
        if self.row is not None:
            r = self.row[t]
            score = np.add.reduce(self.dense[r[r >= 0]], axis=0)
        else:
            found = np.concatenate([self.postings[a:b] for a, b in zip(self.start[t].tolist(), self.start[t + 1].tolist())])
            score = np.bincount(found.imag.astype(np.intp), found.real, self.n)
        score[i] = 0
        return score

    def ranked(self, i: int):
        """Other documents of the block that share a term with ``i``, best first, ties in block order."""
        import numpy as np

        score = self.scores(i)
        return np.argsort(-score, kind="stable")[:np.count_nonzero(score)]


def pack_task(batches, dtype: str, idf, mean: float, window: int):
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    seq0 = TaskContext.get().partitionId() << 40
    state = {"seq": 0, "used": 0}  # the open window; it goes on in the next block
    out: list = []

    def put(doc, ids, a: int, b: int):
        out.append((doc, a, b - a, len(ids), seq0 + state["seq"], state["used"], ids[a:b]))
        state["used"] += b - a
        if state["used"] == window:
            state["seq"] += 1
            state["used"] = 0

    def add(doc, ids, a: int = 0) -> int:
        """Put a document from ``a`` on; returns where it was cut (its length if it ended)."""
        fill = min(window - state["used"], len(ids) - a)
        put(doc, ids, a, a + fill)
        return a + fill

    def flush(rows):
        cols = list(zip(*rows))
        n = np.array([len(x) * 4 for x in cols[6]], np.int64)
        raw = np.concatenate(cols[6]).astype("<u4").tobytes()
        arrays = [pa.array(c, pa.int64()) for c in cols[:6]] + [binary_array(raw, n)]
        return pa.RecordBatch.from_arrays(arrays, names=PIECES.names)

    def done():
        """Hand on the pieces of filled windows; those of the open one stay."""
        seq = seq0 + state["seq"]
        open_, full = [r for r in out if r[4] == seq], [r for r in out if r[4] != seq]
        out[:] = open_
        return [flush(full)] if full else []

    def fill(block):
        keys, docs = zip(*block)
        index, used, nxt = Block(docs, idf, mean), np.zeros(len(docs), bool), 0
        carry = seed = score = None
        while True:
            if carry is not None:  # whole windows of a cut document, then it seeds the last one
                doc, ids, a, i = carry
                a = add(doc, ids, a)
                if a < len(ids):
                    carry = (doc, ids, a, i)
                    continue
                carry, seed, score = None, i, None
            if state["used"] == 0:
                seed = None
            pick = None
            if seed is not None:
                if score is None:
                    score = np.where(used, 0, index.scores(seed))
                best = int(score.argmax())  # of ties the first in block order
                if score[best] > 0:
                    pick = best
                    score[pick] = 0
            if pick is None:
                while nxt < len(docs) and used[nxt]:
                    nxt += 1
                if nxt == len(docs):
                    break
                pick = nxt
                if seed is None:
                    seed, score = pick, None
            used[pick] = True
            a = add(keys[pick], docs[pick])
            if a < len(docs[pick]):
                carry = (keys[pick], docs[pick], a, pick)

    block, size = [], 0
    for batch in batches:
        for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.frombuffer(raw.as_py(), dtype)
            block.append((doc, ids))
            size += len(ids)
            if size >= BLOCK_TOKENS or len(block) >= BLOCK_DOCS:
                fill(block)
                yield from done()
                block, size = [], 0
    if block:
        fill(block)
        yield from done()
    if out:  # the task's last ids: sequences of a power of two each
        yield flush(_powers_of_two(out, seq0 + state["seq"]))


def with_salts(keyed: DataFrame) -> DataFrame:
    """Adds ``salt`` to rows ``(doc_id, term, second, third, sig, row)``: 0 for
    terms of at most ``KEY_ROWS`` rows. Each step splits only the keys that the
    step before left too large; there are at most rows / ``KEY_ROWS`` of them."""
    out, most = keyed.withColumn("salt", F.lit(0).cast("long")), KEY_ROWS
    for by in (["second"], ["third"], ["sig"], ["doc_id", "row"]):
        large = materialize(out.groupBy("term", "salt").agg(F.count(F.lit(1)).alias("rows"))
                            .where(F.col("rows") > most), "large-keys")
        if large.isEmpty():
            break
        large = broadcast_if_small(large, MAX_BROADCAST)
        part = F.pmod(F.xxhash64(*by), F.ceil(F.col("rows") / KEY_ROWS))
        out = out.join(large, ["term", "salt"], "left") \
            .withColumn("salt", F.when(F.col("rows").isNull(), F.col("salt")).otherwise(F.xxhash64("salt", part))) \
            .select(*keyed.columns, "salt")
        most = 2 * KEY_ROWS  # a hash fills its keys unevenly
    return out


def _powers_of_two(pieces: list, seq: int) -> list:
    """Deal the pieces of an unfilled window out to sequences of 2^k ids each, the longest first."""
    total = sum(r[2] for r in pieces)
    sizes = [1 << k for k in reversed(range(total.bit_length())) if total >> k & 1]
    out, left, at = [], sizes.pop(0), 0
    for doc, start, length, doc_tokens, _, _, ids in pieces:
        a = 0
        while a < length:
            take = min(left - at, length - a)
            out.append((doc, start + a, take, doc_tokens, seq, at, ids[a:a + take]))
            a, at = a + take, at + take
            if at == left and sizes:
                left, at, seq = sizes.pop(0), 0, seq + 1
    return out


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text", cached_pieces: int = CACHED_PIECES) -> DataFrame:
    """Pieces ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``:
    ``ids`` are little-endian unsigned 32-bit integers, each id of each document
    in exactly one piece, offsets gapless within a sequence of at most ``window``
    ids. Null text is empty (one piece with the end id). Null and repeated ids
    and repeated rows are packed as rows of their own. An empty table gives no
    piece. Other columns are not read. ``cached_pieces`` is memory of a task against time.
    """
    table = encode_table(docs, tokenizer_path, end_id, id_col, text_col, cached_pieces)
    dtype = id_dtype(read_spec(tokenizer_path), end_id)
    n, mean, df = term_counts(table, dtype)
    stats = docs.sparkSession.sparkContext.broadcast((idf_table(n, df), mean))  # bounded by the vocabulary

    def heaviest(batches):
        import numpy as np
        import pyarrow as pa

        idf, mean = stats.value
        for batch in batches:
            top = np.concatenate([np.zeros((len(TOP), 0), np.int32)] + [
                top_terms([np.frombuffer(raw.as_buffer(), dtype) for raw in batch.column(1).slice(i, ROWS_AT_ONCE)], idf, mean)
                for i in range(0, batch.num_rows, ROWS_AT_ONCE)], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, top)], names=KEYED.names)

    keyed = materialize(table.mapInArrow(tidy(heaviest), KEYED).withColumn("sig", F.xxhash64("ids"))
                        .withColumn("row", F.monotonically_increasing_id()), "keyed")
    discard(table)  # ids are held once on disk
    shards = with_salts(keyed).repartition("term", "salt").sortWithinPartitions("term", "salt", "second", "third", "doc_id",
                                                                               "ids")
    return shards.select("doc_id", "ids").mapInArrow(
        lambda batches: pack_task(batches, dtype, *stats.value, window), PIECES)
