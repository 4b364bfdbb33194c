"""Token ids in binary shard files whose document boundaries are Elias-Fano coded.

Layout of a shard (integers little-endian):

    magic | ids of all its documents | EF(end of each document) | EF(doc ids) | footer | magic

The footer is fixed-size and gives the counts and section lengths. An
Elias-Fano list of n values below U takes n * (2 + log2(U / n)) bits; sampled
select pointers (one 32-bit number per ``SAMPLE`` values) give the i-th offset
without a table of 64-bit offsets. Documents are in ascending ``doc_id`` order
within a shard and across shards, null ids first.

Tasks write shards under names no other attempt uses; only shards named in the
manifest, which Spark's committer writes, count. So lost or speculative tasks
leave at most an unused file.
"""

from __future__ import annotations

import struct
import uuid

from pyspark.sql import DataFrame, functions as F, types as T

from blobferry.llm.common import binary_array, materialize, scratch_path
from blobferry.llm.encoder import encoder, read_spec
from blobferry.sources.objectstore import open_fs

MAGIC = b"EFTOKEN1"
FOOTER = struct.Struct("<8Q q")  # documents, nulls, ids, width, EF ends bytes, EF doc-id bytes, 0, 0, least doc id
SAMPLE = 256
READ_IDS = 1 << 21  # ids per output batch when reading back


class EliasFano:
    """A sorted list of non-negative integers; ``build`` packs, ``get``/``slice`` decode."""

    HEAD = struct.Struct("<4Q")  # n, low bits per value, high bytes, low bytes

    def __init__(self, n, width, high, low, samples):
        self.n, self.width, self.high, self.low, self.samples = n, width, high, low, samples

    @classmethod
    def build(cls, values) -> "EliasFano":
        import numpy as np

        v = np.asarray(values, np.uint64)
        n = len(v)
        if n == 0:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        width = max(0, ((int(v[-1]) + 1) // n).bit_length() - 1)
        ones = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        low = np.zeros((n, width), np.uint8)
        for k in range(width):
            low[:, k] = (v >> np.uint64(k)) & np.uint64(1)
        return cls(n, width, np.packbits(bits, bitorder="little"), np.packbits(low.ravel(), bitorder="little"),
                   ones[::SAMPLE].astype(np.uint32))

    def dump(self) -> bytes:
        return b"".join((self.HEAD.pack(self.n, self.width, len(self.high), len(self.low)),
                         self.high.tobytes(), self.low.tobytes(), self.samples.astype("<u4").tobytes()))

    @classmethod
    def load(cls, raw: bytes) -> "EliasFano":
        import numpy as np

        n, width, nh, nl = cls.HEAD.unpack_from(raw)
        at = cls.HEAD.size
        high = np.frombuffer(raw, np.uint8, nh, at)
        low = np.frombuffer(raw, np.uint8, nl, at + nh)
        return cls(n, width, high, low, np.frombuffer(raw, "<u4", -(-n // SAMPLE), at + nh + nl))

    def slice(self, i: int, j: int):
        """Values i .. j - 1, decoded from the nearest sampled pointer."""
        import numpy as np

        j = min(j, self.n)
        if i >= j:
            return np.zeros(0, np.uint64)
        start = int(self.samples[i // SAMPLE])
        skip, need = i % SAMPLE, i % SAMPLE + j - i
        after = -(-j // SAMPLE)  # the next sampled one bounds the bits to look at
        end = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        first = start // 8
        bits = np.unpackbits(self.high[first:end // 8 + 1], bitorder="little")
        ones = np.flatnonzero(bits[start - 8 * first:])[skip:need] + start
        out = (ones - np.arange(i, j)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            a, b = i * self.width, j * self.width
            low = np.unpackbits(self.low[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a]
            low = low.reshape(-1, self.width)
            for k in range(self.width):
                out |= low[:, k].astype(np.uint64) << np.uint64(k)
        return out

    def get(self, i: int) -> int:
        return int(self.slice(i, i + 1)[0])


class TokenShard:
    """Random access to one shard file: ``doc(i)`` selects two offsets and reads that range."""

    def __init__(self, path: str):
        self.fs, self.path = open_fs(path)
        self.file = self.fs.open_input_file(self.path)
        size = self.file.size()
        tail = FOOTER.size + len(MAGIC)
        raw = self.file.read_at(tail, size - tail)
        if raw[-len(MAGIC):] != MAGIC:
            raise ValueError(f"not a complete token shard: {path}")
        self.n_docs, self.n_nulls, self.n_ids, self.width, n_ends, n_keys, _, _, self.least = FOOTER.unpack_from(raw)
        at = len(MAGIC) + self.n_ids * self.width
        self.ends = EliasFano.load(self.file.read_at(n_ends, at))
        self.keys = EliasFano.load(self.file.read_at(n_keys, at + n_ends))

    def bounds(self, i: int, j: int):
        """Offsets of documents i .. j - 1: j - i + 1 numbers."""
        import numpy as np

        ends = self.ends.slice(i, j).astype(np.int64)
        return np.r_[self.ends.get(i - 1) if i else 0, ends].astype(np.int64)

    def doc_ids(self, i: int, j: int) -> list:
        """Ids of documents i .. j - 1; the nulls come first."""
        nulls = max(0, min(j, self.n_nulls) - i)
        k = self.keys.slice(max(i, self.n_nulls) - self.n_nulls, max(j, self.n_nulls) - self.n_nulls)
        return [None] * nulls + [int(x) + self.least for x in k]

    def ids(self, start: int, end: int):
        import numpy as np

        raw = self.file.read_at((end - start) * self.width, len(MAGIC) + start * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4")

    def doc(self, i: int):
        a, b = self.bounds(i, i + 1)
        return self.ids(int(a), int(b))


MANIFEST = T.StructType([T.StructField(n, t) for n, t in (
    ("part", T.LongType()), ("path", T.StringType()), ("n_docs", T.LongType()), ("n_ids", T.LongType()))])
TOKENS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("start", T.LongType()), ("n_tokens", T.LongType()), ("ids", T.BinaryType()))])


def _write_shard(batches, out_dir: str, spec: str, end_id: int):
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    fs, base = open_fs(out_dir)
    part = TaskContext.get().partitionId()
    enc, width, f, path = None, 0, None, ""
    keys, lengths, nulls = [], [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if f is None:
            enc = encoder(spec)
            width = 2 if enc.width == 2 and end_id < 1 << 16 else 4
            fs.create_dir(base, recursive=True)
            path = f"shard-{part:06d}-{uuid.uuid4().hex}.eft"
            f = fs.open_output_stream(f"{base}/{path}")
            f.write(MAGIC)
        dtype = "<u2" if width == 2 else "<u4"
        end = np.array([end_id], dtype).tobytes()
        ids, texts = batch.column(0), batch.column(1)
        for i in range(0, batch.num_rows, 256):
            rows = enc.encode(texts.slice(i, 256).to_pylist())
            if width != enc.width:
                rows = [np.frombuffer(r, enc.dtype).astype(dtype).tobytes() for r in rows]
            lengths += [len(r) // width + 1 for r in rows]
            f.write(end.join(rows) + end)
        k = ids.drop_null()
        nulls += ids.null_count
        keys.append(k.to_numpy(zero_copy_only=False).astype(np.int64))
    if f is None:
        return
    k = np.concatenate(keys)
    least = int(k[0]) if len(k) else 0
    ends = np.cumsum(np.array(lengths, np.int64))
    e1 = EliasFano.build(ends).dump()
    e2 = EliasFano.build(k.astype(np.uint64) - np.array(least, np.int64).astype(np.uint64)).dump()
    f.write(e1 + e2 + FOOTER.pack(len(lengths), nulls, int(ends[-1]), width, len(e1), len(e2), 0, 0, least) + MAGIC)
    f.close()
    yield pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([f"{out_dir}/{path}"]), pa.array([len(lengths)], pa.int64()),
         pa.array([int(ends[-1])], pa.int64())], names=MANIFEST.names)


def write_tokens(docs: DataFrame, tokenizer_path: str, out_dir: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, write shards below
    ``out_dir`` (a shared folder) and return the written manifest ``(part,
    path, n_docs, n_ids)``, ``part`` in ascending order of ids.

    One range shuffle of the texts; AQE merges small ranges into one shard.
    Null text: empty (only the end id). Null ids come first, repeated ids and
    rows keep one entry per row. An empty table writes no shard. Other columns
    are not read.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    h = F.xxhash64("text")  # splits the rows of a repeated id
    rows = rows.repartitionByRange(F.col("doc_id"), h).sortWithinPartitions(F.col("doc_id"), h, F.col("text"))
    return materialize(rows.mapInArrow(lambda b: _write_shard(b, out_dir, spec.value, end_id), MANIFEST), "manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document, from the shard files:
    ``start`` counts the ids of all documents before it, ``ids`` are
    little-endian unsigned 32-bit integers. The driver sees one count per shard."""
    sizes = {r["part"]: r["n_ids"] for r in manifest.select("part", "n_ids").collect()}  # one row per shard
    before, total = {}, 0
    for p in sorted(sizes):
        before[p], total = total, total + sizes[p]

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard, i = TokenShard(path), 0
                while i < shard.n_docs:
                    j = min(i + 4096, shard.n_docs)
                    b = shard.bounds(i, j)
                    j = i + max(1, int(np.searchsorted(b, b[0] + READ_IDS, "right")) - 1)  # by ids, one document at least
                    b = b[:j - i + 1]
                    n = np.diff(b)
                    ids = shard.ids(int(b[0]), int(b[-1])).astype("<u4")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.doc_ids(i, j), pa.int64()), pa.array(b[:-1] + before[part]), pa.array(n),
                         binary_array(ids.tobytes(), n * 4)], names=TOKENS.names)
                    i = j

    n = max(1, len(sizes))
    return manifest.select("part", "path").repartitionByRange(n, "part").mapInArrow(read, TOKENS)


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, out_dir: str | None = None) -> DataFrame:
    """Write the shards, read them back and return ``(doc_id, start, n_tokens, ids)``."""
    out_dir = out_dir or scratch_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, tokenizer_path, out_dir, end_id))


