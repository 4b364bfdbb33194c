"""SimHash near duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most d bits apart have a common point at most
ceil(d / 2) bits from each. So every distinct fingerprint emits all variants
within half the radius, variants are shuffled, and fingerprints that meet on
one are the candidates; a variant can bring together only the fingerprints of
its own ball (65 for d = 2), whatever the data, so no bucket can be hot. The
pairs are deduplicated and their distance is verified.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from blobferry.llm.common import materialize, tidy
from blobferry.llm.components import components

CHUNK = 1 << 15  # shingle hashes counted at once
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit fingerprint of a whole text, as a signed integer."""
    import numpy as np

    w = (text or "").encode().lower().split()  # on bytes: only A-Z fold, only the six ASCII blanks split
    if not w:
        return 0
    if len(w) < shingle:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(shingle))))
    h = np.fromiter(map(_hash, shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), CHUNK):
        bits = np.unpackbits(h[i:i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def _hash(shingle: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(shingle, SEED)


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, shingle: int, keep=()) -> DataFrame:
    """``(doc_id, fp)`` and the columns ``keep`` for every row."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fp = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64()), *batch.columns[2:]], names=schema.names)

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()),
                           *docs.select(*keep).schema.fields])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    return rows.mapInArrow(tidy(run), schema)


def _masks(radius: int) -> list[int]:
    """All 64-bit masks of at most ``radius`` bits, signed."""
    out = []
    for k in range(radius + 1):
        for bits in combinations(range(64), k):
            m = sum(1 << b for b in bits)
            out.append(m - (1 << 64) if m >= 1 << 63 else m)
    return out


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(a, b)`` with a < b: verified links between distinct fingerprints
    (column ``fp``) that connect every pair at most ``max_bits`` apart.

    With an even ``max_bits`` all of a ball are within it of each other, so
    neighbours in sorted order are enough to connect them; with an odd one the
    halves can meet one bit too far, so a (bounded) ball gives its pairs.
    """
    variants = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in _masks((max_bits + 1) // 2)])).alias("m")) \
        .select(F.col("fp").bitwiseXOR(F.col("m")).alias("v"), F.col("fp").alias("b"))
    if max_bits % 2 == 0:
        pairs = variants.withColumn("a", F.lag("b").over(Window.partitionBy("v").orderBy("b"))) \
            .where("a is not null").select("a", "b")
    else:
        balls = variants.groupBy("v").agg(F.array_sort(F.collect_list("b")).alias("fps")).where(F.size("fps") > 1)
        pairs = balls.select(F.posexplode("fps").alias("i", "a"), "fps") \
            .select("a", F.explode(F.slice("fps", F.col("i") + 2, F.size("fps"))).alias("b"))
    return pairs.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", keep=()) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` and the columns ``keep`` per row. ``fingerprint``: 16 hex
    digits; ``component_id``: the smallest id reachable over links of at most
    ``max_bits`` bits, equal fingerprints included.

    Null and empty texts (and texts of blanks) have fingerprint zero and link
    like any other. A null id links its neighbours but names no component
    unless all of its component are null. Repeated rows stay. Empty table: no
    row. Other columns are not read.
    """
    fp = materialize(with_fingerprint(docs, id_col, text_col, shingle, keep), "fingerprints")
    classes = materialize(fp.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    comp = components(links(classes, max_bits))
    rooted = materialize(classes.join(comp, classes["fp"] == comp["node"], "left")
                         .select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.select("fp", "root").join(materialize(least, "least"), "root")
                        .select("fp", "component_id"), "named")
    return fp.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *keep)
