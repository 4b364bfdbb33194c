"""Merkle manifest of a dataset, with leaf coordinates from ranked bitmaps.

Every row is a leaf, every group of rows a tree of fan 16 over its leaves in
ascending id order, and the groups' tops are the leaves of one last tree.

No row is sorted by id. Each batch of rows gives compressed bitmaps of the ids
it holds, one per group and span of 2^12 ids; the bitmaps of a span are OR-ed
and get a directory of popcounts. Above them a directory of four levels, each
over at most 2^13 entries, gives how many ids lie before a span. So the place
of a leaf is a sum of look-ups: its directory entries, and its rank in the
bitmap. Places are keys: the leaves of 4096 places fill one slot array by key,
and an array is reduced three levels at once to one node of the next array.

Rows with the same group and id (a null id is one, before all others) have
one bit together. Their number shifts what follows; among themselves they
stand in the order of their digests, which is found by prefix counts of
2^16 digest buckets, so that no group of them is ever ordered in one task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window, functions as F

from blobferry.llm.common import binary_array, broadcast_within, by_group, materialize
from blobferry.operators.batching import global_index

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
SLOTS = FAN ** 3  # places of one slot array: three levels
SPAN = 12  # bits of an id that one bitmap resolves
STEP = 13  # bits that one level of the directory resolves; 64 = 12 + 4 * 13
BITS = 1 << SPAN
PROOF_ROWS = 512  # rows of an output batch: a proof has some kilobytes


def digest(columns) -> Column:
    """Hex SHA-256 of the values one after another: ``-`` for null, else UTF-8 bytes, ``:``, value."""
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


# -- bitmaps ------------------------------------------------------------------------------------

def pack_bits(lows):
    """Sorted distinct numbers below ``BITS``: 2 bytes each, or one bit for each possible number if that is shorter."""
    import numpy as np

    if 2 * len(lows) < BITS // 8:
        return lows.astype("<u2").tobytes()
    bits = np.zeros(BITS, np.uint8)
    bits[lows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack_bits(raw: bytes):
    """The sorted numbers of ``pack_bits``."""
    import numpy as np

    if len(raw) < BITS // 8:
        return np.frombuffer(raw, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little"))


def popcounts(raw: bytes) -> bytes:
    """Directory of a bitmap: the set bits before each 64-bit word (nothing for a list of numbers)."""
    import numpy as np

    if len(raw) < BITS // 8:
        return b""
    ones = np.bitwise_count(np.frombuffer(raw, "<u8")).astype(np.int64)
    return (np.cumsum(ones) - ones).astype("<u2").tobytes()


def rank(raw: bytes, directory: bytes, lows):
    """How many numbers of the bitmap lie before each of ``lows``."""
    import numpy as np

    if not directory:
        return np.searchsorted(np.frombuffer(raw, "<u2"), lows)
    words = np.frombuffer(raw, "<u8")[lows >> 6]
    below = words & ((np.uint64(1) << (lows & 63).astype(np.uint64)) - np.uint64(1))
    return np.frombuffer(directory, "<u2")[lows >> 6].astype(np.int64) + np.bitwise_count(below)


def _partials(batches):
    """(gno, span, bits) of the ids of each batch."""
    import numpy as np
    import pyarrow as pa

    from blobferry.llm.common import group_runs

    for b in batches:
        if not b.num_rows:
            continue
        gno, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
        span, low = ids >> SPAN, ids & (BITS - 1)
        order = np.lexsort((low, span, gno))
        key = np.stack([gno[order], span[order]], axis=1)
        low = low[order]
        starts, ends = group_runs(key)
        bits = [pack_bits(np.unique(low[s:e])) for s, e in zip(starts, ends)]
        yield pa.RecordBatch.from_arrays([pa.array(key[starts, 0]), pa.array(key[starts, 1]), pa.array(bits, pa.binary())],
                                         ["gno", "span", "bits"])


def _merged(batches):
    """One bitmap of each span, with its number of ids and its popcount directory."""
    import numpy as np
    import pyarrow as pa

    for t, starts, ends in by_group(batches, ["gno", "span"]):
        raws = t.column("bits").to_pylist()
        rows = []
        for s, e in zip(starts, ends):
            raw = raws[s]
            if e - s > 1:
                seen = np.zeros(BITS, bool)
                for r in raws[s:e]:
                    seen[unpack_bits(r)] = True
                raw = pack_bits(np.flatnonzero(seen))
            rows.append((len(unpack_bits(raw)), raw, popcounts(raw)))
        n, bits, directory = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [t.column("gno").take(starts).combine_chunks(), t.column("span").take(starts).combine_chunks(), pa.array(n, pa.int64()),
             pa.array(bits, pa.binary()), pa.array(directory, pa.binary())], ["gno", "span", "n", "bits", "directory"])


def bitmaps(ids: DataFrame) -> DataFrame:
    """``gno, span, n, bits, directory`` of the distinct non-null ids of ``ids`` (columns ``gno, id``)."""
    parts = ids.where("id is not null").select("gno", "id").mapInArrow(_partials, "gno long, span long, bits binary")
    return parts.repartition("gno", "span").sortWithinPartitions("gno", "span").mapInArrow(
        _merged, "gno long, span long, n long, bits binary, directory binary")


def first_places(spans: DataFrame) -> DataFrame:
    """``gno, span, base``: the sum of ``n`` of all earlier spans of the same ``gno``. Every window
    holds the entries below one entry of the next level, at most ``2 ** STEP``."""
    levels = [spans.select("gno", F.col("span").alias("key"), "n")]
    for _ in range(3):
        levels.append(levels[-1].groupBy("gno", F.shiftright("key", STEP).alias("key")).agg(F.sum("n").alias("n")))
    upper = None
    for t in reversed(levels):
        below = ["gno"] if upper is None else ["gno", F.shiftright("key", STEP)]
        over = Window.partitionBy(*below).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        t = t.select("gno", "key", F.shiftright("key", STEP).alias("up"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
        if upper is not None:
            u = upper.select(F.col("gno").alias("u_gno"), F.col("key").alias("u_key"), F.col("base").alias("u_base"))
            t = t.join(u, (F.col("gno") == F.col("u_gno")) & (F.col("up") == F.col("u_key"))) \
                .withColumn("base", F.col("base") + F.col("u_base"))
        upper = t.select("gno", "key", "base")
    return upper.withColumnRenamed("key", "span")


def _ranked(batches):
    """Places of points; in each span its bitmap comes first, then the points, in any number of batches."""
    import numpy as np
    import pyarrow as pa

    from blobferry.llm.common import group_runs

    held = None
    for b in batches:
        if not b.num_rows:
            continue
        point = b.column("point").to_numpy()
        key = np.stack([b.column("gno").to_numpy(), b.column("span").to_numpy(), point], axis=1)
        low = b.column("id").fill_null(0).to_numpy() & (BITS - 1)
        place = np.zeros(b.num_rows, np.int64)
        for s, e in zip(*group_runs(key)):
            if not point[s]:
                row = b.slice(s, 1)
                held = (row.column("base")[0].as_py(), row.column("bits")[0].as_py(), row.column("directory")[0].as_py(),
                        np.array(row.column("tied")[0].as_py() or [], np.int64),
                        np.r_[0, np.cumsum(np.array(row.column("extra")[0].as_py() or [], np.int64))])
            else:
                base, bits, directory, tied, extra = held
                x = low[s:e]
                place[s:e] = base + rank(bits, directory, x) + extra[np.searchsorted(tied, x)]
        keep = pa.array(point == 1)
        t = pa.RecordBatch.from_arrays([b.column("gno"), pa.array(place)] + [b.column(c) for c in ("size", "id", "leaf", "claim")],
                                       ["gno", "place", "size", "id", "leaf", "claim"]).filter(keep)
        if t.num_rows:
            yield t


def _places(points: DataFrame, spans: DataFrame) -> DataFrame:
    """``points`` (``gno, size, id, leaf, claim``, no null id) with ``place``, by rank queries to ``spans``."""
    null = {"id": "long", "size": "long", "leaf": "binary", "claim": "binary", "base": "long", "bits": "binary",
            "directory": "binary", "tied": "array<long>", "extra": "array<long>"}
    order = ["gno", "span", "point", *null]

    def padded(df):
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(null[c]).alias(c) for c in order])

    both = padded(spans.withColumn("point", F.lit(0))).unionAll(
        padded(points.withColumn("span", F.shiftright("id", SPAN)).withColumn("point", F.lit(1))))
    return both.repartition("gno", "span").sortWithinPartitions("gno", "span", "point").mapInArrow(
        _ranked, "gno long, place long, size long, id long, leaf binary, claim binary")


def coordinates(rows: DataFrame) -> DataFrame:
    """``gno, place, size, id, leaf, claim`` of the written table ``rows`` (the same without ``place``): the place of
    a row is the number of rows of its ``gno`` with a smaller id (null first), or the same id and a smaller digest."""
    spans = materialize(bitmaps(rows), "merkle-bitmaps")
    n_rows = rows.count()
    n_ids = spans.agg(F.sum("n")).first()[0] or 0
    if n_ids == n_rows:  # every row has a bit of its own
        spans = spans.join(first_places(spans), ["gno", "span"]).withColumn("tied", F.lit(None).cast("array<long>")) \
            .withColumn("extra", F.lit(None).cast("array<long>"))
        return _places(rows, spans)
    key = ["gno", "id"]
    leaves = materialize(rows.groupBy("gno", "size", "id", "leaf", "claim").agg(F.count(F.lit(1)).alias("copies")), "merkle-leaves")
    ties = materialize(leaves.groupBy(*key).agg(F.sum("copies").alias("n")).where("n > 1 or id is null"), "merkle-ties")
    same = (F.col("l.gno") == F.col("t.gno")) & F.col("l.id").eqNullSafe(F.col("t.id"))
    few = broadcast_within(ties.select(*key))
    single = leaves.alias("l").join(few.alias("t"), same, "left_anti")
    tied = materialize(leaves.alias("l").join(few.alias("t"), same, "left_semi")
                       .withColumn("bucket", F.conv(F.substring(F.hex("leaf"), 1, 4), 16, 10).cast("int")), "merkle-tied")
    # order among rows of one id: earlier buckets, then earlier digests of the same bucket, then copies
    before = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = tied.groupBy(*key, "bucket").agg(F.sum("copies").alias("n")) \
        .withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).select(*key, "bucket", "ahead")
    inside = Window.partitionBy(*key, "bucket").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    tied = tied.withColumn("nth", F.coalesce(F.sum("copies").over(inside), F.lit(0))).alias("l").join(
        buckets.alias("t"), same & (F.col("l.bucket") == F.col("t.bucket"))) \
        .select("l.gno", "l.size", "l.id", "l.leaf", "l.claim", "l.copies", (F.col("nth") + F.col("ahead")).alias("nth"))
    # what ties shift: the rest of their own bitmap, and through its n all later ones; null ids shift everything
    extra = ties.where("id is not null").groupBy("gno", F.shiftright("id", SPAN).alias("span")).agg(
        F.array_sort(F.collect_list(F.struct((F.col("id").bitwiseAND(BITS - 1)).alias("low"), (F.col("n") - 1).alias("more")))).alias("x"))
    nulls = ties.where("id is null").select("gno", F.col("n").alias("nulls"))
    spans = spans.join(extra, ["gno", "span"], "left").withColumn("tied", F.col("x.low")).withColumn("extra", F.col("x.more"))
    spans = materialize(spans.withColumn("n", F.col("n") + F.coalesce(F.aggregate("extra", F.lit(0).cast("long"), lambda a, v: a + v),
                                                                     F.lit(0))).drop("x"), "merkle-spans")
    spans = spans.join(first_places(spans), ["gno", "span"]).join(nulls, "gno", "left") \
        .withColumn("base", F.col("base") + F.coalesce("nulls", F.lit(0)))
    points = single.select("gno", "size", "id", "leaf", "claim").unionAll(
        ties.where("id is not null").select("gno", F.lit(None).cast("long").alias("size"), "id",
                                            F.lit(None).cast("binary").alias("leaf"), F.lit(None).cast("binary").alias("claim")))
    placed = materialize(_places(points, spans), "merkle-places")
    firsts = placed.where("leaf is null").select("gno", "id", "place").unionAll(
        nulls.select("gno", F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("place")))
    many = tied.alias("l").join(broadcast_within(materialize(firsts, "merkle-firsts")).alias("t"), same) \
        .select("l.gno", "place", "l.size", "l.id", "leaf", "claim", "nth", "copies") \
        .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return placed.where("leaf is not null").select("gno", "place", "size", "id", "leaf", "claim").unionAll(
        many.select("gno", F.col("place") + F.col("nth") + F.col("k"), "size", "id", "leaf", "claim"))


# -- slot arrays --------------------------------------------------------------------------------

def reduce_slots(text: bytes, size: int) -> list[bytes]:
    """Levels of a slot array, each the hex digests of its nodes on end: the first as given, the last one node.
    ``size`` is the number of nodes of the whole level that the array is a part of."""
    levels = [text]
    while size > 1 and len(levels) < 4:
        text = levels[-1]
        levels.append(b"".join(hashlib.sha256(text[k:k + 64 * FAN]).hexdigest().encode() for k in range(0, len(text), 64 * FAN)))
        size = -(-size // FAN)
    return levels


def _arrays(batches):
    import numpy as np
    import pyarrow as pa

    for t, starts, ends in by_group(batches, ["gno", "block"]):
        place, gno, block = (t.column(c).to_numpy() for c in ("place", "gno", "block"))
        size = t.column("size").to_numpy()
        out = []
        for s, e in zip(starts, ends):
            slot = np.empty(e - s, np.int64)  # row that fills each slot
            slot[place[s:e] - block[s] * SLOTS] = np.arange(s, e)
            part = t.take(slot)
            leaf = b"".join(part.column("leaf").to_pylist())
            claim = part.column("claim").to_pylist()
            changed = [i for i, c in enumerate(claim) if c is not None]
            out.append((int(gno[s]), int(block[s]), int(size[s]), part.column("id").to_pylist(), leaf, changed,
                        b"".join(claim[i] for i in changed), bytes.fromhex(reduce_slots(leaf.hex().encode(), int(size[s]))[-1].decode())))
            if len(out) == 16:
                yield pa.RecordBatch.from_pylist([dict(zip(ARRAY.names, r)) for r in out], ARRAY)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(ARRAY.names, r)) for r in out], ARRAY)


def _array_schema():
    import pyarrow as pa

    return pa.schema([("gno", pa.int64()), ("block", pa.int64()), ("size", pa.int64()), ("ids", pa.list_(pa.int64())),
                      ("leaves", pa.binary()), ("changed", pa.list_(pa.int32())), ("claims", pa.binary()), ("top", pa.binary())])


ARRAY = _array_schema()
ARRAY_SQL = ("gno long, block long, size long, ids array<long>, leaves binary, changed array<int>, claims binary, top binary")


def trees(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """Slot arrays of all trees ``gno``, from the leaves up; in the last table every tree is one array, its ``top``
    the tree's. ``nodes`` holds ``gno, place, size, id, leaf, claim``; ``largest`` is the greatest size."""
    tables = []
    while True:
        keyed = nodes.withColumn("block", F.expr(f"place div {SLOTS}"))
        tables.append(materialize(keyed.repartition("gno", "block").sortWithinPartitions("gno", "block")
                                  .mapInArrow(_arrays, ARRAY_SQL), "merkle-slots"))
        if largest <= SLOTS:
            return tables
        largest = -(-largest // SLOTS)
        nodes = tables[-1].select("gno", F.col("block").alias("place"), F.expr(f"(size + {SLOTS - 1}) div {SLOTS}").alias("size"),
                                  F.lit(None).cast("long").alias("id"), F.col("top").alias("leaf"),
                                  F.lit(None).cast("binary").alias("claim"))


def own_path(levels: list[bytes], i: int, of: int = 0) -> list[tuple]:
    """(left, right) siblings of node ``i`` of level ``of``, and of its ancestors inside the array."""
    path = []
    for text in levels[of:-1]:
        run = i // FAN * FAN
        path.append((text[64 * run:64 * i], text[64 * (i + 1):64 * (run + FAN)]))
        i //= FAN
    return path


def _node_paths(batches):
    """Of every node in the arrays: its path to the root, with the array's own path behind."""
    import pyarrow as pa

    for b in batches:
        for r in b.to_pylist():
            levels = reduce_slots(r["leaves"].hex().encode(), r["size"])
            rest = [(x["l"], x["r"]) for x in r["path"]]
            n = len(r["leaves"]) // 32
            paths = [[{"l": left.decode() if isinstance(left, bytes) else left, "r": right.decode() if isinstance(right, bytes) else right}
                      for left, right in own_path(levels, i) + rest] for i in range(n)]
            for k in range(0, n, PROOF_ROWS):
                part = paths[k:k + PROOF_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["gno"]] * len(part), pa.int64()),
                     pa.array(range(r["block"] * SLOTS + k, r["block"] * SLOTS + k + len(part)), pa.int64()),
                     pa.array(part, pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))),
                     pa.array([r["subroot"]] * len(part), pa.binary()), pa.array([r["root"]] * len(part), pa.binary())],
                    ["gno", "place", "path", "subroot", "root"])


PATH = "array<struct<l:string,r:string>>"


def _proofs(batches):
    """Of every leaf: its proof, and the root folded from its claimed digest and the siblings."""
    import pyarrow as pa

    for b in batches:
        for k in range(b.num_rows):
            r = b.slice(k, 1).to_pylist()[0]
            text = r["leaves"].hex().encode()
            levels = reduce_slots(text, r["size"])
            above = [(x["l"].encode(), x["r"].encode()) for x in r["path"]]
            claims = r["claims"].hex().encode()
            claimed = {i: claims[64 * j:64 * (j + 1)] for j, i in enumerate(r["changed"])}
            n = len(text) // 64
            rows = []
            for i in range(n):
                if i % FAN == 0:  # the leaves of a run share the path of their parent
                    up = (own_path(levels, i // FAN, 1) if len(levels) > 1 else []) + above
                    tail = b"".join(x for pair in up for x in pair)
                own = own_path(levels[:2], i)
                node = claimed.get(i) or text[64 * i:64 * (i + 1)]
                for left, right in own + up:
                    node = hashlib.sha256(left + node + right).hexdigest().encode()
                rows.append((b"".join(x for pair in own for x in pair) + tail, node))
                if len(rows) == PROOF_ROWS or i == n - 1:
                    m, first = len(rows), i + 1 - len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["gno"]] * m, pa.int64()), pa.array(range(r["block"] * SLOTS + first, r["block"] * SLOTS + i + 1), pa.int64()),
                         pa.array(r["ids"][first:i + 1], pa.int64()),
                         pa.array([text[64 * j:64 * (j + 1)].decode() for j in range(first, i + 1)], pa.string()),
                         pa.array([r["subroot"].hex()] * m, pa.string()), pa.array([r["root"].hex()] * m, pa.string()),
                         pa.array([p.decode() for p, _ in rows], pa.string()), pa.array([x.decode() for _, x in rows], pa.string())],
                        ["gno", "place", "id", "leaf", "subroot", "root", "proof", "folded_root"])
                    rows = []


def _down(arrays: DataFrame, paths: DataFrame) -> DataFrame:
    """``arrays`` with the path of each array's top, ``paths`` (``gno, place, path, subroot, root``)."""
    p = broadcast_within(materialize(paths.withColumnRenamed("place", "block"), "merkle-paths"))
    return arrays.join(p, ["gno", "block"])


def manifest(docs: DataFrame, fields=FIELDS, id_col: str = "doc_id", group_col: str = "source",
             claims: dict | None = None, changed: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, place`` (from 0, in its group's tree), ``leaf, subroot, root``
    (hex), ``proof`` (hex digests of all siblings, from the leaf's level to the root, left to right), ``folded_root``
    (the root that follows from the claimed leaf and the proof) and ``verified`` (it is the root).

    ``claims`` replaces fields (by name) in the rows where ``changed`` holds; other rows claim what they hold.
    ``id_col`` is an integer. Groups are ordered by their UTF-8 bytes, the null group first.

    A null in any field is ``-`` in the digest; an empty text has a digest as any other. Null ids come first in
    their group; rows of one id stand in the order of their digests, and rows that are equal in all fields take
    consecutive places. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    claims = claims or {}
    claim = digest([claims.get(c, F.col(c)) for c in fields])
    if changed is not None:
        claim = F.when(changed, claim)
    elif not claims:
        claim = F.lit(None).cast("string")
    rows = materialize(docs.select(F.col(group_col).cast("string").alias("grp"), F.col(id_col).cast("long").alias("id"),
                                   F.unhex(digest(fields)).alias("leaf"), F.unhex(claim).alias("claim")), "merkle-rows")
    groups = materialize(global_index(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("size")), ["grp"], name="gno"), "merkle-groups")
    n_groups, largest = groups.agg(F.count(F.lit(1)), F.max("size")).first()
    known = broadcast_within(groups)
    rows = materialize(rows.join(known, rows["grp"].eqNullSafe(known["grp"])).select("gno", "size", "id", "leaf", "claim"),
                       "merkle-keyed")
    tables = trees(coordinates(rows), largest or 1)
    tops = tables[-1].select(F.lit(0).cast("long").alias("gno"), F.col("gno").alias("place"), F.lit(n_groups).cast("long").alias("size"),
                             F.lit(None).cast("long").alias("id"), F.col("top").alias("leaf"), F.lit(None).cast("binary").alias("claim"))
    above = trees(tops, n_groups)
    here = above[-1].select("gno", F.col("block").alias("place"), F.array().cast(PATH).alias("path"),
                            F.lit(None).cast("binary").alias("subroot"), F.col("top").alias("root"))
    node_schema = f"gno long, place long, path {PATH}, subroot binary, root binary"
    for arrays in reversed(above):
        here = _down(arrays, here).mapInArrow(_node_paths, node_schema)
    # a place in the last tree is the number of a group
    here = here.select(F.col("place").alias("gno"), F.lit(0).cast("long").alias("place"), "path", "root").join(
        tables[-1].select("gno", F.col("top").alias("subroot")), "gno").select("gno", "place", "path", "subroot", "root")
    for arrays in reversed(tables[1:]):
        here = _down(arrays, here).mapInArrow(_node_paths, node_schema)
    out = _down(tables[0], here).mapInArrow(
        _proofs, "gno long, place long, id long, leaf string, subroot string, root string, proof string, folded_root string")
    names = broadcast_within(groups.select("gno", F.col("grp").alias("source")))
    return out.join(names, "gno").select(F.col("id").alias("doc_id"), "source", "place", "leaf", "subroot", "root", "proof",
                                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
