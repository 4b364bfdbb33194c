"""Near-duplicate vectors by lattice hashing on E8.

A table projects a vector to ``blocks`` times 8 dimensions (random
orthonormal rows, scaled) and decodes each part to its nearest E8 lattice
point; the points make a cell. Each vector lies in its own cell and also
visits the neighbouring cells nearest to it. Vectors that meet in a cell
(at least one of them at home) are compared by cosine in double precision.

Equal vectors become one class first. Only cells where something can meet
are looked at; a crowded cell is cut into blocks by a hash of the class, and
pairs of blocks are compared as matrix products in tasks of their own. A pair
counts only in the first table and cell where it meets, which the task knows
from the vectors themselves, so no list of pairs is ever made: a task gives
back link counts per class and a spanning forest of the links it found.
"""

from __future__ import annotations

from itertools import combinations, product

from pyspark.sql import DataFrame, functions as F, types as T

from blobferry.llm.common import by_group, list_column, materialize
from blobferry.llm.components import components

TABLES = 6
BLOCKS = 2
SCALE = 4.0  # of a projected unit vector of 64 dimensions, against a shortest lattice vector of 2 ** 0.5
VISITS = 1  # further cells per lattice part; a vector visits (1 + VISITS)^blocks - 1 of them
CROWD = 512
SEED = 8


def _roots():
    """The 240 shortest vectors of E8: the steps to the neighbouring cells."""
    import numpy as np

    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def decode_e8(x):
    """Nearest E8 point of each row: the better of the nearest points of D8 and of D8 + 1/2."""
    import numpy as np

    def d8(y):
        f = np.rint(y)
        rest = y - f
        odd = np.flatnonzero(f.sum(axis=1) % 2)
        k = np.abs(rest[odd]).argmax(axis=1)  # the coordinate nearest to rounding the other way
        f[odd, k] += np.where(rest[odd, k] >= 0, 1.0, -1.0)
        return f

    a, b = d8(x), d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


class Hasher:
    """Cell numbers of unit vectors in every table; the same on every executor."""

    def __init__(self, dim: int, tables=TABLES, blocks=BLOCKS, scale=SCALE, visits=VISITS, seed=SEED):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.tables, self.blocks, self.visits, self.dim = tables, blocks, visits, dim
        self.proj = []
        for _ in range(tables * blocks):
            g = rng.normal(size=(dim, 8))
            q = np.linalg.qr(g)[0] if dim >= 8 else g / np.linalg.norm(g, axis=0).clip(1e-12) / (8 / dim) ** 0.5
            self.proj.append(q * scale * (dim / 64) ** 0.5)  # the share of a distance that 8 of ``dim`` dimensions see
        self.mult = rng.integers(1, 1 << 62, size=(tables, blocks, 8), dtype=np.int64) * 2 + 1
        self.roots = _roots()

    def cells(self, x):
        """(rows, tables, 1 + visited) cell numbers; entry 0 is the own cell."""
        import numpy as np

        out = []
        for t in range(self.tables):
            parts = []
            for b in range(self.blocks):
                y = x @ self.proj[t * self.blocks + b]
                p = decode_e8(y)
                points = [p]
                if self.visits:
                    near = np.argsort(-((y - p) @ self.roots.T), axis=1, kind="stable")[:, :self.visits]
                    points += [p + self.roots[near[:, i]] for i in range(self.visits)]
                # twice a lattice point is integral; a sum of products mod 2^64 numbers it
                parts.append(np.stack([(np.rint(2 * q).astype(np.int64) * self.mult[t, b]).sum(axis=1)
                                       for q in points], axis=1))
            c = parts[0]
            for p in parts[1:]:
                c = (c[:, :, None] * 31 + p[:, None, :]).reshape(len(x), -1)
            out.append(c)
        return np.stack(out, axis=1)


def unit_rows(values, offsets):
    """Unit vectors from list offsets (all of one length), in double precision."""
    import numpy as np

    x = values[offsets[0]:offsets[-1]].astype(np.float64).reshape(len(offsets) - 1, -1)
    x = x / np.abs(x).max(axis=1)[:, None]  # squares of tiny or huge components stay finite
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


CELL = "cid long, dim int, tbl int, cell long, home boolean"
FOUND = "a long, b long, n long"


def _cells(batches, conf: dict):
    import numpy as np
    import pyarrow as pa

    hashers: dict = {}
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if not t.num_rows:
            continue
        values, off = list_column(t, "v")
        dims, label, cid = np.diff(off), t.column("label_key").to_numpy(), t.column("cid").to_numpy()
        for dim in np.unique(dims):  # vectors of different lengths never meet
            rows = np.flatnonzero(dims == dim)
            h = hashers.setdefault(int(dim), Hasher(int(dim), **conf))
            take = (off[rows][:, None] + np.arange(dim)).ravel()
            c = h.cells(unit_rows(values[take], np.arange(0, len(take) + 1, dim)))
            c = c * 1_000_003 + label[rows][:, None, None]
            n, tables, probes = c.shape
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(cid[rows], tables * probes)), pa.array(np.full(n * tables * probes, dim, np.int32)),
                 pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), probes), n)),
                 pa.array(c.ravel()), pa.array(np.tile(np.arange(probes) == 0, n * tables))],
                names=["cid", "dim", "tbl", "cell", "home"])


class _Forest:
    """Union-find over the rows of one group; remembers which links joined something."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def _compare(batches, conf: dict, threshold: float):
    """Verified links of each (cell, pair of blocks): counts per class (b null) and forest links (n null)."""
    import numpy as np
    import pyarrow as pa

    hashers: dict = {}
    for t, starts, ends in by_group(batches, ["tbl", "dim", "cell", "p", "q"]):
        many = ends - starts > 1
        if not many.any():
            continue
        values, off = list_column(t, "v")
        cols = {c: t.column(c).to_numpy() for c in ("cid", "tbl", "dim", "cell", "p", "q", "blk", "cnt", "label_key")}
        counts, tree = [], []
        for lo, hi in zip(starts[many], ends[many]):
            dim, tbl, cell = int(cols["dim"][lo]), int(cols["tbl"][lo]), cols["cell"][lo]
            h = hashers.setdefault(dim, Hasher(dim, **conf))
            x = unit_rows(values, off[lo:hi + 1])
            cid, blk, cnt = cols["cid"][lo:hi], cols["blk"][lo:hi], cols["cnt"][lo:hi]
            left, right = np.flatnonzero(blk == cols["p"][lo]), np.flatnonzero(blk == cols["q"][lo])
            i, j = np.nonzero(x[left] @ x[right].T >= threshold)
            i, j = left[i], right[j]
            once = cid[i] < cid[j] if cols["p"][lo] == cols["q"][lo] else cid[i] != cid[j]
            i, j = i[once], j[once]
            if not len(i):
                continue
            i, j = np.where(cid[i] < cid[j], i, j), np.where(cid[i] < cid[j], j, i)
            used = np.unique(np.r_[i, j])
            c = h.cells(x[used]) * 1_000_003 + cols["label_key"][lo:hi][used][:, None, None]
            a, b = np.searchsorted(used, i), np.searchsorted(used, j)
            fresh = np.ones(len(i), bool)
            for u in range(tbl + 1):  # where the pair meets in table u: the own cell of its smaller class, else of the other
                at_a = (c[b, u] == c[a, u, :1]).any(axis=1)
                at_b = (c[a, u] == c[b, u, :1]).any(axis=1)
                if u < tbl:
                    fresh &= ~(at_a | at_b)
                else:
                    fresh &= np.where(at_a, c[a, u, 0] == cell, at_b & (c[b, u, 0] == cell))
            i, j = i[fresh], j[fresh]
            n = np.bincount(i, cnt[j], hi - lo) + np.bincount(j, cnt[i], hi - lo)
            for k in np.flatnonzero(n):
                counts.append((int(cid[k]), int(n[k])))
            forest = _Forest(hi - lo)
            for s, e in zip(i.tolist(), j.tolist()):
                if forest.join(s, e):
                    tree.append((int(cid[s]), int(cid[e])))
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in counts] + [x[0] for x in tree], pa.int64()),
                 pa.array([None] * len(counts) + [x[1] for x in tree], pa.int64()),
                 pa.array([x[1] for x in counts] + [None] * len(tree), pa.int64())], names=["a", "b", "n"])


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", conf: dict | None = None) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Vectors link when their labels are equal and not null and their cosine is
    at least ``threshold``. Null vectors, empty and zero vectors, and those
    with null or non-finite components link with nothing: no links, a
    component of their own. So do rows with a null id, whose component is null
    and which are kept. Vectors of different lengths never link. Repeated rows
    are vectors of their own that link with each other. Empty table: no row.
    Other columns are not read. Every link reported is verified; links can be
    missed with the small probability that two vectors share no cell in any
    table (recall is measured in the tests).
    """
    conf = conf or {}
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("v"))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite \
        & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(F.coalesce(ok, F.lit(False)), F.col("v")))
    # a digest of label and components: rows find their class by it, whatever their number
    rows = rows.withColumn("key", F.when(F.col("v").isNotNull(), F.sha2(F.to_json(F.struct("label", F.transform(
        "v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)).alias("v"))), 256)))
    rows = materialize(rows, "vectors")
    classes = materialize(rows.where("key is not null").groupBy("key")
                          .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("cnt"),
                               F.first("v").alias("v"), F.xxhash64(F.first("label")).alias("label_key"))
                          .withColumn("cid", F.monotonically_increasing_id()), "classes")  # numbered as written
    cells = classes.select("cid", "label_key", "v").mapInArrow(lambda b: _cells(b, conf), CELL)
    cells = materialize(cells, "cells")
    where = ["tbl", "dim", "cell"]
    crowd = cells.groupBy(*where).agg(F.count(F.lit(1)).alias("m"), F.max("home").alias("home")) \
        .where("m > 1 and home").select(*where, "m")
    live = cells.select("cid", *where).join(materialize(crowd, "crowds"), where)
    n_blk = F.ceil(F.col("m") / CROWD).cast("int")
    live = live.withColumn("blk", F.pmod(F.xxhash64("cid"), n_blk).cast("int")) \
        .withColumn("o", F.explode(F.sequence(F.lit(0), n_blk - 1))) \
        .select("cid", *where, "blk", F.least("blk", "o").alias("p"), F.greatest("blk", "o").alias("q"))
    live = materialize(live, "meetings").join(classes.select("cid", "v", "cnt", "label_key"), "cid")
    group = [*where, "p", "q"]
    found = materialize(live.repartition(*group).sortWithinPartitions(*group, "cid")
                        .mapInArrow(lambda b: _compare(b, conf, threshold), FOUND), "found")
    n = found.where("n is not null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    comp = components(found.where("b is not null")).select(F.col("node").alias("cid"), "root")
    named = classes.select("cid", "key", "least", "cnt").join(comp, "cid", "left").join(n, "cid", "left")
    named = materialize(named.select("key", "least", F.coalesce("root", "cid").alias("root"),
                                     (F.coalesce("n", F.lit(0)) + F.col("cnt") - 1).alias("n_links")), "named")
    least = materialize(named.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = materialize(named.join(least, "root").select("key", "n_links", "component_id"), "named")
    return rows.select("vec_id", "key").join(named, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))
