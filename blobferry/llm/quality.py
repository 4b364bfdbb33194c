"""Document quality by hierarchical empirical Bayes.

A document classifier (logistic regression on hashed words and shape
features) gives each document log-odds. Host and path rates are means of
those probabilities by grouped aggregation over all documents, each shrunk to
its parent (path to host, host to global). How strongly follows from the data:
the between-group variance by the method of moments, so sparse sites stay near
the global prior. A document's posterior is its classifier evidence under its
path's prior, its own share left out of that prior.

The classifier is fitted on a bounded sample of labelled rows (``SAMPLE``,
taken by a hash of the id); everything else covers all rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from blobferry.llm.common import broadcast_if_small, fresh_name, materialize

BUCKETS = 1 << 18
SHAPES = 8
SAMPLE = 20_000
STEPS = 300
L2 = 0.1
SIGNIFICANT, MIN_DOCS = 4.5, 5
MAX_GROUPS = 200_000  # priors joined by broadcast up to this count, else shuffled
_STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def features(text):
    """(buckets of distinct words, shape values) of a whole text."""
    import numpy as np

    t = text or ""
    ws = t.split()
    n, m = max(1, len(t)), max(1, len(ws))
    distinct = Counter(ws)
    bare = {w.strip(_STRIP) for w in {w.lower() for w in distinct}}
    bare.discard("")
    ids = np.unique(np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in bare), np.int64, len(bare)))
    lines = t.split("\n")
    letters = sum(c * (len(w) if w.isalpha() else sum(map(str.isalpha, w))) for w, c in distinct.items())
    marks = sum(t.count(c) for c in "|%$#*&!{}<>")
    shape = [math.log1p(len(ws)) / 10, letters / n, marks / n * 5, len(distinct) / m,
             len(set(lines)) / max(1, len(lines)), t.count("|") / m * 5, sum(w.isupper() for w in distinct) / max(1, len(distinct)),
             len(t) / m / 20]
    return ids, np.minimum(shape, 3.0)


class Classifier:
    """Logistic regression over hashed words, shapes and an intercept, per target."""

    def __init__(self, weights: dict):
        self.weights = weights  # target -> (word weights, shape weights, intercept)

    def log_odds(self, text, target: str) -> float:
        return self.log_odds_of(features(text), target)

    def log_odds_of(self, f, target: str) -> float:
        w, s, b = self.weights[target]
        ids, shape = f
        return float(w[ids].sum() + shape @ s + b)


def fit_logistic(rows: list, y) -> tuple:
    """Weights by Adam on all ``rows`` at once, with an L2 penalty. Only words whose
    share of documents differs between the classes beyond chance have a weight:
    most words of a vocabulary are rare and would be learned by heart."""
    import numpy as np

    if len(rows) == 0 or y.min() == y.max():  # one class only: its smoothed rate for everyone
        p = (y.sum() + 0.5) / (len(rows) + 1)
        return np.zeros(BUCKETS, np.float32), np.zeros(SHAPES), math.log(p / (1 - p))
    n = np.array([len(i) for i, _ in rows])
    ids, doc = np.concatenate([i for i, _ in rows]), np.repeat(np.arange(len(rows)), n)
    n1, n0 = y.sum(), len(y) - y.sum()
    in1 = np.bincount(ids, y[doc], BUCKETS)
    df = np.bincount(ids, minlength=BUCKETS)
    share = df / len(y)
    gap = in1 / n1 - (df - in1) / n0
    z = np.abs(gap) / np.sqrt(np.maximum(share * (1 - share) * (1 / n1 + 1 / n0), 1e-12))
    used = np.flatnonzero((z >= SIGNIFICANT) & (df >= MIN_DOCS))
    number = np.full(BUCKETS, -1)
    number[used] = np.arange(len(used))
    keep = number[ids] >= 0
    at, doc = number[ids[keep]], doc[keep]
    shape = np.stack([s for _, s in rows])
    mean, spread = shape.mean(axis=0), shape.std(axis=0) + 1e-6
    shape = (shape - mean) / spread
    w = np.zeros(len(used) + SHAPES + 1)
    w[-1] = math.log(n1 / n0)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        f = np.bincount(doc, w[at], len(rows)) + shape @ w[len(used):-1] + w[-1]
        e = (1 / (1 + np.exp(-np.clip(f, -30, 30))) - y) / len(rows)
        g = np.r_[np.bincount(at, e[doc], len(used)), shape.T @ e, e.sum()]
        g[:-1] += L2 / len(rows) * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    word = np.zeros(BUCKETS, np.float32)
    word[used] = w[:len(used)]
    s = w[len(used):-1] / spread
    return word, s, float(w[-1] - mean @ s)


def train(docs: DataFrame, labels: DataFrame, targets=("quality", "toxic"), id_col="doc_id", text_col="text",
          sample: int = SAMPLE) -> Classifier:
    """Fit on at most ``sample`` labelled rows (those with the smallest hash of
    the id; null ids and null labels are not used; an id labelled twice counts twice)."""
    import numpy as np

    picked = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), *targets) \
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")

    def extract(batches):
        import pyarrow as pa

        for batch in batches:
            t = pa.Table.from_batches([batch])
            f = [features(x.as_py()) for x in batch.column(batch.schema.get_field_index("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.astype("<i4").tobytes() for i, _ in f], pa.binary()),
                 pa.array([s.tolist() for _, s in f], pa.list_(pa.float64())),
                 *[t.column(x).combine_chunks().cast(pa.float64()) for x in targets]], names=["ids", "shape", *targets])

    schema = "ids binary, shape array<double>, " + ", ".join(f"{t} double" for t in targets)
    got = rows.select("text", *targets).mapInArrow(extract, schema).toPandas()
    out = {}
    for t in targets:
        use = got[got[t].notna()]
        out[t] = fit_logistic([(np.frombuffer(i, "<i4"), np.asarray(s)) for i, s in zip(use["ids"], use["shape"])],
                              use[t].to_numpy(float))
    return Classifier(out)


def _strength(groups: DataFrame, rate: float, s: str, parent: tuple[str, str] | None = None) -> float:
    """Rows the parent counts for: from the variance of group means around their parent's rate beyond sampling noise.

    ``parent`` names the columns of the parent's rows and sum (paths: their host's), and groups are
    compared within their parent; None: the parent is all rows, of ``rate``.

    With m the parent's mean and n rows in the group, the sum of n (mean - m)^2 is, by the method of
    moments, (groups - parents) noise + (n - sum n^2 / n of the parent) between, summed over parents.
    """
    if parent:
        of_parent, m = F.col(parent[0]), F.col(parent[1]) / F.col(parent[0])
    else:
        of_parent, m = F.lit(float(groups.agg(F.sum("n")).first()[0] or 0)), F.lit(rate)
    share = F.col("n") / F.when(of_parent > 0, of_parent)
    noise_of = F.greatest(m * (1 - m), F.lit(1e-6))
    r = groups.agg(F.sum(F.col("n") * F.pow(F.col(s) / F.col("n") - m, 2)).alias("ss"),
                 F.sum((1 - share) * noise_of).alias("sampling"), F.sum(F.col("n") * (1 - share)).alias("spread"),
                 F.sum(F.col("n") * noise_of).alias("noise"), F.sum("n").alias("n")).first()
    if not r["n"] or not r["spread"] or r["spread"] <= 0:
        return 1e4
    between = (r["ss"] - r["sampling"]) / r["spread"]
    noise = r["noise"] / r["n"]
    return min(max(noise / between - 1, 1.0), 1e4) if between > 0 else 1e4


def posterior(docs: DataFrame, model: Classifier, targets=("quality", "toxic"), text_col: str = "text",
              host_col: str | None = None, path_col: str | None = None, keep: list | None = None) -> DataFrame:
    """All columns of ``docs``, or those of ``keep``, plus ``p_<target>`` for each target (underscores in
    front where such a column exists).

    Each text is scored once: the log-odds are written beside the columns returned, so a
    caller that needs no texts back leaves them out of ``keep``.

    Null and empty texts have the shape features of an empty text. A null host
    has the global prior; a null path the host's. Groups of one document have
    no evidence but their parent's. Repeated rows count as documents. Empty
    table: no row.
    """
    bc = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def evidence(texts: pd.Series) -> pd.Series:
        c = bc.value
        return pd.Series([[c.log_odds_of(f, t) for t in targets] for f in map(features, texts)])

    z, hk, gr = (fresh_name(docs.columns, n) for n in ("log_odds", "group_key", "group_sums"))
    host = (F.col(host_col) if host_col else F.lit(None)).cast("string")
    path = (F.col(path_col) if path_col else F.lit(None)).cast("string")
    names = docs.columns if keep is None else list(keep)
    at_host, at_path = (fresh_name(docs.columns, n) for n in ("at_host", "at_path"))
    scored = materialize(docs.select(*[F.col(f"`{c}`") for c in names], host.alias(at_host), path.alias(at_path),
                                     evidence(F.col(text_col)).alias(z)), "quality-scores")
    host, path = F.col(at_host), F.col(at_path)
    prob = lambda c: 1 / (1 + F.exp(-c))
    sums = [F.sum(prob(F.col(z)[i])).alias(f"s{i}") for i in range(len(targets))]
    paths = materialize(scored.select(host.alias("host"), path.alias("path"), z).groupBy("host", "path")
                        .agg(F.count(F.lit(1)).alias("n"), *sums), "path-sums")
    again = [F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(targets))]]
    hosts = materialize(paths.groupBy("host").agg(*again), "host-sums")
    total = hosts.agg(*again).first()
    n_all = total["n"] or 0
    rates, k_host, k_path = [], [], []
    # Paths beside their host's sums: the spread of paths is the one around their host.
    above = hosts.select(F.col("host").alias("h_up"), F.col("n").alias("n_up"), *[F.col(f"s{i}").alias(f"s{i}_up") for i in range(len(targets))])
    within = materialize(paths.join(above, paths["host"].eqNullSafe(F.col("h_up"))), "paths-in-hosts")
    for i in range(len(targets)):
        rate = min(max(((total[f"s{i}"] or 0.0) + 0.5) / (n_all + 1), 1e-4), 1 - 1e-4)
        rates.append(rate)
        k_host.append(_strength(hosts.where("host is not null"), rate, f"s{i}"))
        k_path.append(_strength(within.where("path is not null"), rate, f"s{i}", ("n_up", f"s{i}_up")))
    key = lambda h, p: F.to_json(F.struct(h.alias("h"), p.alias("p")))
    up = hosts.select(F.col("host").alias("h2"), F.struct("n", *[f"s{i}" for i in range(len(targets))]).alias("hs"))
    joined = paths.join(up, paths["host"].eqNullSafe(F.col("h2"))).select(
        key(F.col("host"), F.col("path")).alias(hk),
        F.struct(F.col("host").isNotNull().alias("has_host"), F.col("path").isNotNull().alias("has_path"), "hs",
                 F.struct("n", *[f"s{i}" for i in range(len(targets))]).alias("ps")).alias(gr))
    joined = materialize(joined, "group-priors")
    out = scored.withColumn(hk, key(host, path)).join(broadcast_if_small(joined, MAX_GROUPS), hk, "left")
    cols = {}
    for i, t in enumerate(targets):
        own, g = prob(F.col(z)[i]), F.col(gr)
        rest = lambda s, i=i, own=own: F.greatest(s[f"s{i}"] - own, F.lit(0.0))
        level = F.lit(rates[i])
        for has, s, k in (("has_host", "hs", k_host[i]), ("has_path", "ps", k_path[i])):
            level = F.when(g[has], (rest(g[s]) + level * k) / (g[s]["n"] - 1 + k)).otherwise(level)
        level = F.least(F.greatest(level, F.lit(1e-6)), F.lit(1 - 1e-6))
        shift = F.log(level / (1 - level)) - math.log(rates[i] / (1 - rates[i]))
        cols[fresh_name(docs.columns, f"p_{t}")] = prob(F.col(z)[i] + shift)
    return out.withColumns(cols).select(*[F.col(f"`{c}`") for c in names], *cols)


def judge(docs: DataFrame, model: Classifier, text_col="text", host_col=None, path_col=None,
          min_quality: float = 0.5, max_toxic: float = 0.5, keep: list | None = None) -> DataFrame:
    """``posterior`` plus ``kept``: good enough and not toxic."""
    out = posterior(docs, model, ("quality", "toxic"), text_col, host_col, path_col, keep)
    q, t = out.columns[-2:]
    keep: Column = (F.col(q) >= min_quality) & (F.col(t) < max_toxic)
    return out.withColumn(fresh_name(out.columns, "kept"), keep)
