"""Language identification by Bayesian evidence fusion.

For each row the log-odds of a language add up:

* text: log-likelihood of its hashed byte trigrams under a model of each
  language, tempered because neighbouring trigrams overlap; a text no model
  explains better than uniform noise goes to "no language";
* declared language (markup attribute or column): how often languages are
  declared so, a smoothed table of declared against text-only language;
* address: a prior per host, shrunk to the prior of its address suffix, which
  is shrunk to the global one. Priors are sums of text posteriors by grouped
  aggregation over all rows, without the row's own share.

Models are counted over all labelled rows: partial counts in the tasks, then
one grouped sum, bounded by ``GRAMS`` times the number of languages.
"""

from __future__ import annotations

import math
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from blobferry.llm.common import broadcast_if_small, fresh_name, materialize, tidy

GRAMS = 1 << 16
MIN_ROWS = 5         # labelled rows a language needs to get a model
MAX_LANGUAGES = 400  # a larger label set is taken for an error and refused
TEMPER = 1 / 3       # trigrams overlap: three of them share a letter
SUFFIX_WEIGHT, HOST_WEIGHT = 50.0, 10.0  # rows the parent prior counts for
NONE_PRIOR = 1e-3
MAX_HOSTS = 200_000  # host priors joined by broadcast up to this count, else shuffled
CHUNK = 1 << 20


def grams(raw: bytes):
    """Hashed byte trigrams of a lower-cased, space-padded text."""
    import numpy as np

    b = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    return (((b[:-2] * 961 + b[1:-1] * 31 + b[2:]) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64) \
        if len(b) > 2 else np.zeros(0, np.int64)


def _bytes(text) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass").strip()


class Model:
    """``langs`` and a (GRAMS, languages) table of log probabilities."""

    def __init__(self, langs: list, counts):
        import numpy as np

        self.langs = langs
        p = counts + 0.1
        self.log = np.log(p / p.sum(axis=0)).astype(np.float32) if len(langs) else np.zeros((GRAMS, 0), np.float32)

    def score(self, text):
        """Tempered log-likelihood of each language, then of noise; zeros without text."""
        import numpy as np

        raw = _bytes(text)
        out = np.zeros(len(self.langs) + 1)
        for i in range(0, len(raw), CHUNK):
            g = grams(raw[i:i + CHUNK])
            out[:-1] += self.log[g].sum(axis=0, dtype=np.float64)
            out[-1] -= len(g) * math.log(GRAMS)
        return out * TEMPER


def train(rows: DataFrame, text_col: str = "text", label_col: str = "lang") -> Model:
    """Models of the labels with at least ``MIN_ROWS`` rows. Null labels are not used."""
    import numpy as np

    labelled = rows.where(F.col(label_col).isNotNull()).select(F.col(label_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = labelled.groupBy("lang").count().where(F.col("count") >= MIN_ROWS)
    langs = sorted(r["lang"] for r in sizes.limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels; are these languages?")
    where = {x: i for i, x in enumerate(langs)}

    def count(batches):
        import pyarrow as pa

        out = np.zeros((len(langs), GRAMS), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                i = where.get(lang)
                if i is not None:
                    raw = _bytes(text.as_py())
                    for k in range(0, len(raw), CHUNK):
                        g = grams(raw[k:k + CHUNK])
                        if len(g) > GRAMS // 8:
                            out[i] += np.bincount(g, minlength=GRAMS)
                        else:
                            np.add.at(out[i], g, 1)
        i, g = np.nonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(g), pa.array(out[i, g])], names=["i", "g", "n"])

    table = np.zeros((GRAMS, len(langs)))
    if langs:
        sums = labelled.mapInArrow(count, "i long, g long, n long").groupBy("i", "g").agg(F.sum("n").alias("n"))
        for r in sums.toLocalIterator():  # GRAMS rows a language at most
            table[r["g"], r["i"]] = r["n"]
    return Model(langs, table)


def _softmax(logs):
    import numpy as np

    e = np.exp(logs - logs.max())
    return e / e.sum()


def declared_in_markup(html: Column) -> Column:
    """Primary subtag of the ``lang`` attribute of the ``html`` element, lower case; null without one.
    The element may be anywhere; comments and scripts are no markup."""
    markup = F.regexp_replace(html, F.lit(r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)"), F.lit(""))
    tag = F.regexp_extract(markup, r"""(?i)<html[^>]*\blang\s*=\s*["']?([a-zA-Z]+)""", 1)
    return F.when(tag != "", F.lower(tag))


def text_of(html: Column) -> Column:
    """Text of a page: no comments, scripts, styles and tags, character references resolved; null stays null."""
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        import html as markup
        import re

        hidden = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)")
        tag = re.compile(r"<[!/?a-zA-Z][^<>]*>")
        return pages.map(lambda p: None if p is None else markup.unescape(tag.sub(" ", hidden.sub(" ", p))))

    return run(html)


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))
    return F.when(host != "", host)


def suffix_of(host: Column) -> Column:
    return F.when(host.contains("."), F.substring_index(host, ".", -1))


def identify(docs: DataFrame, model: Model, text_col: str = "text", declared_col: str | None = None,
             host_col: str | None = None, suffix_col: str | None = None, min_posterior: float = 0.5,
             languages: list | None = None, keep: list | None = None) -> DataFrame:
    """All columns of ``docs``, or those of ``keep``, plus ``language``, ``posterior`` and ``accepted``
    (the last three columns, with underscores in front where such a name exists).

    Where the texts are not among the columns returned, each is scored once and the scores are written
    beside these. Otherwise they are scored for the priors and again with their decision, so that no text is written.

    ``language`` is null where "no language" wins or nothing speaks for any:
    empty and null texts get the evidence of their address and declaration
    only. ``accepted``: a language won with ``min_posterior`` and is in
    ``languages`` (default: any). Null declarations, hosts and suffixes are no
    evidence; a null host gets the prior of its suffix. Without a trained
    language nothing is accepted. Ties go to the language first in
    alphabetical order. Repeated rows get equal results. Empty table: no row.
    """
    langs, k = model.langs, len(model.langs)
    lang_c, post_c, acc_c = (fresh_name(docs.columns, n) for n in ("language", "posterior", "accepted"))
    names = docs.columns if keep is None else list(keep)
    if not k:
        return docs.select(*[F.col(f"`{c}`") for c in names]).withColumns({lang_c: F.lit(None).cast("string"), post_c: F.lit(0.0), acc_c: F.lit(False)})
    bc = docs.sparkSession.sparkContext.broadcast(model)  # bounded: GRAMS x languages

    @F.pandas_udf("struct<ll: array<double>, own: array<double>>")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def scored_batches(batches):
            for part in batches:
                rows = [bc.value.score(t) for t in part]
                yield pd.DataFrame({"ll": rows, "own": [_softmax(r[:-1]) if r.any() else r[:-1] for r in rows]})

        yield from tidy(scored_batches)(texts)

    ll, pr, at_host, at_suffix, said = (fresh_name(docs.columns, n) for n in ("scores", "host_sums", "at_host", "at_suffix", "said"))
    host, suffix, declared = ((F.col(c) if c else F.lit(None)).cast("string") for c in (host_col, suffix_col, declared_col))
    rows = docs.select(*[F.col(f"`{c}`") for c in names], host.alias(at_host), suffix.alias(at_suffix), declared.alias(said),
                       F.col(text_col).alias(ll))
    once = text_col.lower() not in {c.lower() for c in names}
    scored = rows.withColumn(ll, score(F.col(ll)))
    if once:
        scored = rows = materialize(scored, "language-scores")
    host, suffix = F.col(at_host), F.col(at_suffix)

    # text-only posteriors, summed per host: narrow rows, partial sums before the shuffle
    narrow = scored.select(host.alias("host"), suffix.alias("suffix"), F.col(said).alias("declared"),
                           F.col(ll)["own"].alias("p"))
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)]
    arr = F.array(*[F.col(f"s{i}") for i in range(k)])
    by = materialize(narrow.groupBy("host", "suffix", "declared").agg(*sums)
                     .select("host", "suffix", "declared", *[f"s{i}" for i in range(k)]), "language-sums")
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]
    total = by.agg(*again).first()
    n_all = sum(x or 0.0 for x in total) or 1.0
    world = [((x or 0.0) + 1.0) / (n_all + k) for x in total]
    none = F.lit(None).cast("array<double>")
    hosts = by.groupBy("host", "suffix").agg(*again).select("host", "suffix", arr.alias("h"))
    suffixes = by.groupBy("suffix").agg(*again).select("suffix", arr.alias("x"))
    hosts = materialize(hosts.join(suffixes, hosts["suffix"].eqNullSafe(suffixes["suffix"]))
                        .select(hosts["host"], hosts["suffix"], "h", "x"), "host-priors")
    # keys that may be null are matched through one text key
    hk = fresh_name(docs.columns, "host_key")
    key = lambda h, s: F.to_json(F.struct(h.alias("h"), s.alias("s")))
    priors = hosts.select(key(F.col("host"), F.col("suffix")).alias(hk),
                          F.struct(F.when(F.col("host").isNotNull(), F.col("h")).otherwise(none).alias("h"),
                                   F.when(F.col("suffix").isNotNull(), F.col("x")).otherwise(none).alias("x")).alias(pr))
    out = rows.withColumn(hk, key(host, suffix)).join(broadcast_if_small(priors, MAX_HOSTS), hk, "left")
    # P(declared | language) from all rows, smoothed; unknown declarations are one value
    d = F.when(F.col("declared").isin(langs), F.col("declared")).otherwise(F.lit(""))
    rows = by.where("declared is not null").groupBy(d.alias("d")).agg(*again).collect()  # languages + 1 rows at most
    seen = {r["d"]: [r[f"s{i}"] or 0.0 for i in range(k)] for r in rows}
    per_lang = [sum(v[i] for v in seen.values()) for i in range(k)]
    odds = {x: [math.log((seen.get(x, [0.0] * k)[i] + 0.5) / (per_lang[i] + 0.5 * (k + 1))) for i in range(k)]
            for x in [*langs, ""]}

    def fuse_rows(like: list, own: list, sums_: pd.DataFrame, declared: pd.Series) -> pd.DataFrame:
        import numpy as np

        if not len(like):
            return pd.DataFrame({"language": pd.Series([], dtype=object), "posterior": pd.Series([], dtype=float)})
        like, own = np.stack(like), np.stack(own)
        prior = np.tile(np.asarray(world), (len(like), 1))
        for group, weight in (("x", SUFFIX_WEIGHT), ("h", HOST_WEIGHT)):
            has = sums_[group].notna().to_numpy()
            if has.any():  # without the row's own share
                rest = np.maximum(np.stack(sums_[group][has].to_numpy()) - own[has], 0)
                prior[has] = (rest + prior[has] * weight) / (rest.sum(axis=1, keepdims=True) + weight)
        logs = like[:, :-1] + np.log(prior)
        says = declared.notna().to_numpy()
        if says.any():
            logs[says] += np.array([odds.get(d, odds[""]) for d in declared[says]])
        noise = np.where(like.any(axis=1), like[:, -1] + math.log(NONE_PRIOR), -1e300)
        logs = np.c_[logs, noise]
        p = np.exp(logs - logs.max(axis=1, keepdims=True))
        best = p.argmax(axis=1)
        return pd.DataFrame({"language": [langs[i] if i < k else None for i in best],
                             "posterior": p[np.arange(len(p)), best] / p.sum(axis=1)})

    decision = "struct<language: string, posterior: double>"

    @F.pandas_udf(decision)
    def fuse(scores: pd.DataFrame, sums_: pd.DataFrame, declared: pd.Series) -> pd.DataFrame:
        return fuse_rows(list(scores["ll"]), list(scores["own"]), sums_, declared)

    @F.pandas_udf(decision)
    def score_and_fuse(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        def decided(found):
            for texts, sums_, declared in found:
                like = [bc.value.score(t) for t in texts]
                yield fuse_rows(like, [_softmax(r[:-1]) if r.any() else r[:-1] for r in like], sums_, declared)

        yield from tidy(decided)(batches)

    fused = fresh_name(docs.columns, "fused")
    out = out.withColumn(fused, (fuse if once else score_and_fuse)(F.col(ll), F.col(pr), F.col(said))) \
        .withColumn(lang_c, F.col(fused)["language"]).withColumn(post_c, F.col(fused)["posterior"])
    ok = F.col(lang_c).isNotNull() & (F.col(post_c) >= min_posterior)
    if languages is not None:
        ok = ok & F.col(lang_c).isin(languages)
    return out.withColumn(acc_c, F.coalesce(ok, F.lit(False))) \
        .select(*[F.col(f"`{c}`") for c in names], lang_c, post_c, acc_c)
