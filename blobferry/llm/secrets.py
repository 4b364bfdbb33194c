"""Secret scanning: regular-expression candidates, then a random forest that
removes the false ones. DataFrame functions and ``pyspark.ml`` only.

A candidate is a maximal run of at least ``MIN_LENGTH`` characters that keys
and tokens are made of, or a value assigned to a name that holds one of
``NAMES``: of any length and any marks, quoted on one line, or else up to a
blank or the next such name. Features of a candidate: length, character classes and the
transitions between them, how likely its letter pairs are in the corpus' own
words, how much of it dictionary words cover, the words next to it, and the
path of its document. The dictionary (words seen ``DICTIONARY_MIN`` times) and
the letter-pair table are counted over the whole corpus; the pair table is
bounded by the alphabet.

The forest is trained on labelled findings: a bounded sample (``SAMPLE`` of
each class, by a hash). Where no labelled findings are given,
``seed_labels`` marks the clear cases, and the forest decides the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from blobferry.llm.common import materialize

MIN_LENGTH = 16
CHARS = "A-Za-z0-9+/_=.-"
CANDIDATE = f"(?<![{CHARS}])[{CHARS}]{{{MIN_LENGTH},}}+"
#: Names that secrets are assigned to, and parts of paths where findings are mostly samples.
NAMES = "token|secret|passw(?:or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer"
_NAME = rf"(?<![\w.-])(?=[\w.-]*?(?:{NAMES}))[\w.-]++[\"'`\])}}]*+\s*+[=:]"
#: Name and sign; the value stays ahead, so that a name inside a value is found too. Loops are over single
#: characters only, as the regex engine's stack grows with repeated groups.
ASSIGNED = rf"""(?i){_NAME}[=:>]*+\s*+(?:(?:bearer|basic)\s++)?+(?=(\"[^\n]*?(?<!(?<!\\)\\)\"|'[^\n]*?(?<!(?<!\\)\\)'|`[^`\n]*+`|\S+?(?=\s|\z|{_NAME})))"""
SAMPLE_PATHS = "test|example|sample|mock|fixture|doc"
NEAR = 80
DICTIONARY_MIN = 5
SAMPLE = 10_000
THRESHOLD = 0.5
FEATURES = ["f_length", "f_digits", "f_upper", "f_lower", "f_marks", "f_switches", "f_distinct", "f_vowels", "f_hex",
            "f_pairs", "f_words", "f_named", "f_assigned", "f_quoted", "f_depth", "f_sample_path"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """Written table of findings ``(fid, doc_id, nth, candidate, before, after, path, assigned)``;
    ``nth`` counts a document's candidates from 0, runs first, then ``assigned``
    values that are not a whole run anyway; ``before`` and ``after`` are the text
    next to it, up to the neighbouring candidate of its kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.col(path_col) if path_col else F.lit(None)).cast("string").alias("path"),
                       F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"),
                       F.split(text, CANDIDATE, -1).alias("between"),
                       F.regexp_extract_all(text, F.lit(ASSIGNED), F.lit(0)).alias("names"),
                       F.regexp_extract_all(text, F.lit(ASSIGNED), F.lit(1)).alias("values"),
                       F.split(text, ASSIGNED, -1).alias("beside")).where("size(found) > 0 or size(names) > 0")
    runs = F.transform("found", lambda c, i: F.struct(
        i.alias("nth"), c.alias("candidate"), F.right(F.col("between")[i], F.lit(NEAR)).alias("before"),
        F.left(F.col("between")[i + 1], F.lit(NEAR)).alias("after"), F.lit(False).alias("assigned")))

    def value(raw: Column, i: Column) -> Column:
        quote = F.when(F.regexp_like(raw, F.lit("(?s)^([\"'`]).*\\1$")) & (F.length(raw) > 1), F.left(raw, F.lit(1))) \
            .otherwise(F.lit(""))
        n = F.length(quote)
        return F.struct(
            i.alias("nth"), F.substring(raw, n + 1, F.length(raw) - 2 * n).alias("candidate"),
            F.right(F.concat(F.col("beside")[i], F.col("names")[i], quote), F.lit(NEAR)).alias("before"),
            F.left(F.concat(quote, F.substring(F.col("beside")[i + 1], F.length(raw) + 1, F.lit(NEAR))), F.lit(NEAR)).alias("after"),
            F.lit(True).alias("assigned"))

    whole_run = lambda x: F.regexp_like(x["candidate"], F.lit(f"^[{CHARS}]{{{MIN_LENGTH},}}$")) \
        & ~F.regexp_like(x["before"], F.lit(f"[{CHARS}]$")) & ~F.regexp_like(x["after"], F.lit(f"^[{CHARS}]"))
    rows = rows.select("doc_id", "path", "found", runs.alias("runs"), F.filter(
        F.transform("values", value), lambda x: (x["candidate"] != "") & ~whole_run(x)).alias("set"))
    both = F.concat("runs", F.transform("set", lambda x, i: x.withField("nth", i + F.size("found"))))
    out = rows.select("doc_id", "path", F.explode(both).alias("x")).select("doc_id", "path", "x.*")
    return materialize(out.withColumn("fid", F.monotonically_increasing_id()), "findings")


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Written ``(word, n)`` over the whole corpus: runs of 3 to 30 ASCII letters, lower case."""
    word = F.explode(F.split(F.lower(F.col(text_col).cast("string")), "[^a-z]+")).alias("word")
    return materialize(docs.select(word).where(F.length("word").between(3, 30))
                       .groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")


def _pairs(s: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substring(s, i, F.lit(2)))


def pair_table(words: DataFrame) -> DataFrame:
    """``(pair, lp)``: log probability of the second letter after the first, smoothed;
    26 x 26 rows at most, so it may be broadcast."""
    pairs = words.select("n", F.explode(_pairs(F.col("word"))).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
    first = pairs.groupBy(F.substring("pair", 1, 1).alias("c")).agg(F.sum("n").alias("m"))
    return materialize(pairs.join(F.broadcast(first), F.substring("pair", 1, 1) == F.col("c"))
                       .select("pair", F.log((F.col("n") + 0.5) / (F.col("m") + 13)).alias("lp")), "letter-pairs")


def with_features(findings: DataFrame, words: DataFrame) -> DataFrame:
    """Written findings with the columns ``FEATURES``."""
    c, n = F.col("candidate"), F.length("candidate")
    share = lambda pattern: F.regexp_count("candidate", F.lit(pattern)) / n
    low = F.lower("before")
    path = F.lower(F.coalesce("path", F.lit("")))
    f = findings.withColumns({
        "f_length": F.log(n.cast("double")), "f_digits": share("[0-9]"), "f_upper": share("[A-Z]"),
        "f_lower": share("[a-z]"), "f_marks": share("[^0-9A-Za-z]"),
        "f_switches": share("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])"),
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / F.least(n, F.lit(64)),
        "f_vowels": share("[aeiouAEIOU]"), "f_hex": share("[0-9a-fA-F]"),
        "f_named": (F.col("assigned") | F.regexp_like(low, F.lit(f"(?:{NAMES})[^a-z0-9]*$"))).cast("double"),
        "f_assigned": (F.col("assigned") | F.regexp_like("before", F.lit("[=:]\\s*[\"'`]?$"))).cast("double"),
        "f_quoted": F.regexp_like("after", F.lit("^[\"'`]")).cast("double"),
        "f_depth": F.size(F.split(path, "/")).cast("double"),
        "f_sample_path": F.regexp_like(path, F.lit(SAMPLE_PATHS)).cast("double")})
    # letter pairs of the whole candidate; a pair the corpus never has counts as e^-9
    table = pair_table(words)
    lp = findings.select("fid", F.explode(_pairs(F.lower(c))).alias("pair")) \
        .where(F.regexp_like("pair", F.lit("^[a-z]{2}$"))).join(F.broadcast(table), "pair", "left") \
        .groupBy("fid").agg(F.avg(F.coalesce("lp", F.lit(-9.0))).alias("f_pairs"))
    known = words.where(F.col("n") >= DICTIONARY_MIN).select("word")
    runs = findings.select("fid", F.explode(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    runs = materialize(runs, "finding-words")
    covered = runs.join(known, "word", "left_semi").groupBy("fid").agg(F.sum(F.length("word")).alias("covered"))
    out = f.join(lp, "fid", "left").join(covered, "fid", "left") \
        .withColumn("f_words", F.coalesce(F.col("covered") / n, F.lit(0.0))) \
        .withColumn("f_pairs", F.coalesce("f_pairs", F.lit(0.0))).drop("covered")
    return materialize(out, "features")


def seed_labels(findings: DataFrame) -> DataFrame:
    """Adds ``label``: 1 for quoted values assigned to a secret's name that mix
    letters and digits, 0 for plain words, numbers and host names with no such
    name before them and for unquoted dictionary words after one, null for the rest."""
    secret = (F.col("f_named") == 1) & (F.col("f_assigned") == 1) & (F.col("f_quoted") == 1) \
        & (F.col("f_digits").between(0.1, 0.9))
    plain = (F.col("f_named") == 0) & ((F.col("f_digits") == 0) | (F.col("f_digits") == 1)
                                       | F.regexp_like("candidate", F.lit(r"^[a-z0-9.-]+\.(?:com|org|net)\.?$")))
    prose = F.col("assigned") & (F.col("f_quoted") == 0) & F.regexp_like("candidate", F.lit("^[A-Za-z]+[.,;:]?$")) \
        & (F.col("f_words") + F.col("f_marks") >= 1)
    return findings.withColumn("label", F.when(secret, 1.0).when(plain | prose, 0.0))


def train(labelled: DataFrame, sample: int = SAMPLE, seed: int = 1):
    """Random forest from findings with a 0/1 ``label``; null where a class is missing."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    parts = [labelled.where(F.col("label") == y).select(*FEATURES, "label")
             .orderBy(F.xxhash64("fid"), "fid").limit(sample) for y in (0.0, 1.0)]
    rows = materialize(parts[0].unionAll(parts[1]), "training")
    if rows.select("label").distinct().count() < 2:
        return None
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=20, maxDepth=6, seed=seed, labelCol="label").fit(assembled)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
         labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, nth, candidate, before, score, is_secret)``: every finding, with
    the forest's probability and decision.

    ``labelled``: findings with the columns of ``with_features`` and ``label``;
    default: seed labels on these findings. If a class has no labelled
    finding, there is no forest: ``score`` is the seed label (null if unclear) and only label 1
    is a secret. Null text has no finding; null ids and paths are kept as null.
    Repeated rows give their findings again. Empty table: no row. Extra columns
    are not read.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    found = seed_labels(with_features(candidates(docs, id_col, text_col, path_col), word_counts(docs, text_col)))
    model = train(found.where("label is not null") if labelled is None else labelled)
    if model is None:
        scored = found.withColumn("score", F.col("label"))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)) \
            .withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "nth", "candidate", "before", "score",
                         F.coalesce(F.col("score") >= threshold, F.lit(False)).alias("is_secret"))
