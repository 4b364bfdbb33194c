"""Token counts without encoding: pre-tokens that are one token by themselves are only counted.

Before a job starts, the driver proves which strings of the vocabulary stay one
token when they stand alone: the tokenizer's own pre-tokenizer leaves the string
in one part, and its model gives that part one id. The list has at most as many
entries as the vocabulary, and goes to the tasks as a broadcast.

A text is cut at blanks where a byte-level pre-tokenizer always starts a new
pre-token (``encoder.pieces``). A piece in the list counts one. Any other piece goes
through the tokenizer's pre-tokenizer, its parts are looked up in the same list,
and only the parts not in it are merged by the model. Other tokenizers are asked
for the pre-tokens of the whole normalized text. Strings of added tokens are cut
out first, each is one token, as the library does by default.

Vocabularies of the ``sentencepiece`` library (``.model``) have no pre-tokens: a text
is a sequence of words, each with its blank mark before it, and no token of the
vocabulary spans two words (proved on the list as well; else texts are encoded whole).
"""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame, functions as F

from blobferry.llm.common import fresh_name
from blobferry.llm.encoder import byte_letters, is_word, pieces, source

MEMO = 400_000  # newest pieces of up to ``MEMO_CHARS`` characters whose count a task remembers, and as many older ones
MEMO_CHARS = 48
CHUNK = 256  # texts taken from Arrow at a time
SEGMENT = 1 << 20  # characters whose pieces are held at a time
_CUT = re.compile(r"(?<=\S)(?= )")
_MARKED = re.compile(r"(.*[^\W_])((?:[^\w\s']|_)+)", re.S)  # marks behind a letter or digit; an apostrophe may start a contraction


def segments(text: str):
    """The text in parts of some ``SEGMENT`` characters, cut where a pre-token starts."""
    at = 0
    while len(text) - at > SEGMENT:
        m = _CUT.search(text, at + SEGMENT)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def old_sign(c: str) -> bool:
    """All versions of Unicode in use agree whether the character is a letter, a number or a mark."""
    return c < "\u0530" or "\u2000" <= c < "\u2070"


class JsonCounter:
    """Counts tokens as ``tokenizers`` gives them, without begin, end or added special tokens."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        conf = json.loads(spec)
        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.pre, self.norm, self.model = self.tok.pre_tokenizer, self.tok.normalizer, self.tok.model
        added = conf.get("added_tokens") or []
        plain = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word")
                         or t.get("normalized") and self.norm is not None) for t in added)
        strings = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, strings))) if strings else None
        self.cut_added = plain
        pre = conf.get("pre_tokenizer") or {}
        byte_level = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self.by_piece = byte_level and self.norm is None
        # parts of a text are independent of each other only where a pre-tokenizer made them
        self.in_parts = self.pre is not None and not pre.get("add_prefix_space") and pre.get("type") != "Metaspace"

    def parts(self, text: str) -> list[str]:
        """Pre-tokens, as the model gets them."""
        if self.norm is not None:
            text = self.norm.normalize_str(text)
        return [p for p, _ in self.pre.pre_tokenize_str(text)]

    def whole_tokens(self) -> tuple[list, list]:
        """(texts, parts) proved to be one token alone: pieces of a text as ``pieces`` gives them, and pre-tokens."""
        if not self.in_parts:
            return [], []
        parts = {p for p in self.tok.get_vocab(with_added_tokens=False) if len(self.model.tokenize(p)) == 1}
        texts = []
        if self.by_piece:
            back = {c: b for b, c in byte_letters().items()}
            for p in parts:
                try:
                    text = bytes(back[c] for c in p).decode()
                except (KeyError, UnicodeDecodeError):
                    continue  # a part of a character
                if text[:1] == " " and text[1:2] not in ("", "\0", "\n") and self.parts(text) == [p]:
                    texts.append(text[1:])
        return texts, list(parts)

    def counter(self, proved):
        texts, parts = proved
        whole = frozenset(parts)
        tokenize, letters = self.model.tokenize, byte_letters()
        new, old = dict.fromkeys(texts, 1), {}  # two generations of counts: the older goes when the newer is full

        def count_parts(text):
            return sum(1 if p in whole else len(tokenize(p)) for p in self.parts(text))

        def word(piece):
            """A piece of letters is one pre-token: the list or the model decides on it."""
            if not is_word(piece):
                return count_parts(source(piece))
            p = "".join(map(letters.__getitem__, source(piece).encode()))
            return 1 if p in whole else len(tokenize(p))

        def known(piece, of):
            x = new.get(piece) or old.get(piece)
            if x is None:
                x = of(piece)
            if len(piece) <= MEMO_CHARS:
                new[piece] = x
            return x

        def rest(piece):
            m = _MARKED.fullmatch(piece)
            if m and old_sign(m[1][-1]) and old_sign(m[2][0]):
                return known(m[1], word) + known("\0" + m[2], word)
            return word(piece)

        def count_pieces(text):
            nonlocal new, old
            total = 0
            for part in segments(text):
                if len(new) > len(texts) + MEMO:
                    new, old = dict.fromkeys(texts, 1), new
                found = pieces(part)
                n = list(map(new.get, found))
                if None in n:
                    n = [known(found[k], rest) if x is None else x for k, x in enumerate(n)]
                total += sum(n)
            return total

        one = count_pieces if self.by_piece else count_parts

        def count(text):
            if not text:
                return 0
            if self.added is not None and self.added.search(text):
                if not (self.cut_added and self.in_parts):
                    return len(self.tok.encode(text, add_special_tokens=False).ids)
                rest = [p for p in self.added.split(text) if p]
                return len(self.added.findall(text)) + sum(map(one, rest))
            return one(text) if self.in_parts else len(self.tok.encode(text, add_special_tokens=False).ids)

        return count


class ModelCounter:
    """Counts tokens as ``sentencepiece`` gives them."""

    MARK = "▁"

    def __init__(self, spec: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=spec)

    def whole_tokens(self) -> tuple[list, list]:
        """Words of ASCII letters proved to be one token alone, if no token holds a mark behind another character."""
        tokens = [self.sp.id_to_piece(k) for k in range(self.sp.get_piece_size())]
        if any(self.MARK in t.lstrip(self.MARK) for t in tokens) or not self.sp.encode("a", out_type=str)[0].startswith(self.MARK):
            return [], []
        words = [t[1:] for t in tokens if t[0] == self.MARK and t[1:].isascii() and t[1:].isalpha()]
        return [w for w, ids in zip(words, self.sp.encode(words, num_threads=1)) if len(ids) == 1], []

    def counter(self, proved):
        words = proved[0]
        memo = dict.fromkeys(words, 1)
        plain = re.compile(r"[!-~]+(?: [!-~]+)*")  # ASCII words with one blank between them

        def count(text):
            if not text:
                return 0
            if not words or not plain.fullmatch(text):
                return len(self.sp.encode(text, num_threads=1))
            found = text.split(" ")
            miss = {w for w in found if w not in memo}
            if miss:
                if len(memo) >= len(words) + MEMO:
                    memo.clear()
                    memo.update(dict.fromkeys(words, 1))
                miss = list({w for w in found if w not in memo})
                memo.update((w, len(ids)) for w, ids in zip(miss, self.sp.encode(miss, num_threads=1)))
            return sum(map(memo.__getitem__, found))

        return count


def counter_of(path: str, spec):
    return ModelCounter(spec) if path.endswith(".model") else JsonCounter(spec)


def read_spec(path: str):
    """Content of a tokenizer file: bytes of a ``.model`` file, else text."""
    with open(path, "rb") as f:
        raw = f.read()
    return raw if path.endswith(".model") else raw.decode("utf-8")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    ``tokenizer`` is a file of the ``tokenizers`` (``.json``) or ``sentencepiece`` (``.model``) library that the driver
    can read. Whole texts are counted; nothing is cut off or padded.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows are counted each by itself; ids are not looked at,
    so they may be null or repeated. A column of ``docs`` that has the name of a result is replaced. An
    empty table gives no rows. A text of any length is held once, with its pieces, in one task.
    """
    spec = read_spec(tokenizer)
    proved = counter_of(tokenizer, spec).whole_tokens()
    shared = docs.sparkSession.sparkContext.broadcast((spec, proved))  # a vocabulary and its strings
    results = ["n_bytes", "n_tokens", "over_limit"]
    others = [c for c in docs.columns if c.lower() not in (*results, text_col.lower())]

    def counted(batches):
        import pyarrow as pa

        count = counter_of(tokenizer, shared.value[0]).counter(shared.value[1])  # its memory ends with the task
        for b in batches:
            texts = b.column(b.num_columns - 1)
            n = []
            for k in range(0, b.num_rows, CHUNK):
                n += map(count, texts.slice(k, CHUNK).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], [*b.schema.names[:-1], "n_tokens"])

    n_bytes = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")
    text = F.col(text_col).alias(fresh_name([*others, *results], "text_"))
    rows = docs.select(*others, n_bytes, text)
    out = rows.mapInArrow(counted, rows.drop(rows.columns[-1]).schema.add("n_tokens", "long"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
