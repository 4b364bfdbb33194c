"""Whole-text encoding with the ``tokenizers`` library inside Spark tasks.

A byte-level BPE splits a text into pre-tokens before it merges bytes. A space
after a non-space always starts a new pre-token, a newline between non-spaces
is one by itself, and so are marks after a letter or digit. So a text is cut
there, each distinct piece is encoded once by the library, and the ids of a
text are the ids of its pieces in order: the same ids as encoding the whole
text (tested). A piece of letters alone is one pre-token, so it goes to the
library's model without the pre-tokenizer. Tokenizers with another
pre-tokenizer or with a normalizer encode whole texts, and so do texts that hold the
string of an added token.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

CACHE_PIECES = 700_000  # newest distinct pieces of each kind held per Python worker, and as many older ones
CHUNK_CHARS = 4 << 20  # characters whose distinct pieces are looked up at once
_CUT = re.compile(r"(?<=\S)(?= )")
_OTHER_BLANKS = "".join(x for x in map(chr, range(1 << 16)) if x.isspace() and x not in " \n")  # what \s matches besides
_BLANKS = re.compile(r"\s[\n ]|\n\s")
_MARKS = re.compile(r"(.*[^\W_])((?:[^\w\s']|_)+)", re.S)  # an apostrophe may start a contraction
_ASCII_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS_TO = "\u0530"  # below it no letter is newer than the library's own tables
_ENCODERS: dict = {}


def byte_letters() -> dict:
    """The character that a byte-level vocabulary has for each byte: printable ones stand for
    themselves, the others are numbered from 256 on."""
    same = {*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), 256)}
    other = (b for b in range(256) if b not in same)
    return {b: chr(b) for b in same} | {b: chr(256 + k) for k, b in enumerate(other)}


class Encoder:
    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        conf = json.loads(spec)
        # a text that holds the string of an added token is encoded whole, as the library does by default
        self.added = [t["content"] for t in conf.get("added_tokens") or [] if t["content"]]
        pre = conf.get("pre_tokenizer") or {}
        self.by_piece = (conf.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        self.by_word = self.by_piece and conf["model"].get("type") == "BPE"
        self.letters = byte_letters()
        self.blank = self.letters[ord(" ")]
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.dtype = "<u2" if self.width == 2 else "<u4"
        self.code = "H" if self.width == 2 else "I"
        self.keep = CACHE_PIECES
        self.new, self.old = {}, {}  # two generations of pieces; the older goes when the newer is full

    def pack(self, ids: list) -> bytes:
        a = array(self.code, ids)
        if sys.byteorder == "big":
            a.byteswap()
        return a.tobytes()

    def ids(self, texts: list) -> list[bytes]:
        return [self.pack(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list) -> list[bytes]:
        """Ids of texts that are one pre-token each: letters, at most one space before them."""
        split, blank, letters = self.tok.model.tokenize, self.blank, self.letters
        ids: list = []
        ends = [0]
        for w in words:
            ids += [t.id for t in split(w.replace(" ", blank) if w.isascii() else w.encode().decode("latin-1").translate(letters))]
            ends.append(len(ids) * self.width)
        raw = self.pack(ids)
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    def encode(self, texts: list) -> list[bytes]:
        """Ids of each text as little-endian bytes of ``dtype``; null is an empty text."""
        if not self.by_piece:
            return self.ids([t or "" for t in texts])
        out: list[bytes] = []
        most = min(CHUNK_CHARS, 6 * self.keep)  # a small cache is asked for to save memory
        i = 0
        while i < len(texts):
            part, size = [], 0
            while i < len(texts) and (not part or size < most):  # a long text is one entry: a chunk stays near its texts' size
                part.append(texts[i] or "")
                size += len(part[-1])
                i += 1
            out += self._chunk(part)
        return out

    def _chunk(self, texts: list) -> list[bytes]:
        import numpy as np

        whole = {k: self.ids([t])[0] for k, t in enumerate(texts) if any(x in t for x in self.added)}
        index, uniq, ends = distinct_pieces(["" if k in whole else t for k, t in enumerate(texts)] if whole else texts)
        if len(self.new) > self.keep:
            self.new, self.old = {}, self.new
        found = list(map(self.new.get, uniq))  # one look at each distinct piece of the chunk
        miss = [k for k, raw in enumerate(found) if raw is None]
        if miss:
            self._fill([uniq[k] for k in miss])
            for k in miss:
                found[k] = self.new[uniq[k]]
        # the ids of the distinct pieces side by side, then those of all pieces in order
        n = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        at = np.cumsum(n) - n
        ids = np.frombuffer(b"".join(found), self.dtype)
        n, at = n[index], at[index]
        upto = np.cumsum(n)
        raw = ids[np.arange(upto[-1]) + np.repeat(at - (upto - n), n)].tobytes()
        cut = [0, *(upto[ends - 1] * self.width).tolist()]  # a text has one piece at least
        return [whole[k] if k in whole else raw[a:b] for k, (a, b) in enumerate(zip(cut, cut[1:]))]

    def forget(self) -> None:
        self.new, self.old = {}, {}

    def _fill(self, miss: list) -> None:
        """Ids of distinct pieces that ``new`` lacks. Lists side by side, not tuples: the garbage collector skips strings."""
        new, old = self.new, self.old
        whole, marked, words, marks = [], [], [], []
        for p in miss:
            raw = old.get(p) if old else None
            if raw is not None:
                new[p] = raw
            elif p[-1:].isalnum():  # most end without marks
                whole.append(p)
            else:
                word = p.rstrip(_ASCII_MARKS)
                if not word[-1:].isalnum():  # other marks, an apostrophe, a blank, or marks alone
                    m = _MARKS.fullmatch(p)
                    word = m[1] if m else ""
                if word:
                    marked.append(p)
                    words.append(word)
                    marks.append(p[len(word):])
                else:
                    whole.append(p)
        for w in set(words).difference(new, whole):
            raw = old.get(w)
            if raw is None:
                whole.append(w)
            else:
                new[w] = raw
        if self.by_word:
            plain = [p for p in whole if is_word(p)]
            new.update(zip(plain, self.words([source(p) for p in plain])))
            whole = [p for p in whole if p not in new]
        for k in range(0, len(whole), 20_000):
            part = whole[k:k + 20_000]
            new.update(zip(part, self.ids([source(p) for p in part])))
        kinds = list(set(marks))
        of = dict(zip(kinds, self.ids(kinds)))
        for p, w, x in zip(marked, words, marks):
            new[p] = new[w] + of[x]


def distinct_pieces(texts: list) -> tuple:
    """``(index, uniq, ends)``: the pieces of all texts in order are those of ``uniq`` at ``index``, and those of
    text ``i`` end at ``ends[i]``. Arrow cuts and numbers them; texts that need more than a cut at
    blanks are cut by :func:`pieces`."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    simple = [_simple(t) for t in texts]
    cut = pc.split_pattern(pa.array(["\0" + t.replace("\n", " \n") for t, x in zip(texts, simple) if x], pa.string()), " ")
    other = [pieces(t) for t, x in zip(texts, simple) if not x]
    flat = pa.concat_arrays([cut.flatten(), pa.array([p for x in other for p in x], pa.string())]).dictionary_encode()
    index, uniq = flat.indices.to_numpy(), flat.dictionary.to_numpy(zero_copy_only=False).tolist()
    if not other:
        return index, uniq, cut.offsets.to_numpy()[1:]
    simple = np.array(simple)
    sizes = np.zeros(len(texts), np.int64)
    sizes[simple] = np.diff(cut.offsets.to_numpy())
    sizes[~simple] = [len(x) for x in other]
    ends = np.cumsum(sizes)
    first = np.zeros(len(texts), np.int64)  # where a text's pieces start in the cut order: simple texts, then the others
    for at, rows in ((0, simple), (int(sizes[simple].sum()), ~simple)):
        first[rows] = at + np.cumsum(sizes[rows]) - sizes[rows]
    order = np.arange(int(ends[-1])) + np.repeat(first - (ends - sizes), sizes)
    return index[order], uniq, ends


def _simple(t: str) -> bool:
    """Cut at blanks and newlines alone: no run of blanks, none at an end, no other blanks but single ones, no NUL."""
    return not ("\0" in t or "  " in t or "\n\n" in t or "\n " in t or " \n" in t or t[-1:] == "\n" or t[:1] == "\n"
                or any(x in t for x in ("\t\r\v\f" if t.isascii() else _OTHER_BLANKS)) and _BLANKS.search(t))


def pieces(t: str) -> list[str]:
    """Pieces of a text. One that starts with NUL stands for what follows it, one that
    starts with a newline for itself, any other for a space and itself."""
    if "\0" in t:
        return ["\0" + t]
    if not _simple(t):
        cut = _CUT.split(t)
        return ["\0" + cut[0], *("\0" + c if c[1:2] in ("\n", "\0") else c[1:] for c in cut[1:])]
    p = t.replace("\n", " \n").split(" ")
    p[0] = "\0" + p[0]
    return p


def source(piece: str) -> str:
    return piece[1:] if piece[:1] == "\0" else piece if piece[:1] == "\n" else " " + piece


def is_word(piece: str) -> bool:
    """The piece is letters alone, of scripts that all versions of Unicode in use agree on."""
    word = piece[1:] if piece[:1] == "\0" else piece
    return word.isalpha() and (word.isascii() or max(word) < _LETTERS_TO)


def encoder(spec: str) -> Encoder:
    """The worker's encoder for a tokenizer file's text; built once per worker."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def forget() -> None:
    """Drop this worker's encoder and its pieces; a stage that encodes keeps them from task to task."""
    for enc in _ENCODERS.values():
        enc.forget()
    _ENCODERS.clear()


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
