"""Fill-in-the-middle: a text cut at two random ranks, its middle moved to the end.

Ranks count units of the text: code points, or matches of a pattern from left
to right. The places of the ranks are looked up in an indexable skip list of the
text. Its bottom lane has a node for every ``NODE`` units; lane k links every
16^k-th node. Each link carries its width in units and its width in code
points. A look-up runs along the highest lane while the units passed stay within
the rank, goes down a lane, and adds up the code points passed; the last steps
are taken unit by unit inside one node. So a rank costs some 16 steps a lane,
and a list takes a few bytes for every 64 units of a text of any length.
"""

from __future__ import annotations

import hashlib
import itertools
import re

from pyspark.sql import Column, DataFrame, functions as F

MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
NODE = 64  # units of a node of the bottom lane
SKIP = 16  # nodes that a link of the next lane passes
OUT_CHARS = 1 << 22  # characters of an output batch
OUT_ROWS = 1024


class SkipList:
    """Units of ``text``, found by rank. Text before a match belongs to the match's unit; text behind the
    last match is a unit of its own. Without a pattern every code point is a unit."""

    def __init__(self, text: str, unit: re.Pattern | None = None):
        self.text, self.unit = text, unit
        if unit is None:
            full, rest = divmod(len(text), NODE)
            bottom = [(NODE, NODE)] * full + [(rest, rest)] * (rest > 0)
        else:
            bottom, at, n = [], 0, 0
            for end in self._ends(0):
                n += 1
                if n == NODE:
                    bottom.append((n, end - at))
                    at, n = end, 0
            if n:
                bottom.append((n, len(text) - at))
        self.lanes = [bottom]
        while len(self.lanes[-1]) > SKIP:
            low = self.lanes[-1]
            self.lanes.append([tuple(map(sum, zip(*low[k:k + SKIP]))) for k in range(0, len(low), SKIP)])
        self.n = sum(u for u, _ in self.lanes[-1])

    def _ends(self, at: int):
        """End of each unit from the character ``at`` on, which starts a unit."""
        if self.unit is None:
            yield from range(at + 1, len(self.text) + 1)
            return
        end = at
        for m in self.unit.finditer(self.text, at):
            if m.end() > m.start():  # an empty match is no unit
                end = m.end()
                yield end
        if end < len(self.text):
            yield len(self.text)

    def place(self, rank: int) -> int:
        """Code points in the first ``rank`` units."""
        units = chars = node = 0
        for lane in reversed(self.lanes):
            node *= SKIP
            while node < len(lane) and units + lane[node][0] <= rank:
                units += lane[node][0]
                chars += lane[node][1]
                node += 1
        left = rank - units
        if not left:
            return chars
        if self.unit is None:
            return chars + left
        return next(itertools.islice(self._ends(chars), left - 1, None))


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers below 2^32 for a document: the first 32 hex digits of SHA-256 of ``seed:doc_id``."""
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(x[k:k + 8], 16) for k in (0, 8, 16, 24)]


def transform(text: str, doc_id, seed: int, plain: int, spm: int, unit=None) -> tuple:
    """(units, form, characters of prefix and middle, output) of one text."""
    index = SkipList(text, unit)
    h = draws(doc_id, seed)
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 100 - plain:
        return index.n, "plain", None, None, text
    a, b = (index.place(r) for r in sorted((h[0] % (index.n + 1), h[1] % (index.n + 1))))
    p, s, m = MARKS
    if h[3] % 100 < spm:
        return index.n, "spm", a, b - a, "".join((s, text[b:], p, text[:a], m, text[a:b]))
    return index.n, "psm", a, b - a, "".join((p, text[:a], s, text[b:], m, text[a:b]))


def restored(output: str | Column, form: str | Column) -> Column:
    """The text that an output was made from. Marks stand in a fixed order and in no part of
    the text, so each part ends where the next mark starts."""
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    p, s, m = MARKS

    def between(first, then):
        return F.substring_index(F.substring(out, len(first) + 1, 2 ** 31 - 1), then, 1)

    def last(mark, before):
        return F.substring_index(out, mark, -1) if before is None else F.substring_index(F.substring_index(out, before, 1), mark, -1)

    return F.when(form == "plain", out) \
        .when(form == "spm", F.concat(last(p, m), last(m, None), between(s, p))) \
        .otherwise(F.concat(between(p, s), last(m, None), last(s, m)))


def fill_in_middle(docs: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20, unit: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n`` (units of the text), ``form`` (``plain``, ``psm`` or ``spm``), ``prefix_chars``, ``middle_chars``
    (code points; null if plain) and ``output``, for every row of ``docs``.

    Of 100 texts about ``plain`` stay as they are, and of the others ``spm`` have the suffix first. Both cuts are ranks
    from 0 to ``n``, drawn from the SHA-256 of ``seed`` and the id: a row's result does not depend on others or on
    the number of tasks. ``unit`` is a pattern; null: every code point is a unit.

    A null text is an empty one; empty texts, and texts that hold a mark, stay plain. Rows with the same id draw the same
    numbers; a null id draws as an empty text does. Repeated rows are each transformed. An empty table gives no
    rows. Other columns of ``docs`` are not read.
    """
    def made(batches):
        import pyarrow as pa

        pattern = re.compile(unit) if unit is not None else None
        schema = pa.schema([("doc_id", key), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                            ("middle_chars", pa.int64()), ("output", pa.string())])
        rows, size = [], 0
        for b in batches:
            for k in range(0, b.num_rows, OUT_ROWS):
                part = b.slice(k, OUT_ROWS)
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    rows.append((i, *transform(t or "", i, seed, plain, spm, pattern)))
                    size += len(rows[-1][-1])
                    if size > OUT_CHARS or len(rows) == OUT_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    key = to_arrow_type(rows.schema["doc_id"].dataType)
    return rows.mapInArrow(made, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, form string, "
                                 "prefix_chars long, middle_chars long, output string")
