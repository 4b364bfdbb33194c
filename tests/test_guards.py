"""Rules the library keeps, checked on its source text."""

import os
import re

PKG = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "blobferry")


def _sources():
    for folder, _, files in os.walk(PKG):
        if os.path.relpath(folder, PKG).split(os.sep)[0] == "llm":
            continue  # optional operators; their tests hold their own rules
        for name in files:
            if name.endswith(".py"):
                path = os.path.join(folder, name)
                yield os.path.relpath(path, PKG), open(path).read()


def _hits(pattern):
    return sorted(f"{rel}:{i + 1}" for rel, text in _sources()
                  for i, line in enumerate(text.splitlines()) if re.search(pattern, line))


def test_no_local_checkpoint_rdd_or_row_udfs():
    assert _hits(r"localCheckpoint") == []
    assert _hits(r"\.rdd\b") == []
    assert _hits(r"F\.udf|@udf|\budf\(") == []


def test_collects_are_the_bounded_ones():
    # One count per partition, for the row numbering offsets; the command
    # line's status report of the latest N runs (limit, then collect); the
    # ends of each block of 100,000 wanted ids of a lookup.
    assert [h.split(":")[0] for h in _hits(r"\.collect\(\)")] == ["__main__.py", "operators/batching.py", "sources/file_index.py"]
    assert ".limit(a.last).collect()" in open(os.path.join(PKG, "__main__.py")).read()


def test_local_temp_folder_only_when_no_checkpoint_dir_is_set():
    assert [h.split(":")[0] for h in _hits(r"tempfile\.mkdtemp")] == ["session.py"]
