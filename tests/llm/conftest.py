import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, a very long text, clashing column names."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, rid long, ids string, "
              "language string, kept string, _gone int, n_lines int")
    long_text = "alpha beta gamma delta " * 30_000
    rows = [(None, None), (None, "no id here"), (1, None), (2, ""), (3, "  \n\t\n"), (4, "one line\nother line"),
            (4, "one line\nother line"), (5, "one line\nother line"), (6, long_text), (-7, "x"), (8, "é ü \n\n  two  blanks ")]
    return spark.createDataFrame([(i, t, None, None, None, 1, "a", "b", "c", 2, 3) for i, t in rows], schema)


@pytest.fixture(scope="session")
def empty(spark, odd):
    return odd.limit(0)
