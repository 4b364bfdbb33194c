import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from blobferry.session import get_session

    s = get_session("local[*]", app_name="blobferry-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    """A fresh local folder per test (tests only; jobs use the shared folder)."""
    return tempfile.mkdtemp(prefix="blobferry-test-")


def plan_text(df, mode="formatted"):
    """The printed physical plan of a DataFrame."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
