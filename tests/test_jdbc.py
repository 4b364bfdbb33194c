"""JDBC wiring, checked against a stub reader: no database is started here."""

import pytest

from blobferry.sources import jdbc


class _Reader:
    def __init__(self):
        self.calls = []

    def jdbc(self, url, table, **kw):
        self.calls.append((url, table, kw))
        return "frame"


class _Spark:
    def __init__(self):
        self.read = _Reader()


def test_split_column_read():
    s = _Spark()
    jdbc.read_table(s, "jdbc:x://h/db", "docs", user="u", password="p", split_column="MODIFIED",
                    lower_bound="2024-01-01", upper_bound="2024-02-01", num_partitions=16)
    url, table, kw = s.read.calls[0]
    assert (url, table, kw["column"], kw["numPartitions"]) == ("jdbc:x://h/db", "docs", "MODIFIED", 16)
    assert kw["properties"]["user"] == "u" and kw["properties"]["fetchsize"] == "1000"


def test_predicate_read_and_plain_read():
    s = _Spark()
    preds = [f"MOD(CRC32(POLICY_ID), 4) = {i}" for i in range(4)]
    jdbc.read_table(s, "jdbc:x://h/db", "docs", predicates=preds)
    jdbc.read_table(s, "jdbc:x://h/db", "docs")
    assert s.read.calls[0][2]["predicates"] == preds
    assert set(s.read.calls[1][2]) == {"properties"}


def test_split_column_needs_bounds():
    with pytest.raises(ValueError):
        jdbc.read_table(_Spark(), "jdbc:x://h/db", "docs", split_column="ID")
