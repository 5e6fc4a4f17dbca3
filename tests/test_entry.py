"""The driver's contract."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 50


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
