"""The queries that SQL can express, against SQL, on the smallest tables; all are registered."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not there")
@pytest.mark.parametrize("name", ["op6_warc", "op9_mixing", "op11_vectors", "op12_divergence", "op13_repeats"])
def test_query_equals_sql(spark, name):
    difference, _ = compare(spark, connect(FOLDER), entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert not difference, difference


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] and "pipeline" in entry.queries()
