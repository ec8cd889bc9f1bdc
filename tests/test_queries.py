"""Every driver query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from driver.oracle import ORACLE
from driver.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not there")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    sql = ORACLE[name]
    difference, _ = compare(spark, db, QUERIES[name], sql, FOLDER)
    assert not difference, difference


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 43 and df.count() > 0
