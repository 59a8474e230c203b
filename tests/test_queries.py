"""Every query against its SQL on the smallest data; those without SQL must run."""

from pathlib import Path

import agree
import pytest

import __spark_entry__ as entry
from marketlens.plans import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return agree.views(DATA)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    query = catalog.QUERIES[name]
    if name in catalog.SQL:
        assert agree.compare(spark, con, DATA, query, catalog.SQL[name]) == ""
    else:
        assert query(spark, DATA).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
