"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check
from tidemark.plans import queries as registered

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query(spark, name):
    verdict, _, _ = check.compare(spark, SMALL, name)
    assert verdict == "ok"


def test_every_query_has_sql():
    assert set(registered.ORACLE) == set(registered.QUERIES)
    assert set(registered.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
