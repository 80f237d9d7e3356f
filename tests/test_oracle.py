"""Every registered query against its SQL."""

import pytest

from conftest import ROOT
from oracle import compare
from tidemark.plans.registry import all_queries

QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    ok, message = compare(spark, ROOT, QUERIES[name])
    assert ok, message


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
