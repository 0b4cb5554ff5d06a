"""Every registered query against its SQL on the smallest data set."""

import pytest

from habispark.registry.queries import QUERIES

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import differences

DATA = "/root/testdata/sf0.001"
# None of the ten suppliers here lacks a département.
MAY_BE_EMPTY = {"orphan_communes"}


def test_every_query_has_sql():
    # The optional text operators are not all expressible in SQL; those have tests of their own.
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    found = differences(spark, DATA, name, queries()[name], oracle_sql()[name])
    assert [f for f in found if f != "no rows" or name not in MAY_BE_EMPTY] == []


def test_entry(spark):
    assert entry(spark).count() > 0
