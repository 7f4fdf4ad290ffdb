"""Every registered query against SQL on the same tables."""

import pytest

import __spark_entry__ as registry
from tests.comparing import assert_same, duck

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(MEDIUM)


def test_every_query_has_sql():
    assert set(registry.core_queries()) == set(registry.core_sql())


@pytest.mark.parametrize("name", sorted(registry.core_sql()))
def test_query_equals_sql(spark, connection, name):
    assert_same(registry.core_queries()[name](spark, MEDIUM), connection, registry.core_sql()[name])


def test_entry(spark):
    assert registry.entry(spark).count() == 6000
