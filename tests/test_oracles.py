"""Every registered query against its oracle, whole results, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from testbed.compare import difference, oracle_connection
from testbed.oracles import SQL
from testbed.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(SQL)
    assert set(REGISTRY) <= set(entry.queries())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_oracle(spark, oracle, name):
    problem, _ = difference(REGISTRY[name](spark, SF_DIR), oracle, SQL[name])
    assert not problem


def test_entry_is_the_list_in_order(spark):
    ranks = [row.target_rank for row in entry.entry(spark).collect()]
    assert ranks == list(range(1, 26))
