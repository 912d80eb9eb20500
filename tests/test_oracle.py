"""Registered queries against their SQL, on the smallest tables."""

import pytest

from checks.compare import compare, duck
from checks.oracle import ORACLE
from checks.spark_queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    diff, n = compare(spark, con, SF, QUERIES[name], ORACLE[name])
    assert diff == "" and n > 0
