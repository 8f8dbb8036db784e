"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

from __spark_entry__ import LLM_QUERIES, entry, oracle_sql, queries
from checks.compare import differences, oracle_connection

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(DATA)


OWN = sorted(set(queries()) - set(LLM_QUERIES))


def test_names():
    assert set(oracle_sql()) - set(LLM_QUERIES) == set(OWN)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    got = queries()[name](spark, DATA).toPandas()
    assert differences(got, con.execute(oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert entry(spark).count() == 7
