"""Every registered query runs on the smallest tables and equals its SQL twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, duck

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(ROOT)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    problem = compare(spark, con, name, ROOT)
    assert problem == "" or problem == "no rows" and name in oracle_sql(), problem


def test_every_twin_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
