"""Every checked query against its SQL twin."""

import os

import pytest
from compare import check, duck

from __spark_entry__ import entry
from tracewell.plans import all_oracles as oracle_sql
from tracewell.plans import all_queries as queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    problem, _ = check(spark, con, name, queries()[name], oracle_sql().get(name), SF)
    assert problem is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["conv_id", "text", "n_turns"] and df.count() > 0


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())
