"""Every registered query against its SQL twin."""

import os

import pytest

from __spark_entry__ import entry
from farmledger.plans.catalog import REGISTRY
from tests.oracle import compare, connect

SF_DIR = os.environ.get("FARMLEDGER_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {name: q.run for name, q in REGISTRY.items()}
SQL = {name: q.oracle for name, q in REGISTRY.items() if q.oracle is not None}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql_twin(spark, duck, name):
    assert compare(duck, QUERIES[name](spark, SF_DIR), SQL[name]) == ""


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "discount_zone" in df.columns
