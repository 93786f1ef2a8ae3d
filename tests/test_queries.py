"""Registered queries against their oracle SQL, at the smallest scale.

``python -m workload.compare`` runs all of them at any scale.
"""

import os

import pytest

import __spark_entry__
from workload.compare import connect, difference
from workload.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, oracle, name):
    count, found = difference(spark, oracle, SF_DIR, name)
    assert found == ""
    assert count > 0


def test_entry(spark):
    top = __spark_entry__.entry(spark)
    assert top.columns == ["customer_name", "total_sales_usd"]
    assert top.count() == 20


def test_contract():
    """Every query of the warehouse has its SQL; of the optional ones, those that have none are
    models, tokenizers and searches."""
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries) and set(QUERIES) <= set(oracles)
    assert set(queries) - set(oracles) <= set(__spark_entry__.LLM_QUERIES)
