"""Every registered query equals its SQL twin on the smallest test data."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import oracle
from check import compare, connect


@pytest.fixture(scope="module")
def db():
    return connect(contract.SMOKE_DIR)


def test_every_query_has_a_twin():
    star_queries = contract.queries().keys() - contract._llm_queries().keys()
    assert star_queries == oracle.QUERIES.keys()


@pytest.mark.parametrize("name", sorted(oracle.QUERIES))
def test_query(spark, db, name):
    assert compare(spark, db, contract.SMOKE_DIR, name) == ""


def test_flagship(spark):
    assert contract.entry(spark).columns == ["country_name", "report_count", "weighted_reports"]
