"""Every registered query against its DuckDB twin, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from fixtures.oracles import all_oracles
from fixtures.queries import all_queries
from tests.compare import TESTDATA, connect, differences

SF_DIR = str(TESTDATA / "sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_twin(spark, con, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert differences(result, con, entry.oracle_sql()[name]) == []


def test_entry_selects_works(spark):
    assert 0 < entry.entry(spark).count() <= 25
