"""Every registered query against its SQL statement, exact values."""

import pytest

from __spark_entry__ import entry
from checks.compare import compare, connect
from checks.oracle import statements as oracle_sql
from marketlens.plans.registry import queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_gives_expected_rows(spark, duck, sf_dir, name):
    assert compare(queries()[name](spark, sf_dir), duck, oracle_sql()[name]) == ""


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def test_entry_gives_rows(spark):
    result = entry(spark)
    assert result.columns == ["category", "revenue", "units", "orders"]
    assert result.count() > 0
