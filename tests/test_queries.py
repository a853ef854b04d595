"""Every registered query against its SQL on the sf0.01 tables."""

import pytest

from check import compare
from workload import QUERIES, SQL


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    outcome = compare(spark, duck, QUERIES[name], SQL.get(name), sf_dir)
    assert outcome.startswith("ok") and "types differ" not in outcome, outcome


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
