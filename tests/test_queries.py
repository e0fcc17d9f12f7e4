"""Every registered query of the library against its SQL twin."""

import pytest

import __spark_entry__ as entry_module
from compare import differences
from oracle.queries import all_sql
from provtrail.registry import all_queries

QUERIES = all_queries()
SQL = all_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_all_are_registered_with_the_driver():
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(name, spark, sf_dir, duck):
    assert differences(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None
