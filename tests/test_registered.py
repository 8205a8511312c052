"""Every registered query against its DuckDB statement, or for stable rows without one."""

import pytest

import __spark_entry__ as entry
from compare import differences

QUERIES = entry.queries()
STATEMENTS = entry.oracle_sql()


def test_statements_name_registered_queries():
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_equals_statement(name, spark, sf_dir, duck):
    assert differences(QUERIES[name](spark, sf_dir), duck, STATEMENTS[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STATEMENTS)))
def test_has_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
