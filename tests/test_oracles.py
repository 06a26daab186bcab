"""Every ledger query against its SQL on the same tables."""

import pytest
from compare import same

from tidemark.oracles import SQL
from tidemark.queries import QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, sf_dir, name):
    same(QUERIES[name](spark, sf_dir).toPandas(), duck.sql(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_needs_no_training_data_package(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
