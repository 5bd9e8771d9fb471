"""Every checked query against its SQL on the smallest tables; the rest must return rows."""

import pytest

from checks.compare import difference
from checks.queries import QUERIES, SQL
from conftest import SMALL

# No positive label in the holdout month of the smallest tables.
NEEDS_LARGER_TABLES = {"holdout_auc"}
# Fits of 500 rounds; test_models and test_trees run their steps with fewer.
SLOW = {"final_scores", "gbt_wide_scores", "gbt_selected_scores", "importance_top20"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sql, name):
    assert difference(QUERIES[name](spark, SMALL), sql, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - NEEDS_LARGER_TABLES - SLOW))
def test_query_returns_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as contract
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).limit(1).count() == 1
