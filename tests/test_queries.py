"""Every registered query: against its SQL where there is one, else that it gives rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_point
from compare import connect, differences

from ledgerlark.plans import ORACLE, QUERIES

SLOW = {"rf_scores", "gbt_scores", "param_search", "model_comparison", "cv_metrics", "fitted_transforms", "full_validation"}


@pytest.fixture(scope="module")
def tables(folder):
    return connect(folder)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_query_equals_sql(spark, folder, tables, name):
    rows = QUERIES[name](spark, folder).toPandas()
    assert differences(rows, tables.execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE and n not in SLOW])
def test_query_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).limit(1).count() == 1


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_oracle_names_are_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
