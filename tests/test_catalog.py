"""Every registered query runs on the test tables and equals its SQL statement."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from starmill.catalog import ORACLES, QUERIES
from tools.check_queries import compare, connect

WITHOUT_SQL = {
    "chart_keyword_map", "ml_fit", "ml_predict", "ml_eval_summary", "ml_metrics",
    "ml_coefficients",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_entry_points(spark, sf_dir):
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    if entry_points.SMOKE_DIR == sf_dir:
        assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    assert compare(duck, QUERIES[name](spark, sf_dir), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_other_queries_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
