"""Every named query against its check, and the rules that hold for all of them."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest
from compare import compare, connect

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_check(spark, sf, duck, name):
    assert compare(spark, duck, name, QUERIES[name], CHECKS.get(name), sf) is None


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["pattern_frequency", "preflight", "riskcheck", "aggregate_category", "best_confidence"])
def test_relational_plans_hold_no_python(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_fact_filter_reaches_the_scan(spark, sf):
    plan = QUERIES["pattern_frequency"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan and "GreaterThanOrEqual(l_quantity,45.0)" in plan
