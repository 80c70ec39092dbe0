"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
from tallyloom.plans import ORACLE, QUERIES, models
from tests.oracle import database, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = ORACLE


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    frame = QUERIES[name](spark, FOLDER).toPandas()
    assert differences(frame, con.execute(SQL[name]).df()) is None


def test_every_query_but_the_models_has_sql():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(SQL) <= set(models.QUERIES)


EAGER = {*models.QUERIES, "nn_tour", "route_cost", "best_route", "exact_tour", "study_table", "study_audit", "study_rejects"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plan_has_no_product_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert bad not in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0
