"""Every query of the training-data operators that has SQL against it, and the registration of the pipeline."""

import os

import pytest

import __spark_entry__ as entry
from tallyloom.llm.queries import ORACLE, QUERIES
from tests.oracle import database, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    frame = QUERIES[name](spark, FOLDER).toPandas()
    assert differences(frame, database(FOLDER).execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", ["op3_decontamination", "op5_quality_rules", "op10_chat_formatting"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert bad not in plan


def test_all_are_registered():
    names = set(entry.queries())
    assert {int(name[2:].split("_")[0]) for name in names if name in QUERIES} == set(range(1, 14)) and "pipeline" in names
