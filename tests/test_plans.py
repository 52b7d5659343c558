"""Plans stay on the JVM, prune columns and avoid quadratic joins."""

import os

import pytest

from pitchline.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")

PLANNED = [n for n in sorted(QUERIES) if not n.startswith("stream_")]


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_quadratic_join_and_no_python(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in plan


def test_scan_reads_needed_columns_only(spark):
    plan = _plan(QUERIES["player_match_counters"](spark, SMALL))
    assert "value:double" not in plan.split("ReadSchema")[1]
    assert "PushedFilters: [IsNotNull(user_id), Not(EqualTo(user_id,0))]" in plan.replace("\n", " ")


def test_counting_is_a_hash_aggregate_with_partial(spark):
    plan = _plan(QUERIES["player_match_counters"](spark, SMALL))
    assert "partial_sum" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
