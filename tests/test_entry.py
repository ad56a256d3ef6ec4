"""Driver contract: entry() and every registered query run on sf0.001."""

import pytest

import __spark_entry__ as E

# the training-data queries are tested in tests/llm
OWN = E.registry.all_queries()
FAST = list(OWN)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "report_hour" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(OWN) <= set(q)
    assert set(OWN) == set(E.registry.all_oracle_sql())


@pytest.mark.parametrize("name", FAST)
def test_query_runs_on_smallest_scale(spark, sf0001, name):
    df = E.queries()[name](spark, sf0001)
    df.limit(1).collect()
    assert len(df.columns) == len(set(df.columns))


FORBIDDEN_PLAN_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                        "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", [k for k in OWN if not k.startswith("stream_")])
def test_plans_stay_jvm_side_without_cross_joins(spark, sf0001, name):
    plan = E.queries()[name](spark, sf0001)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in FORBIDDEN_PLAN_NODES if n in plan]
