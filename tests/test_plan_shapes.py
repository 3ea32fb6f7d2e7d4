"""Structural guards on the physical plans of every registered query: no
nested-loop or Cartesian joins, no Python evaluation, and ordered windows
only where a distinct step has already reduced the rows (sampling index)."""

import pytest

import __spark_entry__ as E
from plotwise.plans import catalog

SF = "/root/testdata/sf0.001"
WINDOW_OK = {"sampling_index", "adjacent_impute", "adjacent_impute_totals", "imputation_precedence",
             "cover_over_time", "community_chain"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name}: {bad}"
    if name not in WINDOW_OK:
        assert "Window" not in plan, f"{name}: unexpected window"
