"""Every query with SQL is compared value by value; plans are checked for what must not occur."""

import re

import pytest

from tallystone.plans import catalog
from tools.check_oracles import compare, connect

# left to the driver's own run: the model tests cover the same code on smaller tables
SLOW = {
    "cross_validation", "cross_validation_summary", "random_search", "train_boosted_trees", "permutation_importance",
    "train_boosted_trees_second_preset", "train_random_forest", "native_importance", "batch_scoring",
    "analysis_report", "preparation_shift", "stream_scoring", "search_logistic_regression", "training_run", "training_run_baselines",
}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SLOW))
def test_query(spark, con, sf, name):
    ok, note = compare(spark, con, sf, name)
    assert ok, note


PLANNED = ["numeric_projection", "crosstab", "duplicate_rows", "top_values", "chi_square", "evaluate", "missing_report", "spearman"]


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join(spark, sf, name):
    plan = catalog.queries()[name](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_scans_read_only_what_they_need(spark, sf):
    plan = catalog.queries()["threshold_filter"](spark, sf)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,400000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
    plan = catalog.queries()["missing_report"](spark, sf)._jdf.queryExecution().toString()
    assert "l_extendedprice" not in plan.split("== Physical Plan ==")[1]


def test_top_values_are_cut_before_the_shuffle(spark, sf):
    plan = catalog.queries()["top_values"](spark, sf)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
