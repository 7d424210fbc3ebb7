"""The native operators' plans hold no Python, and no operator pairs everything."""

import re

import pytest

from sieveline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op6_line_dedup", "op7_url_rules"])
def test_native_operators_stay_in_the_jvm(spark, name):
    assert not re.search("Python|Pandas|Arrow", plan(QUERIES[name](spark, SF)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(spark, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(QUERIES[name](spark, SF)))
