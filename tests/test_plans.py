"""Physical plans: filters and columns reach the scan, and no query pairs everything with everything."""

import os
import re

import pytest

from sieveline.plans import boxes, catalog, composed, files, ordering, pairs, relational, runs, selecting  # noqa: F401

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")

#: Joins of one row with one row.
ONE_ROW = {"coco_round_trip"}


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - ONE_ROW))
def test_no_cross_joins(spark, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(catalog.QUERIES[name](spark, SF)))


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(catalog.QUERIES["relevant_semi"](spark, SF))
    assert "EqualTo(quality,1)" in text and "EqualTo(toxic,1)" in text
    assert not re.search(r"ReadSchema: struct<[^>]*text", text)
    assert not re.search(r"ReadSchema: struct<[^>]*l_comment|ReadSchema: struct<[^>]*l_shipdate", plan(catalog.QUERIES["tpch_style_rollup"](spark, SF)))


def test_top_k_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(catalog.QUERIES["stable_sample_per_group"](spark, SF))
    assert "TakeOrderedAndProject" in plan(catalog.QUERIES["worst_n"](spark, SF))
