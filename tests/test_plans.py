"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest

from larkspan.plans import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filters_and_columns_reach_the_scan(spark, data):
    text = plan(QUERIES["discount_forecast"](spark, data))
    assert "PushedFilters" in text and "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_quantity,24.0)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert {x.split(":")[0] for x in schema.split(",")} == {"l_quantity", "l_extendedprice", "l_discount", "l_shipdate"}


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n not in ("join_cross", "vector_top_k") and not n.startswith(("stream_", "file_"))])
def test_no_nested_loops(name, spark, data):
    text = plan(QUERIES[name](spark, data))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_k_is_not_a_full_sort(spark, data):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_k"](spark, data))
    assert "WindowGroupLimit" in plan(QUERIES["top_k_per_group"](spark, data))
    assert "WindowGroupLimit" in plan(QUERIES["window_qualify"](spark, data))


def test_aggregates_combine_before_the_shuffle(spark, data):
    text = plan(QUERIES["pricing_summary"](spark, data))
    assert "partial_sum" in text and text.count("Exchange") and "Python" not in text
