"""Filters and columns reach the file scan."""

import __spark_entry__ as entry

FOLDER = entry.SMOKE_FOLDER


def plan(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    lookup = plan(spark, "q_point_lookup")
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,42)]" in lookup
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in lookup
    assert "ReadSchema: struct<event_type:string>" in plan(spark, "q_list_splits")
    assert "PushedFilters: [In(lang, [en,fr])]" in plan(spark, "q_multi_split_scan")
