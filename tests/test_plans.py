"""Plans: filters reach the scan, columns are pruned, nothing is joined by nested loop."""

import pytest

import __spark_entry__ as entry
from conftest import SF


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_filter_and_columns_reach_the_scan(spark, capsys):
    text = plan(entry.queries()["filter_between"](spark, SF), capsys)
    assert "GreaterThanOrEqual(p_retailprice,930.0)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_retailprice:double>" in text


def test_unused_order_history_is_not_read(spark, capsys):
    text = plan(entry.queries()["join_left_features"](spark, SF), capsys)
    assert "orders.parquet" not in text  # the churn flag is not a feature, so its source is pruned


def test_rank_is_limited_before_the_shuffle(spark, capsys):
    assert "WindowGroupLimit" in plan(entry.queries()["first_k_per_class"](spark, SF), capsys)


@pytest.mark.parametrize("name", ["join_left_ratio", "semi_membership", "tool_ticket_history", "tool_churn_risk",
                                  "baseline_join", "retention_action", "citation_join", "tool_search_kb"])
def test_no_nested_loops(spark, capsys, name):
    text = plan(entry.queries()[name](spark, SF), capsys)
    assert "NestedLoop" not in text and "CartesianProduct" not in text
