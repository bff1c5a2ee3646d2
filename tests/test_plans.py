"""What the plans must look like: pushed filters, pruned columns, joins by equal keys, partial aggregates."""

import os

import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def plan(spark, name):
    df = __spark_entry__.queries()[name](spark, SF)
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filters_reach_the_scan(spark):
    text = plan(spark, "roster")
    pushed = next(x for x in text.split("\n") if x.startswith("PushedFilters") and "c_acctbal" in x)
    assert "c_mktsegment" in pushed and "GreaterThan(c_acctbal,0.0)" in pushed


@pytest.mark.parametrize(("name", "unread"), [("gpa_by_group", "o_totalprice"), ("html_links", "url"), ("tf_relevance", "n_chars"), ("status_counts", "o_totalprice")])
def test_columns_are_pruned(spark, name, unread):
    schemas = [x for x in plan(spark, name).split("\n") if x.startswith("ReadSchema")]
    assert schemas and not any(unread in x for x in schemas)


@pytest.mark.parametrize("name", ["conflict_pairs", "code_division_conflict", "bucketed_overlap", "half_open_overlap_status", "snapshot_diff", "next_event_asof", "new_row_detection", "required_gap"])
def test_no_nested_loops_over_facts(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and (name == "required_gap" or "NestedLoop" not in text)


@pytest.mark.parametrize("name", ["gpa_by_student", "derived_state", "kind_histogram"])
def test_aggregates_are_partial_first(spark, name):
    assert "partial_" in plan(spark, name)


def test_best_rows_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "best_attempt")


def nodes(text, kind):
    """The descriptions of a plan's nodes of a kind."""
    return [part for part in text.split("\n\n") if part.split("\n")[0].split(" ", 1)[-1].startswith(kind)]


def test_conflicts_join_by_period_and_bookings_by_stretch(spark):
    joins = [j for j in nodes(plan(spark, "conflict_pairs"), "SortMergeJoin") + nodes(plan(spark, "conflict_pairs"), "BroadcastHashJoin")]
    assert joins and all("period" in j.split("Left keys")[1].split("\n")[0] for j in joins)
    joins = nodes(plan(spark, "half_open_overlap_status"), "SortMergeJoin") + nodes(plan(spark, "half_open_overlap_status"), "BroadcastHashJoin")
    assert joins and all("__k" in j.split("Left keys")[1].split("\n")[0] for j in joins)


@pytest.mark.parametrize("name", ["text_relevance", "unified_search"])
def test_scores_are_made_once(spark, name):
    text = plan(spark, name)
    assert nodes(text, "Generate") and not any("regexp_replace" in f.split("Condition")[-1] for f in nodes(text, "Filter"))


def test_lists_of_pages_take_a_bounded_top(spark):
    assert "TakeOrderedAndProject" in plan(spark, "cross_department") and "TakeOrderedAndProject" in plan(spark, "submitted_grades")


def test_pairs_of_conflicts_are_not_shuffled(spark):
    text = plan(spark, "conflict_pairs")
    assert not nodes(text, "HashAggregate") and len(nodes(text, "Exchange")) <= 2


def test_meetings_by_room_are_not_broadcast_or_repeated_by_week(spark):
    joins = nodes(plan(spark, "room_now"), "SortMergeJoin")
    assert any("period" in j.split("Left keys")[1].split("\n")[0] for j in joins)


def test_lookups_of_courses_keep_the_best_only(spark):
    assert not nodes(plan(spark, "course_lookup"), "Window")
