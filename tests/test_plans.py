"""Physical plans: what reaches the scan, what is kept out of the plans, what is cut before a shuffle."""

import re

import pytest

import suite.registry as registry

FOLDER = "/root/testdata/sf0.001"
# Queries that run jobs or streams while they are built.
EAGER = {n for n in registry.QUERIES if n.startswith(("s1", "s2_status_windows", "s3", "a1", "a4", "a5", "m2", "m3_predictions", "m6_feature", "p1_clean_twice", "p1_clean_figures"))}


def plan(spark, name):
    frame = registry.QUERIES[name](spark, FOLDER)
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - EAGER))
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert node not in text, node


@pytest.mark.parametrize("name", ["e1_latest_attempt", "e3_trailing_means", "e2_first_target_per_language", "w1_new_cleaned_rows", "c13_resolve_aliases"])
def test_first_rows_are_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, name))


@pytest.mark.parametrize("name", ["e6_newest_first", "b8_field_values", "c2_raw_with_details_newest", "d16_recent_failures", "e7_fixed_sample"])
def test_limits_are_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "b2_id_ranges")
    assert "PushedFilters: [Or(" in text or "GreaterThanOrEqual(doc_id,10)" in text
    text = plan(spark, "b5_recent_attempts")
    assert "GreaterThanOrEqual(ts," in text
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(spark, "d5_failed_by_error")).group(1)
    assert "value" not in read and "user_id" not in read
    window = plan(spark, "d19_sample_counts")
    assert "l_returnflag" in window and "l_tax" not in re.search(r"ReadSchema: struct<l_[^>]*>", window).group(0)


def test_selections_do_not_sort(spark):
    for name in ("b4_by_cleaner", "b6_title_contains", "b10_select_targets", "c1_by_status_name", "c4_attempts_with_details"):
        assert not re.search(r"\bSort \[", plan(spark, name).replace("SortMergeJoin", "")) or "SortMergeJoin" in plan(spark, name), name
        assert "rangepartitioning" not in plan(spark, name), name


def test_counts_are_aggregated_before_the_shuffle(spark):
    for name in ("d1_raw_status_counts", "d5_attempt_statistics", "d9_collection_status_counts"):
        assert "partial_count" in plan(spark, name)
