"""Shape of the physical plans: pruned scans, no nested-loop joins, raw rows shuffled once."""

from __future__ import annotations

import re

import pytest

from callsieve import plans

SF = "/root/testdata/sf0.001"
LAZY = ["number_risk", "salted_partial", "skew_report", "hot_rows_semi", "complaint_features_20", "behavior_features_31",
        "pr_curve", "roc_auc", "psi_bins", "drift_report", "ab_ztest", "running_consensus", "running_dominant_category",
        "asof_reputation", "stream_features_running", "report_sessions", "phone_consensus", "blacklist_merged", "score_lookup"]


def plan(spark, name):
    df = plans.QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEval" not in text


def test_columns_are_pruned_at_the_scan(spark):
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, "key_frequency")))
    assert schemas == {"user_id:bigint,props:string"}


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [In(event_type" in plan(spark, "report_sessions")


def test_risk_reads_once_and_combines_before_the_first_shuffle(spark):
    text = plan(spark, "number_risk")
    assert text.count("FileScan") == 1 and "Join" not in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    # Bottom-up: the partial aggregation sits between the scan and the lowest exchange by number.
    assert text.rindex("partial_count") > text.rindex("Exchange hashpartitioning(phone_number")
