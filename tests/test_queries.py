"""Registered queries against their SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["lms_activity", "rule_ledger", "rule_reconciliation", "clean_sessions", "alert_followed_by_session",
         "build_followup_docs", "validate_followup_docs", "grade_stats", "fail_rate_by_school",
         "p1_p3_transition", "wide_enrolment", "integrity_report", "scan_typed_csv",
         "lineage_columns", "scan_jsonl", "text_confusion", "identity_near_miss", "identity_totals",
         "identity_accepted", "identity_resolution", "outlier_fence",
         "mann_whitney", "capacity_projection", "stage_counts", "csv_round_trip",
         "json_round_trip", "auc_roc_pr", "calibration_bins", "repair_alert_docs", "alert_docs_quarantine",
         "doc_lms_activity", "doc_notes_category_level"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    ok, message = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
