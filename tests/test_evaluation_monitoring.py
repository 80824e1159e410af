from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgersieve.plans import evaluation, monitoring
from ledgersieve.plans.views import latest_run_view
from ledgersieve.sources import files

KEY = "table_name string, record_id string, issue_type string, detail string, ml_target string"
BAD = "table_name string, record_id string, rule_name string, reason string"


@pytest.fixture
def scored(spark):
    log = [
        ("h", "P1", "missing_currency", "", "False"), ("h", "P1", "missing_currency", "again", "False"),
        ("h", "P2", "missing_currency", "", "False"), ("i", "P3|10", "missing_item_field", "", "False"),
        ("i", "P3|20", "price_outlier", "", "True"), ("h", "N1", "near_duplicate_po", "", "False"),
        ("h", None, "bad_date_format", "", "False"),
    ]
    bad = [
        ("h", "P1", "missing_currency", ""), ("h", "P7", "missing_currency", ""),
        ("i", "P3|10", "missing_quantity", ""), ("i", "P3|10", "missing_description", ""),
        ("i", "P3|20", "parent_po_quarantined", ""), ("h", None, "bad_date_format", ""),
    ]
    return spark.createDataFrame(log, KEY), spark.createDataFrame(bad, BAD), evaluation.issue_rule_map(spark)


def test_recall(scored, rows):
    assert rows(evaluation.issue_recall(*scored)) == sorted([
        ("missing_currency", "Rule-based validation", 2, 1, 50.0),
        ("missing_item_field", "Rule-based validation", 1, 1, 100.0),
        ("price_outlier", "ML anomaly detection", 1, 0, 0.0),
        ("near_duplicate_po", "Fuzzy matching (not built yet)", 1, 0, 0.0),
        ("bad_date_format", "Rule-based validation", 1, 0, 0.0),
    ], key=repr)


def test_recall_reduces_the_quarantine_before_it_is_shuffled(scored):
    plan = evaluation.issue_recall(*scored)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(issue_type") < plan.index("LeftSemi")
    assert "BroadcastHashJoin [_slot" in plan


def test_precision_counts_pairs(scored, rows):
    # P1 is logged twice, so its quarantine row pairs twice.
    assert rows(evaluation.rule_precision(*scored)) == [
        ("bad_date_format", 1, 0, 1), ("missing_currency", 3, 2, 1),
        ("missing_description", 1, 1, 0), ("missing_quantity", 1, 1, 0),
    ]


def test_rule_map(spark):
    pairs = [tuple(r) for r in evaluation.issue_rule_map(spark).collect()]
    assert len(pairs) == 8
    assert {rule for issue, rule in pairs if issue == "missing_item_field"} == {"missing_description", "missing_quantity"}
    assert ("exact_duplicate_header", "duplicate_po_id") in pairs


def metrics(spark, run_at, size=4):
    staging = {"po": spark.range(size), "empty": spark.range(0)}
    bad = spark.createDataFrame([("po", "P1", "broken", "")], BAD)
    return monitoring.run_metrics(staging, {"po": spark.range(3)}, bad, run_at)


def test_metrics(spark, rows):
    got = rows(metrics(spark, datetime(2024, 1, 1)), "table_name", "metric", "value", "pct_of_staging")
    assert got == sorted([
        ("po", "rows_in_staging", 4, 100.0), ("po", "rows_in_silver", 3, 75.0),
        ("po", "quarantined_by_broken", 1, 25.0), ("empty", "rows_in_staging", 0, None),
    ], key=repr)


def test_history_is_appended_and_the_latest_run_shown(spark, tmp_path, rows):
    history = monitoring.RunHistory(spark, str(tmp_path / "history"))
    assert history.latest().count() == 0
    first, later = datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 9)
    history.append(metrics(spark, later, size=6), later)
    history.append(metrics(spark, first), first)
    assert history.rows().count() == 8
    latest = history.latest()
    assert {r["run_at"] for r in latest.collect()} == {later}
    assert [r["table_name"] for r in latest.collect()] == ["empty", "po", "po", "po"]
    assert all(history.run_id(later) in f for f in latest.inputFiles())
    with pytest.raises(ValueError, match="already holds"):
        history.append(metrics(spark, later), later)
    assert rows(latest_run_view(history)) == rows(latest)
    history.full_refresh(metrics(spark, first), first)
    assert history.rows().count() == 4


def test_of_two_runs_at_once_one_is_refused_whole(spark, tmp_path, monkeypatch):
    """Both runs have written their rows before either gets its name."""
    history, run_at = monitoring.RunHistory(spark, str(tmp_path)), datetime(2024, 1, 1)
    publish, between = files.publish, []

    def interleaved(*args):
        if not between:
            between.append(True)
            history.append(metrics(spark, run_at, size=9), run_at)
        publish(*args)

    monkeypatch.setattr(files, "publish", interleaved)
    with pytest.raises(ValueError, match="already holds"):
        history.append(metrics(spark, run_at, size=5), run_at)
    kept = history.rows().where("metric = 'rows_in_staging' AND table_name = 'po'").collect()
    assert [r["value"] for r in kept] == [9]
    assert history.rows().count() == 4
    assert [n for n in files.names(spark, str(tmp_path)) if n.startswith("_run")] == []


def test_readers_keep_the_old_runs_until_a_refresh_is_complete(spark, tmp_path):
    history, run_at = monitoring.RunHistory(spark, str(tmp_path)), datetime(2024, 1, 1)
    history.append(metrics(spark, run_at), run_at)
    broken = metrics(spark, datetime(2024, 1, 2)).withColumn("value", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        history.full_refresh(broken, datetime(2024, 1, 2))
    assert {r["run_at"] for r in history.rows().collect()} == {run_at}
