"""One whole run over seeded data, twice."""

from __future__ import annotations

import threading
import time
from datetime import datetime

import pytest

from ledgersieve.datagen.inject import Bronze
from ledgersieve.datagen.synth import SyntheticOrders
from ledgersieve.operators.checks import ChecksFailed, kept_failures, run_checks
from ledgersieve.operators.steps import Step, StepFailed, StepsFailed, at_once, run_steps
from ledgersieve.plans import build
from ledgersieve.plans.build import run
from ledgersieve.plans.checks import silver_checks
from ledgersieve.plans.monitoring import RunHistory
from ledgersieve.plans.silver import silver_items, silver_suppliers
from ledgersieve.sources.tables import Warehouse


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    orders = spark.range(1, 2001).withColumnRenamed("id", "po_no")
    bronze = Bronze(SyntheticOrders(spark, orders, suppliers=20, seed=42)).stored()
    root = str(tmp_path_factory.mktemp("warehouse"))
    run(spark, bronze, root, datetime(2024, 1, 1))
    return run(spark, bronze, root, datetime(2024, 1, 2)), root


def test_staging_warns_eight_times_and_silver_passes(finished):
    result, _ = finished
    warned = {(r["table_name"], r["check_name"]) for r in result.staging_report.where("status = 'warn'").collect()}
    assert warned == {
        ("stg_po_headers", "unique_po_id"), ("stg_po_headers", "relationships_supplier_id"),
        ("stg_po_headers", "not_null_order_date"), ("stg_po_headers", "not_null_currency"),
        ("stg_po_headers", "accepted_values_currency"), ("stg_po_items", "not_null_description"),
        ("stg_po_items", "not_null_quantity"), ("stg_po_items", "delivery_before_order"),
    }
    assert result.silver_report.where("status <> 'pass'").count() == 0


def test_rules_find_every_issue_they_cover_and_nothing_else(finished):
    result, _ = finished
    covered = {"missing_currency", "invalid_currency", "bad_date_format", "orphan_supplier",
               "exact_duplicate_header", "delivery_before_order", "missing_item_field"}
    recall = {r["issue_type"]: r["recall_pct"] for r in result.recall.collect()}
    assert {i for i, pct in recall.items() if pct == 100.0} == covered
    assert {pct for i, pct in recall.items() if i not in covered} == {0.0}
    assert result.precision.where("not_in_log > 0").count() == 0
    assert result.precision.count() == 8


def test_each_run_is_in_the_history_once(finished):
    result, _ = finished
    assert result.history.select("run_at").distinct().count() == 2
    latest = RunHistory(result.history.sparkSession, f"{finished[1]}/monitoring/run_history").latest()
    assert {r["run_at"] for r in latest.collect()} == {datetime(2024, 1, 2)}


def test_tables_are_stored_per_layer(spark, finished):
    _, root = finished
    for layer, name in (("quarantine", "po_items"), ("silver", "po_headers"), ("evaluation", "issue_recall"),
                        ("profiling", "column_profile"), ("profiling", "pattern_checks"), ("monitoring", "row_accounting"),
                        ("test_failures", "stg_po_headers")):
        assert Warehouse(spark, root).table(layer, name).count() > 0


def test_a_lost_row_stops_the_run(spark, finished, tmp_path, monkeypatch):
    result, _ = finished
    assert result.accounting.where("unaccounted <> 0").count() == 0
    monkeypatch.setattr(build, "silver_items", lambda lines: silver_items(lines).where("item_no <> 10"))
    with pytest.raises(StepsFailed, match="po_items: ") as stopped:
        run(spark, result.layers.bronze, str(tmp_path), datetime(2024, 1, 3))
    assert set(stopped.value.outcome.failed) == {"accounting"}
    assert stopped.value.outcome.skipped == {"history": ("accounting",)}


def test_a_supplier_error_stops_only_what_needs_suppliers(spark, finished, tmp_path, monkeypatch):
    result, _ = finished
    monkeypatch.setattr(build, "silver_suppliers", lambda df: silver_suppliers(df).unionAll(silver_suppliers(df).limit(1)))
    with pytest.raises(StepsFailed, match="silver_suppliers.unique_supplier_id") as stopped:
        run(spark, result.layers.bronze, str(tmp_path), datetime(2024, 1, 3))
    outcome = stopped.value.outcome
    assert set(outcome.failed) == {"silver.suppliers"} and outcome.skipped == {"history": ("silver.suppliers",)}
    store = Warehouse(spark, str(tmp_path))
    assert store.table("silver", "po_items").count() == result.layers.silver["po_items"].count()
    assert store.table("monitoring", "row_accounting").where("unaccounted <> 0").count() == 0
    assert store.table("evaluation", "issue_recall").count() == result.recall.count()
    assert kept_failures(store, "silver_suppliers").count() == 1


def test_steps():
    def fail(done):
        raise StepFailed("no")

    steps = [Step("a", lambda d: 1), Step("b", fail), Step("c", lambda d: d["a"] + 1, ("a",)), Step("d", fail, ("b", "c")),
             Step("e", fail, ("d",))]
    outcome = run_steps(steps)
    assert (outcome.results, outcome.failed, outcome.skipped) == ({"a": 1, "c": 2}, {"b": "no"}, {"d": ("b",), "e": ("d",)})
    with pytest.raises(ValueError, match="not listed before"):
        run_steps([Step("x", fail, ("y",)), Step("y", fail)])
    with pytest.raises(ZeroDivisionError):  # not a verdict on an output: it ends the run
        run_steps([Step("x", lambda d: 1 // 0)])


def test_bad_silver_stops_the_run(finished):
    result, _ = finished
    tables = result.layers.checked_tables()
    tables["silver_po_headers"] = tables["silver_po_headers"].unionByName(tables["silver_po_headers"])
    with pytest.raises(ChecksFailed, match="silver_po_headers.unique_po_id"):
        run_checks(silver_checks([]), tables)


def test_works_at_once_all_end_before_a_failure_is_raised(spark):
    """Both of the first two wait for each other, so they must run side by side."""
    together, ended = threading.Barrier(2, timeout=30), []

    def fails():
        together.wait()
        raise ValueError("lost")

    def ends():
        together.wait()
        time.sleep(0.2)
        ended.append(True)

    with pytest.raises(ValueError, match="lost"):
        at_once(spark, [fails, ends])
    assert ended == [True] and at_once(spark, [lambda: 1, lambda: 2]) == [1, 2] and at_once(spark, []) == []
