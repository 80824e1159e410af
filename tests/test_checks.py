from __future__ import annotations

from datetime import date

import pytest

from ledgersieve.operators import checks as c
from ledgersieve.operators.skew import HotKey
from ledgersieve.plans.checks import delivered_before_ordered, silver_checks, staging_checks
from ledgersieve.sources.tables import Warehouse


@pytest.fixture
def people(spark):
    data = [("a", "DE"), ("a", "XX"), ("b", None), (None, "XX"), ("c", "YY")]
    return spark.createDataFrame(data, "id string, country string")


def test_failing_rows_of_each_kind(spark, people, rows):
    assert rows(c.not_null(people, "country")) == [("b", None)]
    assert rows(c.unique(people, "id")) == [("a", 2)]
    assert rows(c.unique(people, "id", "country")) == []
    assert rows(c.accepted_values(people, "country", ["DE"])) == [("XX", 2), ("YY", 1)]
    parents = spark.createDataFrame([("a",), ("a",)], "key string")
    assert rows(c.relationships(people, "id", parents, "key")) == [("b", None), ("c", "YY")]


def test_counts_agree_with_failing_rows(people):
    checks = [
        c.Check("people", "not_null", "country"), c.Check("people", "not_null", "id"),
        c.Check("people", "unique", "id"), c.Check("people", "accepted_values", "country", values=("DE",)),
        c.Check("people", "relationships", "id", parent="people", parent_column="country"),
    ]
    tables = {"people": people}
    counts = {r["check_name"]: r["failures"] for r in c.failure_counts(checks, tables).collect()}
    assert counts == {check.label: c.failing_rows(check, tables).count() for check in checks}


def test_errors_stop_after_everything_is_stored(spark, people, tmp_path, rows):
    checks = [
        c.Check("people", "not_null", "country", severity="error"),
        c.Check("people", "unique", "id"), c.Check("people", "not_null", "id"),
        c.Check("people", "accepted_values", "country", values=("DE", "XX", "YY"), severity="error"),
    ]
    store = Warehouse(spark, str(tmp_path))
    with pytest.raises(c.ChecksFailed, match="people.not_null_country"):
        c.run_checks(checks, {"people": people}, store)
    kept = c.kept_failures(store, "people").groupBy("check_name").count()
    assert rows(kept) == [("not_null_country", 1), ("not_null_id", 1), ("unique_id", 1)]


def test_one_sink_holds_what_every_check_finds(spark, people, tmp_path, rows):
    """Rows come back typed, and are those that each check finds on its own."""
    parents = spark.createDataFrame([("a", 1.5), ("c", 2.5), ("a", 2.5)], "key string, rate double")
    checks = [
        c.Check("people", "not_null", "country"), c.Check("people", "not_null", "id"), c.Check("people", "unique", "id"),
        c.Check("people", "unique", "country"), c.Check("people", "accepted_values", "country", values=("DE",)),
        c.Check("people", "relationships", "id", parent="parents", parent_column="key"),
        c.Check("people", "relationships", "id", name="again", parent="parents", parent_column="key", hot=(HotKey("a", 2),)),
        c.Check("people", "custom", name="own", rows=lambda t: t["people"].selectExpr("id", "2 AS times"), weight="times"),
        c.Check("parents", "unique", "rate"), c.Check("parents", "not_null", "rate"),
    ]
    tables, store = {"people": people, "parents": parents}, Warehouse(spark, str(tmp_path))
    report = {(r["table_name"], r["check_name"]): r for r in c.run_checks(checks, tables, store).collect()}
    for check in checks:
        found = c.failing_rows(check, tables)
        assert rows(c.read_failures(store, check.table, check.label, found.schema)) == rows(found), check.label
        failures = 2 * found.count() if check.weight else found.count()
        row = report[check.table, check.label]
        assert (row["failures"], row["status"]) == (failures, "warn" if failures else "pass")
    plain = {(r["table_name"], r["check_name"]): r for r in c.check_report(checks, tables).collect()}
    assert plain == report


def test_warnings_do_not_stop(people):
    report = c.run_checks([c.Check("people", "not_null", "id")], {"people": people})
    assert [tuple(r) for r in report.collect()] == [("people", "not_null_id", "warn", 1, "warn")]


def test_unknown_kind_is_refused(people):
    with pytest.raises(ValueError):
        c.failing_rows(c.Check("people", "sorted", "id"), {"people": people})


def test_early_delivery_counts_every_header_copy(spark, rows):
    day = lambda n: date(2024, 1, n)
    items = spark.createDataFrame(
        [("P", 10, day(5)), ("P", 20, day(15)), ("Q", 10, None)], "po_id string, item_no int, delivery_date date")
    headers = spark.createDataFrame(
        [("P", day(10)), ("P", day(10)), ("P", day(20)), ("P", None), ("Q", day(1))], "po_id string, order_date date")
    assert rows(delivered_before_ordered(items, headers)) == [
        ("P", 10, day(10), day(5), 2), ("P", 10, day(20), day(5), 1), ("P", 20, day(20), day(15), 1)]


def test_twenty_eight_instances():
    staging, silver = staging_checks([]), silver_checks([])
    assert (len(staging), len(silver)) == (16, 12)
    assert {x.severity for x in staging} == {"warn"} and {x.severity for x in silver} == {"error"}


def test_lines_without_a_parent_and_early_lines_meet_only_what_they_need(spark):
    d = lambda n: date(2024, 1, n)
    headers = spark.createDataFrame([("A", d(5)), ("A", d(5)), ("A", d(9)), ("B", d(2)), ("B", None), (None, d(3))], "po_id string, order_date date")
    items = spark.createDataFrame(
        [("A", 1, d(7)), ("A", 1, d(7)), ("A", 2, d(1)), ("A", 3, d(9)), ("B", 1, None), ("C", 1, d(1)), ("C", 1, d(1)), (None, 1, d(1))],
        "po_id string, item_no int, delivery_date date")
    early = sorted(tuple(r) for r in delivered_before_ordered(items, headers).collect())
    assert early == [("A", 1, d(9), d(7), 1)] * 2 + [("A", 2, d(5), d(1), 2), ("A", 2, d(9), d(1), 1)]
    checks = [c.Check("items", "relationships", "po_id", parent="headers", parent_column="po_id"), c.Check("items", "not_null", "po_id")]
    tagged = c.tagged_failures(checks, {"items": items, "headers": headers})
    assert sorted(r.check_name for r in tagged.collect()) == ["not_null_po_id"] + ["relationships_po_id"] * 2
    assert sum("_lost_" in c for c in tagged._jdf.queryExecution().analyzed().toString().split()) > 0


def test_placed_rows_are_written_in_buckets_without_a_sort(spark, tmp_path):
    from ledgersieve.sources.tables import write_buckets

    conf = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(conf)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(1000).selectExpr("concat('k', id % 37) AS k", "id")
    for i, df in enumerate((rows.repartition(parts, "k"), rows.repartition(3))):  # the second meets every bucket in each task
        stored = write_buckets(df, str(tmp_path / str(i)), ["k"])
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
        grouped = stored.groupBy("k").count()
        assert grouped.count() == 37 and "Exchange hashpartitioning(k" not in grouped._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(conf) == before


def test_rows_that_pass_are_left_out_before_lists_are_made(spark):
    """Lists are not compiled, so only failing rows may reach them."""
    df = spark.createDataFrame([("a", None), (None, None), ("b", "x"), ("b", "y")], "k string, v string")
    kinds = [c.Check("t", "not_null", "k"), c.Check("t", "not_null", "v"), c.Check("t", "unique", "k"), c.Check("t", "accepted_values", "v", values=("x",))]
    found = c.tagged_failures(kinds, {"t": df})
    assert "lambda" not in "".join(x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x)
    assert sorted((r["check_name"], r["row"]) for r in found.collect()) == [
        ("accepted_values_v", '{"v":"y","n_records":1}'), ("not_null_k", '{"k":null,"v":null}'),
        ("not_null_v", '{"k":"a","v":null}'), ("not_null_v", '{"k":null,"v":null}'), ("unique_k", '{"k":"b","n_records":2}')]
