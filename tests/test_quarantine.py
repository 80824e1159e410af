"""Hand-made rows for each rule and for the awkward cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgersieve.functions.convert import line_key
from ledgersieve.operators.skew import HotKey
from ledgersieve.plans.monitoring import row_accounting
from ledgersieve.plans.quarantine import judge_headers, judge_lines, quarantine_headers, quarantine_items
from ledgersieve.plans.silver import silver_headers, silver_items
from ledgersieve.plans.staging import stage_headers, stage_items, stage_suppliers
from ledgersieve.schemas import PO_HEADERS_RAW, PO_ITEMS_RAW, SUPPLIERS_RAW
from ledgersieve.sources.cut import new_folder
from ledgersieve.sources.tables import write_buckets

SUPPLIERS = [("S1", "One, Ltd", "DE", "NET30", "2020-01-01"), ("S1", "Again", "DE", "NET30", "bad")]
GOOD = ("P1", "S1", "2024-01-10", "EUR", "5.00")


class Case:
    def __init__(self, spark, headers, items=()):
        self.suppliers = stage_suppliers(spark.createDataFrame(SUPPLIERS, SUPPLIERS_RAW))
        self.headers = stage_headers(spark.createDataFrame(headers, PO_HEADERS_RAW))
        self.items = stage_items(spark.createDataFrame(list(items), PO_ITEMS_RAW))
        self.judged = judge_headers(self.headers, self.suppliers)
        self.bad_headers = quarantine_headers(self.judged)
        self.lines = judge_lines(self.items, self.judged)
        self.bad_items = quarantine_items(self.lines)
        self.silver_headers = silver_headers(self.judged)
        self.silver_items = silver_items(self.lines)

    def accounting(self):
        table = row_accounting(self.headers, self.items, self.silver_headers, self.silver_items,
                               self.bad_headers, self.bad_items)
        return {r["table_name"]: r.asDict() for r in table.collect()}


def test_header_rules_and_reasons(spark, rows):
    case = Case(spark, [
        GOOD,
        ("P2", "S1", "2024-01-10", None, "1"),
        ("P3", "S1", "2024-01-10", "euro", "1"),
        ("P4", "S1", "10.01.2024", " usd ", "1"),
        ("P5", "S1", None, "USD", "1"),
        ("P6", "S9", "2024-01-10", "USD", "1"),
        ("P7", None, "2024-01-10", "USD", "x"),
        ("P8", "S1", "2024-02-30", "  ", "1"),
    ])
    assert rows(case.bad_headers, "record_id", "rule_name", "reason") == sorted([
        ("P2", "missing_currency", "currency is NULL"),
        ("P3", "invalid_currency", "currency is not EUR or USD: EURO"),
        ("P4", "bad_date_format", "order_date is not a valid YYYY-MM-DD date: 10.01.2024"),
        ("P5", "missing_order_date", "order_date is NULL"),
        ("P6", "orphan_supplier", "supplier_id not found in suppliers: S9"),
        ("P8", "bad_date_format", "order_date is not a valid YYYY-MM-DD date: 2024-02-30"),
        ("P8", "invalid_currency", "currency is not EUR or USD: "),
    ], key=repr)
    # No rule covers a missing supplier or an unreadable amount.
    assert rows(case.silver_headers, "po_id", "total_amount") == rows(
        case.headers.where("po_id in ('P1', 'P7')"), "po_id", "total_amount")
    assert set(r["table_name"] for r in case.bad_headers.collect()) == {"po_headers"}


def test_first_copy_is_kept_and_extra_copies_are_logged(spark, rows):
    case = Case(spark, [
        GOOD, GOOD, GOOD,
        ("P2", "S1", None, "EUR", "1"), ("P2", "S1", "2024-03-01", "USD", "2"),
        ("P3", "S1", "2024-03-01", "XXX", "1"), ("P3", "S1", "2024-03-02", "EUR", "1"),
    ])
    assert rows(case.bad_headers, "record_id", "rule_name") == [
        ("P1", "duplicate_po_id"), ("P1", "duplicate_po_id"), ("P2", "duplicate_po_id"),
        ("P3", "duplicate_po_id"), ("P3", "invalid_currency"),
    ]
    # The dated copy wins over the one without a date.
    assert rows(case.silver_headers, "po_id", "currency") == [("P1", "EUR"), ("P2", "USD")]
    assert case.accounting()["po_headers"]["unaccounted"] == 0


def test_header_without_key_is_logged_not_lost(spark, rows):
    case = Case(spark, [GOOD, (None, "S1", "2024-01-01", "EUR", "1"), (None, "S1", "2024-01-02", "EUR", "1")])
    assert rows(case.bad_headers, "record_id", "rule_name") == [(None, "duplicate_po_id"), (None, "missing_key")]
    assert rows(case.silver_headers, "po_id") == [("P1",)]
    assert case.accounting()["po_headers"]["unaccounted"] == 0


def test_item_rules_and_reasons(spark, rows):
    case = Case(
        spark,
        [GOOD, ("P2", "S1", "2024-01-10", None, "1")],
        [
            ("P1", "10", "ok", "2.5", "1.00", "2024-02-01"),
            ("P1", "20", None, "1", "1.00", "2024-02-01"),
            ("P1", "30", "x", "many", "1.00", "2024-02-01"),
            ("P1", "40", "x", "1", "1.00", "2024-01-09"),
            ("P1", "50", "x", "-1", "free", "soon"),
            ("P2", "10", "x", "1", "1.00", "2024-02-01"),
            ("P9", "10", None, "1", "1.00", "2024-02-01"),
        ],
    )
    assert rows(case.bad_items, "record_id", "rule_name", "reason") == sorted([
        ("P1|20", "missing_description", "description is NULL"),
        ("P1|30", "missing_quantity", "quantity is NULL"),
        ("P1|40", "delivery_before_order", "delivery_date 2024-01-09 is before order_date 2024-01-10"),
        ("P2|10", "parent_po_quarantined", "the parent PO failed validation"),
        ("P9|10", "missing_description", "description is NULL"),
        ("P9|10", "orphan_po", "po_id not found in PO headers"),
    ], key=repr)
    kept = {(r["po_id"], int(r["item_no"])): r["quantity"] for r in case.silver_items.collect()}
    assert kept == {("P1", 10): 3, ("P1", 50): -1}
    assert case.accounting()["po_items"]["unaccounted"] == 0


def test_duplicate_header_does_not_condemn_or_multiply_lines(spark, rows):
    late = ("P1", "10", "x", "1", "1", "2024-02-01")
    early = ("P1", "20", None, "1", "1", "2024-01-01")
    case = Case(spark, [GOOD, GOOD], [late, early])
    assert rows(case.bad_items, "record_id", "rule_name") == [
        ("P1|20", "delivery_before_order"), ("P1|20", "missing_description")]
    assert case.silver_items.count() == 1


def test_line_is_flagged_once_per_distinct_order_date_it_precedes(spark, rows):
    headers = [GOOD, GOOD, ("P1", "S1", "2024-01-20", "EUR", "1"), ("P1", "S1", "2024-01-02", "EUR", "1")]
    case = Case(spark, headers, [("P1", "10", "x", "1", "1", "2024-01-05")])
    assert rows(case.bad_items, "reason") == [
        ("delivery_date 2024-01-05 is before order_date 2024-01-10",),
        ("delivery_date 2024-01-05 is before order_date 2024-01-20",),
    ]


def test_line_without_key_does_not_empty_silver(spark, rows):
    case = Case(spark, [GOOD], [
        ("P1", "x", "d", "1", "1", "2024-02-01"), ("P1", "10", "d", "1", "1", "2024-02-01"),
        (None, "10", "d", "1", "1", "2024-02-01"),
    ])
    assert rows(case.bad_items, "record_id", "rule_name") == [
        (None, "missing_key"), (None, "missing_key"), (None, "orphan_po")]
    assert rows(case.silver_items, "po_id") == [("P1",)]
    assert case.accounting()["po_items"]["unaccounted"] == 0


def test_one_bad_copy_of_a_line_removes_all_its_copies(spark, rows):
    case = Case(spark, [GOOD], [
        ("P1", "10", "d", "1", "1", "2024-02-01"), ("P1", "10", None, "1", "1", "2024-02-01"),
        ("P1", "20", "d", "1", "1", "2024-02-01"), ("P1", "20", "d", "1", "1", "2024-02-01"),
    ])
    assert rows(case.bad_items, "record_id") == [("P1|10",)]
    assert [int(r["item_no"]) for r in case.silver_items.collect()] == [20, 20]
    assert case.accounting()["po_items"] == {
        "table_name": "po_items", "staged": 2, "repeated": 2, "silver": 1, "quarantined": 1, "unaccounted": 0}


@pytest.mark.parametrize("empty", ["headers", "items", "both"])
def test_empty_tables(spark, empty):
    headers = [] if empty != "items" else [GOOD]
    items = [] if empty != "headers" else [("P1", "10", "d", "1", "1", "2024-02-01")]
    case = Case(spark, headers, items)
    assert case.bad_headers.count() == 0
    assert case.bad_items.count() == len(items)
    assert all(r["unaccounted"] == 0 for r in case.accounting().values())


def test_heavy_keys_give_the_same_rows(spark, rows, hot_at_ten):
    """One PO holds a third of all lines and of all header rows; one unknown supplier a third of the POs."""
    headers = [("P0", "S1", "2024-01-10", "EUR", "1")] * 60
    headers += [(f"Q{i}", "S9" if i % 2 else "S1", "2024-01-10", "EUR", "1") for i in range(120)]
    items = [("P0", str(10 * (i % 40 + 1)), "d" if i % 7 else None, "1", "1", f"2024-01-{5 + i % 20:02d}") for i in range(120)]
    items += [(None, "10", "d", "1", "1", "2024-02-01")] * 30
    items += [(f"Q{i}", "10", "d", "1", "1", "2024-02-01") for i in range(120)]
    salted = Case(spark, headers, items)
    assert salted.judged.many_copies
    spark.conf.unset("spark.ledgersieve.hotKeyRows")
    plain = Case(spark, headers, items)
    assert not plain.judged.many_copies
    for part in ("bad_headers", "bad_items", "silver_headers", "silver_items"):
        assert rows(getattr(salted, part)) == rows(getattr(plain, part)), part
    assert salted.bad_headers.where("rule_name = 'duplicate_po_id'").count() == 59


def not_in_quarantine(case):
    """Silver as it is defined: lines whose record is not among the quarantined ones."""
    keyed = case.items.withColumn("record_id", line_key(F.col("po_id"), F.col("item_no"))).where("record_id IS NOT NULL")
    kept = keyed.join(case.bad_items.select("record_id").distinct(), "record_id", "left_anti")
    return kept.select(case.silver_items.columns)


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("hot", [[], None, [HotKey("P1", 3)], [HotKey("P1", 2), HotKey(None, 4)]])
def test_silver_lines_are_those_not_in_quarantine(spark, rows, hot, stored):
    headers = [GOOD, ("P2", "S1", None, "EUR", "1"), ("P3", "S1", "2024-01-10", "EUR", "1")]
    items = [(f"P{1 + i % 4}", str(10 * (i % 9)), "d" if i % 5 else None, "1", "1", f"2024-01-{3 + i % 20:02d}") for i in range(90)]
    items += [(None, "10", "d", "1", "1", "2024-02-01"), ("P1", "x", "d", "1", "1", "2024-02-01")]
    items += [("P3", "500", "d", "1", "1", "2024-02-01")] * 2
    case = Case(spark, headers, items)
    lines = judge_lines(case.items, case.judged, hot)
    lines = lines.stored() if stored else lines
    assert rows(silver_items(lines)) == rows(not_in_quarantine(case))
    assert rows(quarantine_items(lines)) == rows(case.bad_items)
    assert rows(lines.staged()) == rows(case.items)


def test_a_heavy_record_broken_in_one_place_is_broken_in_all(spark, rows, hot_at_ten):
    items = [("P1", "10", "d", "1", "1", "2024-02-01")] * 60 + [("P1", "10", None, "1", "1", "2024-02-01")]
    items += [("P1", "20", "d", "1", "1", "2024-02-01")] * 60 + [("P1", str(i), "d", "1", "1", "2024-02-01") for i in range(100, 130)]
    case = Case(spark, [GOOD], items)
    assert {h.value for h in case.lines.hot} == {"P1|10", "P1|20"} and case.lines.placed_by == ("po_id", "_salt")
    assert rows(case.silver_items) == rows(not_in_quarantine(case))
    assert case.silver_items.count() == 90
    assert case.accounting()["po_items"]["unaccounted"] == 0


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(po_id")


def test_stored_lines_are_read_where_they_lie(spark):
    """After the one shuffle that places them, nothing shuffles the lines again."""
    items = [(f"P{i % 7}", str(i), "d" if i % 5 else None, "1", "1", f"2024-01-{3 + i % 20:02d}") for i in range(200)]
    case = Case(spark, [(f"P{i}", "S1", "2024-01-10", "EUR", "1") for i in range(6)], items)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unstored = judge_lines(case.items, case.judged.stored(), [])
        plan = unstored.lines._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_NUM") == 1
        stored = unstored.stored()
        for df in (stored.clean(), quarantine_items(stored), stored.lines.groupBy("po_id", "item_no").count()):
            assert exchanges(df) == 0
        silver = write_buckets(silver_items(stored), new_folder(spark, "silver"), stored.placed_by)
        both = stored.staged().select("po_id", "item_no").unionAll(silver.select("po_id", "item_no"))
        assert exchanges(both.groupBy("po_id", "item_no").count()) == 0
        parents = case.judged.stored().pos.select("po_id")
        assert exchanges(silver.join(parents, "po_id", "left_anti")) == 1  # that of the parents
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_accounting_counts_placed_lines_where_they_lie(spark):
    items = [(f"P{i % 7}", str(i), "d" if i % 5 else None, "1", "1", f"2024-01-{3 + i % 20:02d}") for i in range(200)]
    items += [items[1], (None, "1", "d", "1", "1", "2024-02-01"), ("P1", None, "d", "1", "1", "2024-02-01")]
    case = Case(spark, [(f"P{i}", "S1", "2024-01-10", "EUR", "1") for i in range(6)], items)
    headers = case.judged.stored()
    lines = judge_lines(case.items, headers, []).stored()
    silver = write_buckets(silver_items(lines), new_folder(spark, "silver"), lines.placed_by)
    table = row_accounting(case.headers, lines.staged(), silver_headers(headers), silver, quarantine_headers(headers), quarantine_items(lines))
    assert exchanges(table) == 0
    assert {r["table_name"]: r.asDict() for r in table.collect()} == case.accounting()
    counted = case.accounting()["po_items"]
    assert (counted["staged"], counted["repeated"], counted["unaccounted"]) == (202, 1, 0)


def test_numbers_beyond_64_bits_are_kept_and_judged(spark, rows):
    wide = "12345678901234567890123456789012345678"
    items = [("P1", wide, "d", "1", "1", "2024-02-01"), ("P1", wide, None, "1", "1", "2024-02-01"),
             ("P1", wide[:-1] + "9", "d", "-" + wide, "1", "2024-02-01"), ("P1", "9223372036854775808", "d", "2.5", "1", "2024-02-01"),
             ("P1", "7", "d", "1" + wide, "1", "2024-02-01")]
    case = Case(spark, [GOOD], items)
    stored = case.lines.stored()
    assert rows(stored.lines) == rows(case.lines.lines) and stored.lines.dtypes == case.lines.lines.dtypes
    assert rows(stored.staged()) == rows(case.items)
    kept = [(str(n), str(q)) for n, q in rows(silver_items(stored), "item_no", "quantity")]
    assert sorted(kept) == sorted([(wide[:-1] + "9", "-" + wide), ("9223372036854775808", "3")])
    assert rows(quarantine_items(stored), "record_id", "rule_name") == [
        (f"P1|{wide}", "missing_description"), ("P1|7", "missing_quantity")]
    assert case.accounting()["po_items"] == {
        "table_name": "po_items", "staged": 4, "repeated": 1, "silver": 2, "quarantined": 2, "unaccounted": 0}
