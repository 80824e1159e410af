"""Every query agrees with its SQL statement, and the known counts hold."""

from __future__ import annotations

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF_DIR), db, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_scores_the_rules(spark):
    scores = {r["issue_type"]: r for r in entry_points.entry(spark).collect()}
    mapped = [
        "missing_currency", "invalid_currency", "bad_date_format", "orphan_supplier",
        "exact_duplicate_header", "delivery_before_order", "missing_item_field",
    ]
    assert all(scores[i]["injected"] == scores[i]["caught_by_rules"] == 8 for i in mapped)
    unmapped = {"near_duplicate_po": 8, "inconsistent_supplier_name": 3, "price_outlier": 89,
                "quantity_outlier": 63, "missing_order_date": 8, "orphan_po": 8}
    assert {i: scores[i]["injected"] for i in unmapped} == unmapped
    assert all(scores[i]["caught_by_rules"] == 0 for i in unmapped)


def test_known_counts(spark):
    bronze_rows = {r["t"]: r["n"] for r in QUERIES["load_counts"](spark, SF_DIR).collect()}
    assert bronze_rows == {"suppliers": 153, "po_headers": 1516, "po_items": 6023}
    accounting = {r["table_name"]: r for r in QUERIES["row_accounting"](spark, SF_DIR).collect()}
    assert (accounting["po_headers"]["silver"], accounting["po_headers"]["quarantined"]) == (1468, 48)
    assert (accounting["po_items"]["silver"], accounting["po_items"]["quarantined"]) == (5837, 186)
    assert all(r["unaccounted"] == 0 for r in accounting.values())
