"""The purchase-order checks: staging warns, silver stops the build."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.operators.checks import Check, Tables
from ledgersieve.operators.skew import HotKey, skew_safe_join
from ledgersieve.schemas import COUNTRIES, CURRENCIES, PAYMENT_TERMS
from ledgersieve.sources.cut import cut


def delivered_before_ordered(
    items: DataFrame, headers: DataFrame, hot_pos: Sequence[HotKey] | None = None
) -> DataFrame:
    """Lines delivered before their order date, against every header copy.

    Copies with the same date are folded into `header_copies` rather than repeated, so a
    heavily copied PO does not multiply its lines; failures are the sum of that column.
    """
    dated = headers.where(F.col("order_date").isNotNull())
    # A line precedes some order date of its PO exactly when it precedes the latest one. The dates are
    # listed only for POs with such lines, and in one row per PO, so that a heavy PO meets a single row.
    latest = dated.groupBy("po_id").agg(F.max("order_date").alias("latest"))
    lines = items.select("po_id", "item_no", "delivery_date")
    early = skew_safe_join(lines, latest, "po_id", "inner", hot_pos, F.col("delivery_date") < F.col("latest"))
    early = cut(early.drop("latest"), "early-lines")
    copies = dated.join(early.select("po_id").distinct(), "po_id", "left_semi")
    copies = copies.groupBy("po_id", "order_date").agg(F.count("*").alias("header_copies"))
    dates = copies.groupBy("po_id").agg(F.collect_list(F.struct("order_date", "header_copies")).alias("dates"))
    early = skew_safe_join(early, dates, "po_id", "inner", hot_pos)
    violated = F.filter("dates", lambda d: F.col("delivery_date") < d["order_date"])
    return early.withColumn("d", F.explode(violated)).select(
        "po_id", "item_no", "d.order_date", "delivery_date", "d.header_copies"
    )


def _early(items: str, headers: str, hot_pos: Sequence[HotKey] | None, tables: Tables) -> DataFrame:
    return delivered_before_ordered(tables[items], tables[headers], hot_pos)


def _known(hot: Sequence[HotKey] | None) -> tuple[HotKey, ...] | None:
    return None if hot is None else tuple(hot)


def staging_checks(
    hot_pos: Sequence[HotKey] | None = None, hot_suppliers: Sequence[HotKey] | None = None
) -> list[Check]:
    """`hot_pos` are the heavy PO ids of the lines, `hot_suppliers` the heavy suppliers of the headers, where known."""
    suppliers, headers, items = "stg_suppliers", "stg_po_headers", "stg_po_items"
    return [
        Check(suppliers, "not_null", "supplier_id"),
        Check(suppliers, "unique", "supplier_id"),
        Check(suppliers, "accepted_values", "country", values=COUNTRIES),
        Check(suppliers, "accepted_values", "payment_terms", values=PAYMENT_TERMS),
        Check(headers, "not_null", "po_id"),
        Check(headers, "unique", "po_id"),
        Check(headers, "not_null", "supplier_id"),
        Check(headers, "relationships", "supplier_id", parent=suppliers, parent_column="supplier_id", hot=_known(hot_suppliers)),
        Check(headers, "not_null", "order_date"),
        Check(headers, "not_null", "currency"),
        Check(headers, "accepted_values", "currency", values=CURRENCIES),
        Check(items, "not_null", "po_id"),
        Check(items, "relationships", "po_id", parent=headers, parent_column="po_id", hot=_known(hot_pos)),
        Check(items, "not_null", "description"),
        Check(items, "not_null", "quantity"),
        Check(items, "custom", name="delivery_before_order", weight="header_copies",
              rows=partial(_early, items, headers, hot_pos)),
    ]


def silver_checks(
    hot_pos: Sequence[HotKey] | None = None, hot_suppliers: Sequence[HotKey] | None = None
) -> list[Check]:
    suppliers, headers, items = "silver_suppliers", "silver_po_headers", "silver_po_items"
    stop = {"severity": "error"}
    return [
        Check(suppliers, "unique", "supplier_id", **stop),
        Check(suppliers, "not_null", "supplier_id", **stop),
        Check(headers, "unique", "po_id", **stop),
        Check(headers, "not_null", "po_id", **stop),
        Check(headers, "relationships", "supplier_id", parent=suppliers, parent_column="supplier_id", hot=_known(hot_suppliers), **stop),
        Check(headers, "not_null", "order_date", **stop),
        Check(headers, "not_null", "currency", **stop),
        Check(headers, "accepted_values", "currency", values=CURRENCIES, **stop),
        Check(items, "relationships", "po_id", parent=headers, parent_column="po_id", hot=_known(hot_pos), **stop),
        Check(items, "not_null", "description", **stop),
        Check(items, "not_null", "quantity", **stop),
        Check(items, "custom", name="silver_delivery_before_order", weight="header_copies",
              rows=partial(_early, items, headers, hot_pos), **stop),
    ]
