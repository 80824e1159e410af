"""Silver: typed rows that passed every rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.plans.quarantine import JudgedHeaders, JudgedLines


def silver_headers(judged: JudgedHeaders) -> DataFrame:
    """One row per PO that broke no rule. Extra copies alone do not condemn a PO."""
    clean = judged.pos.where(F.size("found") == 0)
    return clean.select("po_id", "supplier_id", "order_date", "currency", "total_amount")


def silver_items(judged: JudgedLines) -> DataFrame:
    """Lines whose record_id is in quarantine for no reason.

    Read off the judged lines, which know it of their whole record. NOT IN over the quarantine would
    be unknown for every row as soon as one key there is NULL, and Spark would broadcast the
    quarantine to evaluate it.
    """
    return judged.clean().select("po_id", "item_no", "description", "quantity", "unit_price", "delivery_date")


def silver_suppliers(suppliers: DataFrame) -> DataFrame:
    return suppliers.select("supplier_id", "supplier_name", "country", "payment_terms", "created_date")
