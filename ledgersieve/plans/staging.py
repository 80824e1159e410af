"""Staging converts and renames. It never drops a row; what cannot be converted is NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.functions.convert import code, iso_date, money, whole_number


def stage_suppliers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "supplier_id",
        F.col("name").alias("supplier_name"),
        "country",
        "payment_terms",
        iso_date(F.col("created_date")).alias("created_date"),
    )


def stage_headers(raw: DataFrame) -> DataFrame:
    """The raw date stays beside the typed one, so missing and malformed can be told apart."""
    return raw.select(
        "po_id",
        "supplier_id",
        F.col("order_date").alias("order_date_raw"),
        iso_date(F.col("order_date")).alias("order_date"),
        code(F.col("currency")).alias("currency"),
        money(F.col("total_amount")).alias("total_amount"),
    )


def stage_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "po_id",
        whole_number(F.col("item_no")).alias("item_no"),
        "description",
        whole_number(F.col("quantity")).alias("quantity"),
        money(F.col("unit_price")).alias("unit_price"),
        F.col("delivery_date").alias("delivery_date_raw"),
        iso_date(F.col("delivery_date")).alias("delivery_date"),
    )
