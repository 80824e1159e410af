"""Fixed schemas and value domains. Bronze is all text, so nothing is rejected on arrival."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def _text(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Table and column names.
SUPPLIERS_RAW = _text("supplier_id", "name", "country", "payment_terms", "created_date")
PO_HEADERS_RAW = _text("po_id", "supplier_id", "order_date", "currency", "total_amount")
PO_ITEMS_RAW = _text("po_id", "item_no", "description", "quantity", "unit_price", "delivery_date")
GROUND_TRUTH_CATEGORIES = _text("po_id", "item_no", "true_category")
CORRUPTION_LOG = _text("table_name", "record_id", "issue_type", "detail", "ml_target")

# landing file stem -> (bronze table, schema)
BRONZE_TABLES = {
    "suppliers": ("suppliers_raw", SUPPLIERS_RAW),
    "po_headers": ("po_headers_raw", PO_HEADERS_RAW),
    "po_items": ("po_items_raw", PO_ITEMS_RAW),
    "ground_truth_categories": ("ground_truth_categories", GROUND_TRUTH_CATEGORIES),
    "corruption_log": ("corruption_log", CORRUPTION_LOG),
}

# Accepted domains.
COUNTRIES = ("CZ", "DE", "PL", "SK", "AT", "NL", "US")
PAYMENT_TERMS = ("NET30", "NET45", "NET60")
CURRENCIES = ("EUR", "USD")
