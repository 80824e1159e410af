"""What the injector works on: clean, typed purchase orders plus the draws for each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgersieve.operators.skew import HotKey

# One issue type owns one of SLOTS slots, so it hits 0.5% of the orders and no order
# gets two of them: a draw without replacement that needs no sort and no state.
# A slot that is not listed leaves the order clean.
SLOTS = 200
SLOT = {
    "missing_currency": 0,
    "invalid_currency": 1,
    "bad_date_format": 2,
    "orphan_supplier": 3,
    "delivery_before_order": 4,
    "missing_item_field": 5,
    "exact_duplicate_header": 6,
    "near_duplicate_po": 7,
    # The last two are there to test rules; seeded data does not use them.
    "missing_order_date": 8,
    "orphan_po": 9,
}


class Clean:
    """
    suppliers  supplier_id, name, country, payment_terms, created_date; make_variant (boolean)
    headers    po_id, supplier_id, order_date, currency, total_amount; slot, bad_currency
    items      po_id, item_no, description, quantity, unit_price, delivery_date,
               order_date, true_category; slot, blank_field, early_days,
               price_factor, quantity_factor (NULL where the line is no outlier)
    """

    suppliers: DataFrame
    headers: DataFrame
    items: DataFrame
    orphan_supplier_id: str
    hot_item_pos: Sequence[HotKey] | None
