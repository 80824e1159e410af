"""Profiles of the bronze purchase-order tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersieve.functions.convert import iso_date, line_key, number, whole_match
from ledgersieve.operators import profiling as p
from ledgersieve.operators.skew import HotKey, skew_safe_join
from ledgersieve.schemas import CURRENCIES


def column_profile(suppliers: DataFrame, headers: DataFrame, items: DataFrame) -> DataFrame:
    return p.column_profile({"SUPPLIERS_RAW": suppliers, "PO_HEADERS_RAW": headers, "PO_ITEMS_RAW": items})


def load_counts(suppliers: DataFrame, headers: DataFrame, items: DataFrame) -> DataFrame:
    tables = {"suppliers": suppliers, "po_headers": headers, "po_items": items}
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(t).alias("t"), "n") for t, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def header_quick_profile(headers: DataFrame) -> DataFrame:
    return headers.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("currency").isNull()).alias("null_currency"),
        F.count_distinct("po_id").alias("distinct_po_ids"),
        (F.count("*") - F.count_distinct("po_id")).alias("duplicate_po_rows"),
        F.count_if(iso_date(F.col("order_date")).isNull()).alias("unparseable_order_dates"),
    )


def currency_distribution(headers: DataFrame) -> DataFrame:
    return p.frequency(headers, "currency")


def numeric_spread(items: DataFrame) -> DataFrame:
    return p.numeric_spread(items, ["quantity", "unit_price"])


def _excess(key: str) -> Column:
    """Rows beyond one per key value; rows without a key count as excess."""
    return F.count("*") - F.count_distinct(key)


def _failing(df: DataFrame, table_name: str, checks: dict[str, Column]) -> DataFrame:
    """All counts of one table in one aggregate, turned into one row per check."""
    counts = df.agg(*[c.alias(name) for name, c in checks.items()])
    rows = counts.unpivot([], list(checks), "check_name", "failing_rows")
    return rows.select(F.lit(table_name).alias("table_name"), "check_name", "failing_rows")


def pattern_checks(
    suppliers: DataFrame, headers: DataFrame, items: DataFrame, hot_pos: Sequence[HotKey] | None = None
) -> DataFrame:
    # Read as numbers once, below the aggregate, which uses them several times.
    numbers = {c: f"{c}_number" for c in ("total_amount", "quantity", "unit_price")}
    not_a_number = {c: F.col(c).isNotNull() & F.col(n).isNull() for c, n in numbers.items()}

    def with_numbers(df: DataFrame) -> DataFrame:
        return df.withColumns({n: number(F.col(c)) for c, n in numbers.items() if c in df.columns})

    date, currency = F.col("order_date"), F.col("currency")
    one_table = [
        _failing(suppliers, "suppliers", {"duplicate supplier_id": _excess("supplier_id")}),
        _failing(with_numbers(headers), "po_headers", {
            "duplicate po_id rows": _excess("po_id"),
            "order_date not in YYYY-MM-DD format":
                F.count_if(date.isNotNull() & ~whole_match(date, "[0-9]{4}-[0-9]{2}-[0-9]{2}")),
            "currency is NULL": F.count_if(currency.isNull()),
            "currency not in (EUR, USD)": F.count_if(currency.isNotNull() & ~currency.isin(*CURRENCIES)),
            "total_amount not numeric": F.count_if(not_a_number["total_amount"]),
        }),
        _failing(with_numbers(items), "po_items", {
            "description is NULL": F.count_if(F.col("description").isNull()),
            "quantity is NULL": F.count_if(F.col("quantity").isNull()),
            "quantity or unit_price not numeric, or not positive": F.count_if(
                (F.col(numbers["quantity"]) <= 0) | (F.col(numbers["unit_price"]) <= 0)
                | not_a_number["quantity"] | not_a_number["unit_price"]
            ),
        }),
    ]
    # Counted per supplier first: the join then sees each supplier once, however heavy.
    per_supplier = headers.groupBy("supplier_id").agg(F.count("*").alias("n"))
    unknown = per_supplier.join(suppliers.select("supplier_id").distinct(), "supplier_id", "left_anti")
    orphans = _failing(unknown, "po_headers", {
        "supplier_id not found in suppliers": F.coalesce(F.sum("n"), F.lit(0).cast("bigint")),
    })
    # A line precedes some order date of its PO exactly when it precedes the latest one.
    latest = headers.groupBy("po_id").agg(F.max(iso_date(F.col("order_date"))).alias("latest_order"))
    lines = items.select("po_id", "item_no", iso_date(F.col("delivery_date")).alias("delivery"))
    lines = lines.where(F.col("delivery").isNotNull())
    early = skew_safe_join(lines, latest, "po_id", "inner", hot_pos, F.col("delivery") < F.col("latest_order"))
    early = _failing(early.select(line_key(F.col("po_id"), F.col("item_no")).alias("record_id")), "po_items", {
        "delivery_date earlier than order_date": F.count_distinct("record_id"),
    })
    return reduce(DataFrame.unionByName, [*one_table, orphans, early])
