"""Clean purchase orders made up from a seed: one order per row of an order table.

Every value is a function of (seed, key), so the same seed gives the same data on any
cluster, and lines are exploded from their order without a join.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersieve.datagen.clean import SLOT, SLOTS, Clean
from ledgersieve.datagen.inject import order_totals
from ledgersieve.functions.convert import padded
from ledgersieve.functions.draws import child_hash, draw_below, draw_choice, draw_normal, draw_unit, key_hash
from ledgersieve.schemas import COUNTRIES, CURRENCIES, PAYMENT_TERMS

# Spend categories and their typical unit prices.
BASE_PRICES = {
    "IT Hardware": 350.0,
    "Office Supplies": 25.0,
    "Logistics Services": 600.0,
    "Maintenance & Spare Parts": 180.0,
    "Software & Licenses": 900.0,
    "Professional Services": 1200.0,
}
# What an order line of each category may be called.
GOODS = {
    "IT Hardware": ("Rack server 2U", "Thin client", "Barcode scanner", "UPS battery pack"),
    "Office Supplies": ("Envelopes C5 box", "Gel pen blue", "Document wallet", "Label roll"),
    "Logistics Services": ("Road haulage leg", "Air cargo handling", "Bonded storage", "Parcel pickup"),
    "Maintenance & Spare Parts": ("Gear oil 5L", "Roller chain", "Fan belt", "Valve repair kit"),
    "Software & Licenses": ("Mail gateway plan", "ERP user licence", "Backup subscription", "VPN seats"),
    "Professional Services": ("Tax review", "Interim manager day", "Safety inspection", "Copy editing"),
}
NAME_PARTS = (("North", "Blue", "Iron", "Clear", "Old"), ("bridge", "field", "works", "harbor", "mill"),
              ("Ltd", "Inc", "AG", "and Sons"))
REMARKS = (" [for site B]", " (see annex)", ", as quoted", " [priority]")
# Wrong currency codes and factors of the injected errors.
BAD_CURRENCIES = ("EURO", "EU", "US$", "XXX")
OUTLIER_FACTORS = (20, 50, 100)
FIRST_DAY, DAYS = "2024-01-01", 730


def _by_category(table: dict, category: Column) -> Column:
    chosen = None
    for name, value in table.items():
        hit = category == name
        column = F.lit(value) if isinstance(value, float) else F.array(*[F.lit(v) for v in value])
        chosen = F.when(hit, column) if chosen is None else chosen.when(hit, column)
    return chosen


def preferred_category(supplier: Column) -> Column:
    return draw_choice(supplier, "category", list(BASE_PRICES))


def preferred_currency(supplier: Column) -> Column:
    return draw_choice(supplier, "currency", CURRENCIES)


def synth_suppliers(spark: SparkSession, count: int, seed: int) -> DataFrame:
    row = F.col("_row")
    first, second, form = (draw_choice(row, f"name{i}", v) for i, v in enumerate(NAME_PARTS))
    days_ago = (draw_below(row, "since", 7 * 365) + 365).cast("int")
    numbered = spark.range(1, count + 1).withColumn("_row", key_hash(seed, F.col("id")))
    return numbered.select(
        F.concat(F.lit("S"), padded(F.col("id"), 6)).alias("supplier_id"),
        F.concat(first, second, F.lit(", "), form).alias("name"),
        draw_choice(row, "country", COUNTRIES).alias("country"),
        draw_choice(row, "terms", PAYMENT_TERMS).alias("payment_terms"),
        F.date_sub(F.lit(FIRST_DAY).cast("date"), days_ago).alias("created_date"),
        (F.col("id") <= 3).alias("make_variant"),
    )


def draw_slot(order: Column) -> Column:
    """One of the issue slots, or SLOTS for an order that stays clean."""
    drawn = draw_below(order, "slot", SLOTS)
    return F.when(drawn <= SLOT["near_duplicate_po"], drawn).otherwise(SLOTS)


def synth_headers(orders: DataFrame, suppliers: int, seed: int) -> DataFrame:
    """One order per row of `orders` (column po_no), with the hashes its lines are drawn from."""
    row = F.col("order_hash")
    drawn = orders.withColumn("order_hash", key_hash(seed, F.col("po_no"))).select(
        "order_hash",
        F.concat(F.lit("PO"), padded(F.col("po_no"), 6)).alias("po_id"),
        (draw_below(row, "supplier", suppliers) + 1).alias("supplier_no"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), draw_below(row, "day", DAYS).cast("int")).alias("order_date"),
        draw_slot(row).alias("slot"),
        draw_choice(row, "bad_currency", BAD_CURRENCIES).alias("bad_currency"),
    )
    drawn = drawn.withColumn("supplier_hash", key_hash(seed, F.col("supplier_no")))
    return drawn.withColumns({
        "supplier_id": F.concat(F.lit("S"), padded(F.col("supplier_no"), 6)),
        "currency": preferred_currency(F.col("supplier_hash")),
    })


def _noisy(text: Column, row: Column) -> Column:
    """One description in eight in capitals, one in small letters; one in six with a remark."""
    form = draw_below(row, "form", 8)
    spelt = F.when(form == 0, F.upper(text)).when(form == 1, F.lower(text)).otherwise(text)
    note = draw_choice(row, "note", REMARKS)
    return F.concat(spelt, F.when(draw_below(row, "noted", 6) == 0, note).otherwise(F.lit("")))


def synth_items(headers: DataFrame, seed: int) -> DataFrame:
    """One to five lines per order, numbered 10, 20, …"""
    row, order = F.col("line_hash"), F.col("order_hash")
    line_count = draw_below(order, "lines", 5) + 1
    lines = headers.withColumn("line", F.explode(F.sequence(F.lit(1).cast("bigint"), line_count)))
    lines = lines.withColumn("line_hash", child_hash(order, F.col("line")))
    lines = lines.withColumns({
        "true_category": F.when(draw_unit(row, "usual") <= 0.8, preferred_category(F.col("supplier_hash")))
        .otherwise(draw_choice(row, "other", list(BASE_PRICES))),
        "odd": draw_below(row, "outlier", 1000),
        "factor": draw_choice(row, "factor", OUTLIER_FACTORS),
    })
    goods = F.element_at(_by_category(GOODS, F.col("true_category")), (draw_below(row, "goods", 4) + 1).cast("int"))
    price = _by_category(BASE_PRICES, F.col("true_category")) * F.exp(F.lit(0.25) * draw_normal(row, "price"))
    return lines.select(
        "po_id",
        (F.col("line") * 10).alias("item_no"),
        _noisy(goods, row).alias("description"),
        (draw_below(row, "quantity", 25) + 1).alias("quantity"),
        price.cast("decimal(18,2)").alias("unit_price"),
        F.date_add("order_date", (draw_below(row, "delivery", 41) + 5).cast("int")).alias("delivery_date"),
        "order_date", "true_category", "slot",
        draw_choice(order, "blank", ("description", "quantity")).alias("blank_field"),
        (draw_below(order, "early", 30) + 1).cast("int").alias("early_days"),
        # 1.5% price outliers, and 1% quantity outliers among the other lines.
        F.expr("if(odd < 15, factor, NULL)").alias("price_factor"),
        F.expr("if(odd >= 15 AND odd < 25, factor, NULL)").alias("quantity_factor"),
    )


class SyntheticOrders(Clean):
    """`orders` supplies the order numbers (column po_no); `suppliers` is a count."""

    orphan_supplier_id = "S999999"
    hot_item_pos: list = []  # at most five lines per order

    def __init__(self, spark: SparkSession, orders: DataFrame, suppliers: int, seed: int):
        self._drawn = synth_headers(orders, suppliers, seed)
        self.suppliers = synth_suppliers(spark, suppliers, seed)
        self.items = synth_items(self._drawn, seed)

    @cached_property
    def headers(self) -> DataFrame:
        """Totals include the outliers, so no rule can see them."""
        valued = self.items.selectExpr(
            "po_id",
            "quantity * coalesce(quantity_factor, 1) AS quantity",
            "cast(unit_price * coalesce(price_factor, 1) AS decimal(18,2)) AS unit_price",
        )
        return self._drawn.join(order_totals(valued), "po_id", "left")
