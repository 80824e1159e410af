"""Purchase orders derived from the order tables by fixed rules, without any randomness.

The same rules can be stated in any SQL engine, so results can be compared row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersieve.datagen.clean import SLOTS, Clean
from ledgersieve.datagen.inject import Bronze
from ledgersieve.operators.ranking import number_rows
from ledgersieve.operators.skew import HotKey, find_hot_keys, skew_safe_join
from ledgersieve.schemas import COUNTRIES, PAYMENT_TERMS

_ID_DIGITS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nth(values: Sequence[str], position: str) -> str:
    return f"element_at(array({', '.join(map(repr, values))}), int({position} + 1))"


def _keyed(prefix: str, key: str) -> str:
    """Prefix and zero-padded number; a longer number keeps every digit."""
    return f"concat('{prefix}', lpad(string({key}), greatest(length(string({key})), {_ID_DIGITS}), '0'))"


def _as_ids(prefix: str, hot: Sequence[HotKey]) -> list[HotKey]:
    return [HotKey(None if h.value is None else f"{prefix}{h.value:0{_ID_DIGITS}d}", h.fanout) for h in hot]


class TableOrders(Clean):
    """Suppliers from customer, headers from orders, items from lineitem, orders and part."""

    orphan_supplier_id = "S99999999"

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = table(self._spark, self._sf_dir, name)
        return self._read[name]

    @cached_property
    def suppliers(self) -> DataFrame:
        return self._table("customer").selectExpr(
            f"{_keyed('S', 'c_custkey')} AS supplier_id",
            "c_name AS name",
            f"{_nth(COUNTRIES, f'c_nationkey % {len(COUNTRIES)}')} AS country",
            f"{_nth(PAYMENT_TERMS, f'c_custkey % {len(PAYMENT_TERMS)}')} AS payment_terms",
            "'2015-01-01' AS created_date",
            "c_custkey IN (0, 1, 2) AS make_variant",
        )

    @cached_property
    def headers(self) -> DataFrame:
        return self._table("orders").selectExpr(
            f"{_keyed('PO', 'o_orderkey')} AS po_id",
            f"{_keyed('S', 'o_custkey')} AS supplier_id",
            "date(o_orderdate) AS order_date",
            "if(o_custkey % 2 = 0, 'EUR', 'USD') AS currency",
            "cast(o_totalprice AS decimal(18,2)) AS total_amount",
            f"o_orderkey % {SLOTS} AS slot",
            "'EURO' AS bad_currency",
        )

    @cached_property
    def _hot(self) -> dict[str, list[HotKey]]:
        return find_hot_keys(self._table("lineitem"), "l_orderkey", "l_partkey")

    @cached_property
    def hot_item_pos(self) -> list[HotKey]:
        named = [k for k in self._hot["l_orderkey"] if k.value is not None]
        return _as_ids("PO", self._hot["l_orderkey"]) + _as_ids("ND", named)

    @cached_property
    def items(self) -> DataFrame:
        # Lines equal on these are interchangeable below, so no further tie-break is carried along.
        order = ["l_linenumber", "l_partkey", "l_quantity"]
        lineitem = self._table("lineitem").select("l_orderkey", *order)
        # One row per order, so that a repeated order cannot multiply its lines.
        dates = self._table("orders").groupBy(F.col("o_orderkey").alias("l_orderkey"))
        dates = dates.agg(F.min("o_orderdate").cast("date").alias("order_date"))
        # The price is converted once per part, not once per line.
        goods = self._table("part").selectExpr(
            "p_partkey AS l_partkey", "p_name", "p_type", "cast(p_retailprice AS decimal(18,2)) AS unit_price")
        lines = number_rows(lineitem, "l_orderkey", order, self._hot["l_orderkey"], "n")
        lines = skew_safe_join(lines, dates, "l_orderkey", "left", self._hot["l_orderkey"])
        lines = skew_safe_join(lines, goods, "l_partkey", "left", self._hot["l_partkey"])
        return lines.selectExpr(
            f"{_keyed('PO', 'l_orderkey')} AS po_id",
            "n * 10 AS item_no",
            "p_name AS description",
            "bigint(l_quantity) AS quantity",
            "unit_price",
            "date_add(order_date, int(l_partkey % 41 + 5)) AS delivery_date",
            "order_date",
            "p_type AS true_category",
            f"l_orderkey % {SLOTS} AS slot",
            f"if(l_orderkey % {2 * SLOTS} < {SLOTS}, 'description', 'quantity') AS blank_field",
            "int(l_partkey % 30 + 1) AS early_days",
            "if((l_orderkey * 7 + n) % 67 = 0, 50, NULL) AS price_factor",
            "if((l_orderkey * 7 + n) % 67 <> 0 AND (l_orderkey * 7 + n) % 101 = 1, 50, NULL) AS quantity_factor",
        )


def bronze_from_tables(spark: SparkSession, sf_dir: str) -> Bronze:
    return Bronze(TableOrders(spark, sf_dir))
