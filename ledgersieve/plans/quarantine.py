"""Quarantine: one row per record and rule it broke, with a readable reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersieve.functions.convert import line_key
from ledgersieve.operators.rules import Rule, findings, no_findings
from ledgersieve.operators.skew import HotKey, find_hot_keys, hot_key_frame, skew_safe_join, unroll
from ledgersieve.schemas import CURRENCIES
from ledgersieve.sources.cut import cut, new_folder
from ledgersieve.sources.tables import write_buckets

_HEADER_COLUMNS = ("po_id", "supplier_id", "order_date_raw", "order_date", "currency", "total_amount")
# Copy 1 is the smallest by these, NULL last. Every column takes part, so it is the same
# copy wherever it is asked for.
_COPY_ORDER = ("order_date_raw", "supplier_id", "currency", "total_amount")


@dataclass(frozen=True)
class JudgedHeaders:
    """
    pos         one row per po_id: copy 1, `copies`, `order_dates` (distinct, over all
                copies) and `found` (the rules copy 1 broke)
    many_copies whether some po_id has so many copies that listing them must be spread
    """

    pos: DataFrame
    many_copies: bool

    def stored(self) -> JudgedHeaders:
        return JudgedHeaders(cut(self.pos, "judged-headers"), self.many_copies)


def first_copies(headers: DataFrame) -> DataFrame:
    """Copy 1 of each po_id with the number of copies.

    Taken as a minimum, which combines on the map side: a po_id with any number of copies
    reaches its reducer as one row per input split, where a ranking window would sort all
    of its copies in one task.
    """
    ranked = []
    for c in _COPY_ORDER:
        ranked += [F.col(c).isNull().alias(f"{c}_missing"), F.col(c)]
    return (
        headers.groupBy("po_id")
        .agg(
            F.min(F.struct(*ranked, "order_date")).alias("first"),
            F.count("*").alias("copies"),
            F.collect_set("order_date").alias("order_dates"),
        )
        .select("po_id", *[F.col(f"first.{c}").alias(c) for c in _HEADER_COLUMNS[1:]], "copies", "order_dates")
    )


_ACCEPTED = ", ".join(f"'{c}'" for c in CURRENCIES)
HEADER_RULES = (
    Rule("missing_currency", "currency IS NULL", "'currency is NULL'"),
    Rule("invalid_currency", f"currency NOT IN ({_ACCEPTED})", "'currency is not EUR or USD: ' || currency"),
    Rule("bad_date_format", "order_date IS NULL AND order_date_raw IS NOT NULL",
         "'order_date is not a valid YYYY-MM-DD date: ' || order_date_raw"),
    Rule("missing_order_date", "order_date_raw IS NULL", "'order_date is NULL'"),
    Rule("orphan_supplier", "supplier_id IS NOT NULL AND known_supplier IS NULL",
         "'supplier_id not found in suppliers: ' || supplier_id"),
    # Without a key a row can be neither trusted nor looked up, so it is logged as such.
    Rule("missing_key", "po_id IS NULL", "'po_id is NULL'"),
)
ITEM_RULES = (
    Rule("missing_description", "description IS NULL", "'description is NULL'"),
    # A quantity that does not parse is NULL too.
    Rule("missing_quantity", "quantity IS NULL", "'quantity is NULL'"),
    Rule("orphan_po", "has_parent IS NULL", "'po_id not found in PO headers'"),
    Rule("parent_po_quarantined", "parent_broken", "'the parent PO failed validation'"),
    Rule("missing_key", "record_id IS NULL", "'po_id or item_no is NULL'"),
)


def judge_headers(
    headers: DataFrame,
    suppliers: DataFrame,
    hot: dict[str, list[HotKey]] | None = None,
) -> JudgedHeaders:
    """`hot` may give the known heavy values of po_id and supplier_id; else they are looked up."""
    if hot is None:
        hot = find_hot_keys(headers, "po_id", "supplier_id")
    known = suppliers.select("supplier_id").distinct().withColumn("known_supplier", F.lit(True))
    pos = skew_safe_join(first_copies(headers), known, "supplier_id", "left", hot["supplier_id"])
    pos = pos.withColumn("found", findings(HEADER_RULES))
    return JudgedHeaders(
        pos.select(*_HEADER_COLUMNS, "copies", "order_dates", "found"), many_copies=bool(hot["po_id"])
    )


def quarantine_headers(judged: JudgedHeaders) -> DataFrame:
    """The rules copy 1 broke, plus one row for every extra copy."""
    duplicate = F.expr("""named_struct('rule_name', 'duplicate_po_id',
        'reason', 'Extra copy of a PO that already exists')""")
    rows = judged.pos.where((F.col("copies") > 1) | (F.size("found") > 0))
    rows = rows.select(
        F.lit("po_headers").alias("table_name"), F.col("po_id").alias("record_id"), "copies",
        F.inline(F.concat(F.array(duplicate), F.col("found"))),
    )
    times = F.when(F.col("rule_name") == "duplicate_po_id", F.col("copies") - 1).otherwise(1)
    return unroll(rows, F.lit(0), times, "copy", spread=judged.many_copies).drop("copies", "copy")


@dataclass(frozen=True)
class JudgedLines:
    """
    lines       every staged line with `record_id`, `found` (the rules it broke) and `broken`
                (whether this or another line of its record broke one)
    placed_by   the columns by whose hash the lines are placed
    hot         heavy records, whose lines lie in several places
    """

    lines: DataFrame
    placed_by: tuple[str, ...]
    hot: tuple[HotKey, ...] = ()

    def stored(self, folder: str | None = None) -> JudgedLines:
        """Written as placed, so that whatever reads the lines by PO or by record needs no shuffle."""
        folder = folder or new_folder(self.lines.sparkSession, "judged-lines")
        # `record_id` repeats two other columns: it is made again on read, by the few who ask for it.
        lines = write_buckets(self.lines.drop("record_id"), folder, self.placed_by)
        lines = lines.withColumn("record_id", line_key(F.col("po_id"), F.col("item_no"))).select(self.lines.columns)
        return JudgedLines(lines, self.placed_by, self.hot)

    def staged(self) -> DataFrame:
        """The lines as staging has them."""
        return self.lines.drop("record_id", "found", "broken", "_salt")

    def clean(self) -> DataFrame:
        """Lines with a key none of whose record broke a rule."""
        kept = self.lines.where(F.col("po_id").isNotNull() & F.col("item_no").isNotNull() & ~F.col("broken"))
        named = [h for h in self.hot if h.value is not None]
        if not named:
            return kept
        # `broken` was worked out place by place: a heavy record that broke a rule in one is broken in all.
        heavy = hot_key_frame(kept.sparkSession, named, self.lines.schema["record_id"].dataType, "record_id").drop("_fanout")
        bad = self.lines.where("broken").join(F.broadcast(heavy), "record_id", "left_semi").select("record_id").distinct()
        # No more records than heavy keys.
        return kept.join(F.broadcast(bad), "record_id", "left_anti").select(kept.columns)


def judge_lines(items: DataFrame, judged: JudgedHeaders, hot_pos: Sequence[HotKey] | None = None) -> JudgedLines:
    """Place the lines by PO once, and judge them there.

    The lines of a heavy PO are spread by item number, which keeps a record together; those of a heavy
    record (and those without a key, if they are many) are spread by input split. `hot_pos` may give
    the known heavy values of po_id; else they are looked up.
    """
    spark = items.sparkSession
    record_id = line_key(F.col("po_id"), F.col("item_no"))
    columns = [*items.columns, "record_id"]
    if hot_pos is None:
        hot_pos = find_hot_keys(items, "po_id")["po_id"]
    parents = judged.pos.select(
        "po_id", "order_dates", F.array_max("order_dates").alias("latest_order"),
        (F.size("found") > 0).alias("parent_broken"), F.lit(True).alias("has_parent"),
    )
    placed_by, hot = ("po_id",), ()
    if hot_pos:
        # A record can only be heavy inside a heavy PO.
        items = items.withColumn("record_id", record_id)
        placed_by, hot = ("po_id", "_salt"), tuple(find_hot_keys(items, "record_id")["record_id"])
        items = _salted(items, hot_pos, hot)
        columns.append("_salt")
        pos = F.broadcast(hot_key_frame(spark, hot_pos, items.schema["po_id"].dataType))
        salts = max(h.fanout for h in (*hot_pos, *hot))
        last = F.when(F.col("_hot_key").isNull(), F.lit(0)).otherwise(F.lit(salts - 1))
        parents = parents.join(pos, F.col("po_id") == F.col("_hot_key"), "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), last))).drop("_hot_key", "_fanout")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = items.repartition(parts, *placed_by).join(parents, list(placed_by), "left")
    if not hot_pos:  # made out of the parts where the lines lie, instead of shuffled with them
        lines = lines.withColumn("record_id", record_id)
    lines = lines.withColumn("found", line_findings())
    # By record, as text: long decimals are slow to sort. Lines without a record are all broken.
    broken = F.max(F.size("found") > 0).over(W.partitionBy(*placed_by, "record_id"))
    lines = lines.withColumn("broken", broken)
    return JudgedLines(lines.select(*columns, "found", "broken"), placed_by, hot)


def _salted(items: DataFrame, hot_pos: Sequence[HotKey], hot: Sequence[HotKey]) -> DataFrame:
    """`items` with `_salt`, 0 outside heavy POs. Both lists hold one key per `hot_key_rows` rows at most."""
    def listed(keys: Sequence[HotKey], column: str, key: str, fanout: str) -> DataFrame:
        frame = hot_key_frame(items.sparkSession, keys, items.schema[column].dataType, key)
        return F.broadcast(frame.withColumnRenamed("_fanout", fanout))

    pos = listed(hot_pos, "po_id", "_hot_po", "_po_fanout")
    records = listed(hot, "record_id", "_hot_record", "_record_fanout")
    by_split = F.pmod(F.spark_partition_id(), F.col("_record_fanout"))
    by_number = F.pmod(F.xxhash64("item_no"), F.col("_po_fanout")).cast("int")
    salt = F.when(F.col("_po_fanout").isNull(), F.lit(0)).otherwise(F.coalesce(by_split, by_number))
    salted = items.join(records, F.col("record_id").eqNullSafe(F.col("_hot_record")), "left")
    salted = salted.join(pos, F.col("po_id").eqNullSafe(F.col("_hot_po")), "left")
    return salted.select(*items.columns, salt.alias("_salt"))


def line_findings() -> Column:
    """The rules a line broke.

    A line is reported once per distinct order date of its PO that it precedes: copies of
    a header may disagree on the date.
    """
    early = F.expr("""if(delivery_date < latest_order, transform(filter(order_dates, d -> delivery_date < d),
        d -> named_struct('rule_name', 'delivery_before_order',
            'reason', 'delivery_date ' || string(delivery_date) || ' is before order_date ' || string(d))), NULL)""")
    return F.concat(findings(ITEM_RULES), F.coalesce(early, no_findings()))


def quarantine_items(judged: JudgedLines) -> DataFrame:
    """One row per rule a line broke."""
    return judged.lines.where(F.size("found") > 0).select(
        F.lit("po_items").alias("table_name"), "record_id", F.inline("found"))
