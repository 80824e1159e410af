"""Labelled error injection: clean purchase orders in, dirty text tables and answer key out.

Each row carries the issues it received, so the key is read off the rows that were
changed. Copies (duplicates, near-duplicates) come from the same pass as their originals.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import cached_property, partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.datagen.clean import SLOT, Clean
from ledgersieve.operators.skew import HotKey
from ledgersieve.operators.steps import at_once
from ledgersieve.sources.cut import cut

_ISSUE_TYPE = "struct<table_name:string,record_id:string,issue_type:string,detail:string,ml_target:string>"
_NO_ISSUES = f"cast(array() as array<{_ISSUE_TYPE}>)"


def _issue(table: str, record_id: str, issue_type: str, detail: str, ml: bool = False) -> str:
    return (
        f"named_struct('table_name', '{table}', 'record_id', {record_id}, 'issue_type', '{issue_type}', "
        f"'detail', {detail}, 'ml_target', '{ml}')"
    )


def _issues(*cases: tuple[str, str]) -> str:
    """The issues of an original row whose condition holds, as an array. A copy has none.

    Rare, so rows without any skip the work; and without lambdas, which run interpreted.
    """
    some = ", ".join(f"if({hit}, array({issue}), {_NO_ISSUES})" for hit, issue in cases)
    any_hit = " OR ".join(f"({hit})" for hit, _ in cases)
    return f"if(NOT is_copy AND ({any_hit}), concat({some}), {_NO_ISSUES})"


def _row(**columns: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in columns.items()) + ")"


def _with_copies(df: DataFrame, copied: str) -> DataFrame:
    """Every row, and once more with `is_copy` where `copied` holds.

    Only the mark is repeated: whole rows as array elements would state every column twice, in a
    generated method too long for the JVM to compile.
    """
    return df.withColumn("is_copy", F.expr(f"explode(if({copied}, array(false, true), array(false)))"))


def _explode_rows(df: DataFrame, rows: str) -> DataFrame:
    return df.select(F.expr(f"explode({rows})").alias("r")).select("r.*")


def _near_id(po_id: str = "po_id") -> str:
    return f"concat('ND', substring({po_id}, 3))"


def _dirty_headers(clean: Clean) -> DataFrame:
    slot = {name: f"slot = {number}" for name, number in SLOT.items()}
    near = f"({slot['near_duplicate_po']} AND is_copy)"
    details = {
        "missing_currency": "'currency set to NULL'",
        "invalid_currency": "concat('currency = ', bad_currency)",
        "bad_date_format": "'order_date as DD.MM.YYYY'",
        "orphan_supplier": f"'supplier_id {clean.orphan_supplier_id} does not exist'",
        "exact_duplicate_header": "'header row duplicated'",
        "near_duplicate_po": "concat('copy of ', po_id, ', order_date +1 day')",
        "missing_order_date": "'order_date set to NULL'",
    }
    issues = _issues(*[
        (slot[name], _issue("po_headers", _near_id() if name == "near_duplicate_po" else "po_id", name, detail))
        for name, detail in details.items()
    ])
    copied = f"({slot['exact_duplicate_header']} OR {slot['near_duplicate_po']})"
    return _with_copies(clean.headers, copied).selectExpr(
        f"if({near}, {_near_id()}, po_id) AS po_id",
        f"if({slot['orphan_supplier']}, '{clean.orphan_supplier_id}', supplier_id) AS supplier_id",
        f"""CASE WHEN {near} THEN string(date_add(order_date, 1))
            WHEN {slot['bad_date_format']} THEN date_format(order_date, 'dd.MM.yyyy')
            WHEN {slot['missing_order_date']} THEN NULL ELSE string(order_date) END AS order_date""",
        f"""CASE WHEN {slot['missing_currency']} THEN NULL
            WHEN {slot['invalid_currency']} THEN bad_currency ELSE currency END AS currency""",
        "string(total_amount) AS total_amount",
        f"{issues} AS issues",
    )


def _dirty_items(clean: Clean) -> DataFrame:
    first = {name: f"(slot = {number} AND item_no = 10)" for name, number in SLOT.items()}
    early, lost_parent = first["delivery_before_order"], first["orphan_po"]
    no_description = f"({first['missing_item_field']} AND blank_field = 'description')"
    no_quantity = f"({first['missing_item_field']} AND blank_field = 'quantity')"
    po_id = f"if({lost_parent}, concat('PX', substring(po_id, 3)), po_id)"
    record = f"concat({po_id}, '|', string(item_no))"
    issues = _issues(
        ("price_factor IS NOT NULL",
         _issue("po_items", record, "price_outlier", "concat('unit_price x', price_factor)", ml=True)),
        (f"quantity_factor IS NOT NULL AND NOT {no_quantity}",
         _issue("po_items", record, "quantity_outlier", "concat('quantity x', quantity_factor)", ml=True)),
        (early, _issue("po_items", record, "delivery_before_order", "'delivery_date earlier than order_date'")),
        (f"{no_description} OR {no_quantity}",
         _issue("po_items", record, "missing_item_field", "concat(blank_field, ' set to NULL')")),
        (lost_parent, _issue("po_items", record, "orphan_po", "'po_id has no header'")),
    )

    near_duplicate = f"slot = {SLOT['near_duplicate_po']}"
    return _with_copies(clean.items, near_duplicate).selectExpr(
        f"if(is_copy, {_near_id()}, {po_id}) AS po_id",
        "string(item_no) AS item_no",
        f"if({no_description}, NULL, description) AS description",
        f"if({no_quantity}, NULL, string(quantity * coalesce(quantity_factor, 1))) AS quantity",
        "string(if(price_factor IS NULL, cast(unit_price as decimal(18,2)), cast(unit_price * price_factor as decimal(18,2)))) AS unit_price",
        f"string(if({early}, date_sub(order_date, early_days), delivery_date)) AS delivery_date",
        "true_category",
        f"{issues} AS issues",
    )


def _with_name_variants(clean: Clean) -> DataFrame:
    def row(supplier_id: str, name: str, marks: str) -> str:
        return _row(supplier_id=supplier_id, name=name, country="country", payment_terms="payment_terms",
                    created_date="string(created_date)", issues=marks)

    variant = "concat('V', substring(supplier_id, 2))"
    issue = _issue("suppliers", variant, "inconsistent_supplier_name",
                   "concat('variant of ', supplier_id, ' (', name, ')')")
    original = row("supplier_id", "name", _NO_ISSUES)
    renamed = row(variant, "concat(upper(replace(name, ',', '')), ' Gmbh.')", f"array({issue})")
    return _explode_rows(clean.suppliers, f"if(make_variant, array({original}, {renamed}), array({original}))")


class Bronze:
    """Dirty text tables, each built when first asked for.

    The `…_marked` frames also hold the issues of each row. A frame named in `store` is
    written once when first asked for and read from then on.
    """

    def __init__(self, clean: Clean, store: Collection[str] = ()):
        self._clean, self._store = clean, store

    def stored(self, *names: str) -> Bronze:
        """With these of suppliers, headers and items stored, or all of them."""
        return Bronze(self._clean, store=names or ("suppliers", "headers", "items"))

    def _keep(self, df: DataFrame, label: str) -> DataFrame:
        return cut(df, label) if label in self._store else df

    @cached_property
    def suppliers_marked(self) -> DataFrame:
        return self._keep(_with_name_variants(self._clean), "suppliers")

    @cached_property
    def headers_marked(self) -> DataFrame:
        return self._keep(_dirty_headers(self._clean), "headers")

    @cached_property
    def items_marked(self) -> DataFrame:
        return self._keep(_dirty_items(self._clean), "items")

    @property
    def hot_item_pos(self) -> Sequence[HotKey] | None:
        return self._clean.hot_item_pos

    @property
    def suppliers(self) -> DataFrame:
        return self.suppliers_marked.drop("issues")

    @property
    def headers(self) -> DataFrame:
        return self.headers_marked.drop("issues")

    @property
    def items(self) -> DataFrame:
        return self.items_marked.drop("issues", "true_category")

    @property
    def truth(self) -> DataFrame:
        """The true category of every line."""
        return self.items_marked.select("po_id", "item_no", "true_category")

    @property
    def answer_key(self) -> DataFrame:
        marked = [self.suppliers_marked, self.headers_marked, self.items_marked]
        rows = [m.select(F.explode("issues").alias("i")).select("i.*") for m in marked]
        return rows[0].unionByName(rows[1]).unionByName(rows[2])

    def tables(self) -> dict[str, DataFrame]:
        """The five landing files."""
        # Those to be stored are, side by side.
        at_once(self._clean.suppliers.sparkSession, [partial(getattr, self, f"{name}_marked") for name in self._store])
        return {
            "suppliers": self.suppliers,
            "po_headers": self.headers,
            "po_items": self.items,
            "ground_truth_categories": self.truth,
            "corruption_log": self.answer_key,
        }


def issue_summary(bronze: Bronze) -> DataFrame:
    """Table row counts and logged rows per issue type, most frequent first."""
    sizes = None
    for name, df in (("suppliers", bronze.suppliers), ("po_headers", bronze.headers), ("po_items", bronze.items)):
        size = df.agg(F.count("*").alias("n")).select(F.lit("rows").alias("kind"), F.lit(name).alias("name"), "n")
        sizes = size if sizes is None else sizes.unionByName(size)
    issues = (
        bronze.answer_key.groupBy(F.col("issue_type").alias("name"))
        .agg(F.count("*").alias("n"))
        .select(F.lit("issue").alias("kind"), "name", "n")
    )
    return sizes.unionByName(issues).orderBy(F.desc("kind"), F.desc("n"), "name")


def order_totals(items: DataFrame) -> DataFrame:
    """Order value: the sum over its lines of quantity x unit_price, each rounded to cents."""
    line_value = F.round(F.col("quantity") * F.col("unit_price"), 2).cast("decimal(18,2)")
    return items.groupBy("po_id").agg(F.sum(line_value).cast("decimal(18,2)").alias("total_amount"))
