"""Declarative dataset checks. A check yields its failing rows; no rows means it passed."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgersieve.operators.skew import HotKey, skew_safe_join
from ledgersieve.operators.steps import StepFailed
from ledgersieve.sources.cut import cut
from ledgersieve.sources.tables import Warehouse

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """kind is not_null, unique, accepted_values, relationships or custom.

    A custom check names a function from the tables to failing rows; `weight` says how
    many failures one such row stands for. `hot` may give the known heavy values of `column`.
    """

    table: str
    kind: str
    column: str = ""
    severity: str = "warn"
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""
    rows: Callable[[Tables], DataFrame] | None = None
    weight: str = ""
    name: str = ""
    hot: tuple[HotKey, ...] | None = None

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}_{self.column}"


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once. Several columns form one key."""
    keyed = df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))
    return keyed.groupBy(*columns).agg(F.count("*").alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the list with their row counts. NULL is not a value."""
    outside = df.where(~F.col(column).isin(*values))
    return outside.groupBy(column).agg(F.count("*").alias("n_records"))


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str,
    hot: Sequence[HotKey] | None = None,
) -> DataFrame:
    """Child rows whose value has no parent row."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return skew_safe_join(child.where(F.col(column).isNotNull()), keys, column, "left_anti", hot)


def _orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The same, counted: one row per child value meets the parents."""
    per_value = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    lost = per_value.join(keys, column, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("failures"))


def _orphan_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The child's values without a parent, once each."""
    values = child.select(column).where(F.col(column).isNotNull()).distinct()
    return values.join(parent.select(F.col(parent_column).alias(column)).distinct(), column, "left_anti")


def failing_rows(check: Check, tables: Tables) -> DataFrame:
    df = tables[check.table] if check.table in tables else None
    if check.kind == "not_null":
        return not_null(df, check.column)
    if check.kind == "unique":
        return unique(df, check.column)
    if check.kind == "accepted_values":
        return accepted_values(df, check.column, check.values)
    if check.kind == "relationships":
        return relationships(df, check.column, tables[check.parent], check.parent_column, check.hot)
    if check.kind == "custom":
        return check.rows(tables)
    raise ValueError(f"unknown check kind {check.kind!r}")


def failure_counts(checks: Iterable[Check], tables: Tables) -> DataFrame:
    """Failures per check. Column checks of one table share a single aggregate."""
    parts = []
    by_table: dict[str, dict[str, Column]] = {}

    def add(check: Check, counted: DataFrame) -> None:
        failures = F.coalesce(F.col("failures"), F.lit(0)).cast("bigint")
        parts.append(counted.select(
            F.lit(check.table).alias("table_name"), F.lit(check.label).alias("check_name"),
            failures.alias("failures"),
        ))

    for check in checks:
        value = F.col(check.column) if check.column else None
        if check.kind == "not_null":
            by_table.setdefault(check.table, {})[check.label] = F.count_if(value.isNull())
        elif check.kind == "accepted_values":
            outside = F.count_distinct(F.when(~value.isin(*check.values), value))
            by_table.setdefault(check.table, {})[check.label] = outside
        elif check.kind == "relationships":
            add(check, _orphan_count(
                tables[check.table], check.column, tables[check.parent], check.parent_column))
        else:
            weight = F.sum(check.weight) if check.weight else F.count("*")
            add(check, failing_rows(check, tables).agg(weight.alias("failures")))
    for table, counts in by_table.items():
        one_row = tables[table].agg(*[c.alias(label) for label, c in counts.items()])
        long = one_row.unpivot([], list(counts), "check_name", "failures")
        parts.append(long.select(F.lit(table).alias("table_name"), "check_name", "failures"))
    return reduce(DataFrame.unionByName, parts)


def _with_status(counted: DataFrame, checks: Sequence[Check]) -> DataFrame:
    severity = F.create_map(*[
        F.lit(part) for c in checks for part in (f"{c.table}.{c.label}", c.severity)
    ])
    level = F.element_at(severity, F.concat_ws(".", "table_name", "check_name"))
    return counted.withColumn("severity", level).select(
        "table_name", "check_name", "severity", "failures",
        F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")).alias("status"),
    )


def check_report(checks: list[Check], tables: Tables) -> DataFrame:
    """table_name, check_name, severity, failures, status (pass, warn or error)."""
    return _with_status(failure_counts(checks, tables), checks)


# --- one sink for all failing rows -------------------------------------------------------

SINK = "check_name string, failures bigint, row string"
_LAYER = "test_failures"


def _as_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def tagged_failures(checks: Sequence[Check], tables: Tables) -> DataFrame:
    """Every failing row of one table's checks: check_name, failures it stands for, and the row as JSON.

    Rows without a value or without a parent are tagged in one pass with every check they fail: values
    without a parent are found among the distinct ones first, so that whole rows meet only those. Values
    that occur too often or are not accepted are counted check by check from their column alone. Checks of
    their own kind add their rows.
    """
    table, parts = checks[0].table, []
    df = tables[table]
    rows = [c for c in checks if c.kind in ("not_null", "relationships")]
    if rows:
        known, broken = df, []
        for i, check in enumerate(rows):
            missing = F.col(check.column).isNull()
            if check.kind == "relationships":
                mark = f"_lost_{i}"
                lost = cut(_orphan_values(df, check.column, tables[check.parent], check.parent_column), "orphans")
                known = skew_safe_join(known, lost.withColumn(mark, F.lit(True)), check.column, "left", check.hot)
                missing = F.col(mark).isNotNull()
            broken.append((check.label, missing))
        # Few rows fail: the others go before any list is made, as lists are not compiled.
        labels = F.array_compact(F.array(*[F.when(missing, F.lit(label)) for label, missing in broken]))
        parts.append(known.where(reduce(Column.__or__, [missing for _, missing in broken])).select(
            F.explode(labels).alias("check_name"), F.lit(1).cast("bigint").alias("failures"), _as_json(df).alias("row")))
    for check in checks:
        if check.kind not in ("unique", "accepted_values"):
            continue
        value, repeats = F.col(check.column), check.kind == "unique"
        counted = df.where(value.isNotNull() if repeats else ~value.isin(*check.values)).groupBy(
            value.cast("string").alias("value")).agg(F.count("*").alias("n_records"))
        typed = F.col("value").cast(df.schema[check.column].dataType).alias(check.column)
        parts.append(counted.where(F.col("n_records") > (1 if repeats else 0)).select(
            F.lit(check.label).alias("check_name"), F.lit(1).cast("bigint").alias("failures"),
            F.to_json(F.struct(typed, "n_records")).alias("row")))
    for check in checks:
        if check.kind == "custom":
            own = check.rows(tables)
            weight = F.col(check.weight).cast("bigint") if check.weight else F.lit(1).cast("bigint")
            parts.append(own.select(F.lit(check.label).alias("check_name"), weight.alias("failures"), _as_json(own).alias("row")))
        elif check.kind not in ("not_null", "relationships", "unique", "accepted_values"):
            raise ValueError(f"unknown check kind {check.kind!r}")
    return reduce(DataFrame.unionByName, parts)


def kept_failures(store: Warehouse, table: str) -> DataFrame:
    """All rows kept for one table, by check."""
    return store.table(_LAYER, table, StructType.fromDDL(SINK))


def read_failures(store: Warehouse, table: str, check_name: str, schema: StructType) -> DataFrame:
    """The rows kept behind one check, typed as in `schema`; only its own files are read."""
    kept = kept_failures(store, table).where(F.col("check_name") == check_name)
    return kept.select(F.from_json("row", schema).alias("r")).select("r.*")


class ChecksFailed(StepFailed):
    """An error-level check has failing rows. The report and the rows are already stored."""


def store_failures(checks: Sequence[Check], tables: Tables, store: Warehouse) -> DataFrame:
    """Keep every failing row, in one write per table, by check; then the report, counted from what was kept."""
    kept = []
    for table in dict.fromkeys(c.table for c in checks):
        found = tagged_failures([c for c in checks if c.table == table], tables)
        rows = store.replace(_LAYER, table, found, partition_by=["check_name"])
        kept.append(rows.groupBy("check_name").agg(F.sum("failures").alias("n")).select(F.lit(table).alias("table_name"), "check_name", "n"))
    found = {(r["table_name"], r["check_name"]): r["n"] for r in reduce(DataFrame.unionByName, kept).collect()}  # one row per check
    counted = [(c.table, c.label, found.get((c.table, c.label), 0)) for c in checks]
    spark = kept[0].sparkSession
    return _with_status(spark.createDataFrame(counted, "table_name string, check_name string, failures bigint"), checks)


def run_checks(checks: list[Check], tables: Tables, store: Warehouse | None = None) -> DataFrame:
    """Report all checks, with a store keep the rows behind each failure, then stop on errors."""
    report = cut(check_report(checks, tables), "check-report") if store is None else store_failures(checks, tables, store)
    stop_on_errors(report)
    return report


def stop_on_errors(report: DataFrame, *tables: str) -> None:
    """Fail when an error-level check of these tables (or of any) has failing rows; a report has one row per check."""
    errors = report.where("status = 'error'")
    if tables:
        errors = errors.where(F.col("table_name").isin(*tables))
    failed = sorted(f"{r['table_name']}.{r['check_name']}" for r in errors.collect())
    if failed:
        raise ChecksFailed(", ".join(failed))
