"""One callable per output. Each reads whole tables from a folder and returns a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType

from ledgersieve.datagen import fixtures, inject, synth
from ledgersieve.operators import checks as c
from ledgersieve.operators import profiling as p
from ledgersieve.operators.skew import hashed_joins
from ledgersieve.plans import build, evaluation, monitoring, profiling, quarantine, silver, staging, views
from ledgersieve.plans import checks as po_checks
from ledgersieve.schemas import BRONZE_TABLES, CURRENCIES
from ledgersieve.sources import landing
from ledgersieve.sources.cut import new_folder
from ledgersieve.sources.tables import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

FIRST_RUN = datetime(2024, 1, 1)
SECOND_RUN = datetime(2024, 1, 2)
THIRD_RUN = datetime(2024, 1, 3)
SYNTH_SEED = 42
SYNTH_SUPPLIERS_PER_ORDER = 100


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as numbers, which every engine hands over alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (DateType, TimestampType)):
            column = column.cast("string")
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double" if field.dataType.scale else "bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _bronze(spark: SparkSession, sf_dir: str) -> inject.Bronze:
    return fixtures.bronze_from_tables(spark, sf_dir)


def _judged(bronze: inject.Bronze) -> quarantine.JudgedHeaders:
    return quarantine.judge_headers(
        staging.stage_headers(bronze.headers), staging.stage_suppliers(bronze.suppliers))


def _layers(spark: SparkSession, sf_dir: str, *kept: str, scored: bool = False) -> build.Layers:
    """For outputs that read several layers; `kept` are the tables read more than once.

    Bronze lines are read once, when they are judged, unless an answer key is scored or heavy records
    have to be looked up: only then are they stored.
    """
    bronze = _bronze(spark, sf_dir)
    often = () if scored or bronze.hot_item_pos else ("suppliers", "headers")
    return build.Layers(bronze.stored(*often), Warehouse(spark, new_folder(spark, "layers")), kept)


# --- staging ---------------------------------------------------------------------------


def stg_suppliers(spark, sf_dir):
    return plain(staging.stage_suppliers(_bronze(spark, sf_dir).suppliers))


def stg_po_headers(spark, sf_dir):
    return plain(staging.stage_headers(_bronze(spark, sf_dir).headers))


def stg_po_items(spark, sf_dir):
    return plain(staging.stage_items(_bronze(spark, sf_dir).items))


# --- landing and bronze ----------------------------------------------------------------


def load_audit(spark, sf_dir):
    """Write the five landing files, load them, load them again: the counts do not change."""
    folder, bronze_root = new_folder(spark, "landing"), new_folder(spark, "bronze")
    landing.write_landing(_bronze(spark, sf_dir).stored().tables(), folder)
    landing.load_bronze(spark, folder, bronze_root)
    return landing.load_bronze(spark, folder, bronze_root)


def bronze_from_csv(spark, sf_dir):
    """All five tables after the trip through compressed text files, their fields by position."""
    folder = new_folder(spark, "landing")
    landing.write_landing(_bronze(spark, sf_dir).stored().tables(), folder)
    width = max(len(schema) for _, schema in BRONZE_TABLES.values())

    def fields(stem: str) -> DataFrame:
        table_name, schema = BRONZE_TABLES[stem]
        found = [F.col(c) for c in schema.names] + [F.lit(None).cast("string")] * (width - len(schema))
        return landing.read_landing(spark, folder, stem, schema).select(
            F.lit(table_name).alias("table_name"), *[c.alias(f"field_{i}") for i, c in enumerate(found, 1)])

    return reduce(DataFrame.unionByName, [fields(stem) for stem in BRONZE_TABLES])


def landed_files(spark, sf_dir):
    """Every landed table: whether its files hold bytes, and the rows read back from them.

    Sizes and numbers of files depend on the codec and the cores, so they are not part of the result.
    """
    folder = new_folder(spark, "landing")
    landing.write_landing(_bronze(spark, sf_dir).stored().tables(), folder)
    stem = F.regexp_extract("path", r"([a-z_]+)\.csv", 1)
    files = landing.landed_files(spark, folder).groupBy(stem.alias("file_stem"))
    files = files.agg((F.sum("bytes") > 0).alias("has_bytes"))
    read = reduce(DataFrame.unionByName, [
        landing.read_landing(spark, folder, name, schema).agg(F.count("*").alias("rows_read"))
        .select(F.lit(name).alias("file_stem"), "rows_read") for name, (_, schema) in BRONZE_TABLES.items()])
    return files.join(read, "file_stem")


# --- profiling -------------------------------------------------------------------------


def load_counts(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return profiling.load_counts(b.suppliers, b.headers, b.items)


def header_quick_profile(spark, sf_dir):
    return profiling.header_quick_profile(_bronze(spark, sf_dir).headers)


def column_profile(spark, sf_dir):
    b = _bronze(spark, sf_dir).stored()
    return profiling.column_profile(b.suppliers, b.headers, b.items)


def pattern_checks(spark, sf_dir):
    b = _bronze(spark, sf_dir).stored()
    return profiling.pattern_checks(b.suppliers, b.headers, b.items, b.hot_item_pos)


def currency_distribution(spark, sf_dir):
    return profiling.currency_distribution(_bronze(spark, sf_dir).headers)


def numeric_spread(spark, sf_dir):
    return profiling.numeric_spread(_bronze(spark, sf_dir).stored().items)


def merged_profile(spark, sf_dir):
    """Profiles of old and new lines are stored apart and merged; estimates are judged by the exact counts."""
    lines = fixtures.table(spark, sf_dir, "lineitem")
    store, old = Warehouse(spark, new_folder(spark, "profiles")), F.col("l_shipdate") < "1995-01-01"
    parts = {"old": lines.where(old), "new": lines.where(~old | old.isNull())}
    kept = [store.replace("profiling", name, p.profile_sketches({"lineitem": df})) for name, df in parts.items()]
    merged = p.approximate_profile(p.merge_profiles(*kept))
    exact = p.column_profile({"lineitem": lines}).select("column_name", F.col("distinct_count").alias("exact"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= F.col("exact") * 0.05
    return merged.join(exact, "column_name").select(
        "table_name", "column_name", "total_rows", "null_count", "min_value", "max_value", near.alias("near_exact"))


# --- quarantine and silver -------------------------------------------------------------


def quarantine_po_headers(spark, sf_dir):
    return quarantine.quarantine_headers(_judged(_bronze(spark, sf_dir)))


def _judged_lines(spark: SparkSession, sf_dir: str) -> quarantine.JudgedLines:
    b = _bronze(spark, sf_dir)
    return quarantine.judge_lines(staging.stage_items(b.items), _judged(b), b.hot_item_pos)


def quarantine_po_items(spark, sf_dir):
    return quarantine.quarantine_items(_judged_lines(spark, sf_dir))


def silver_suppliers(spark, sf_dir):
    return plain(silver.silver_suppliers(staging.stage_suppliers(_bronze(spark, sf_dir).suppliers)))


def silver_po_headers(spark, sf_dir):
    return plain(silver.silver_headers(_judged(_bronze(spark, sf_dir))))


def silver_po_items(spark, sf_dir):
    return plain(silver.silver_items(_judged_lines(spark, sf_dir)))


# --- checks ----------------------------------------------------------------------------


def check_not_null(spark, sf_dir):
    return plain(c.not_null(staging.stage_headers(_bronze(spark, sf_dir).headers), "order_date"))


def check_unique(spark, sf_dir):
    return c.unique(staging.stage_headers(_bronze(spark, sf_dir).headers), "po_id")


def check_accepted_values(spark, sf_dir):
    return c.accepted_values(staging.stage_headers(_bronze(spark, sf_dir).headers), "currency", CURRENCIES)


def check_relationships(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    headers, suppliers = staging.stage_headers(b.headers), staging.stage_suppliers(b.suppliers)
    return c.relationships(headers, "supplier_id", suppliers, "supplier_id").select("supplier_id", "po_id")


def check_custom(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return plain(po_checks.delivered_before_ordered(
        staging.stage_items(b.items), staging.stage_headers(b.headers), b.hot_item_pos))


def check_report(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    return c.check_report(layers.staging_checks() + layers.silver_checks(), layers.checked_tables())


def stored_failures(spark, sf_dir):
    """Rows kept behind each check of staging and silver."""
    layers = _layers(spark, sf_dir)
    checks = layers.staging_checks() + layers.silver_checks()
    store = Warehouse(spark, new_folder(spark, "test-failures"))
    c.store_failures(checks, layers.checked_tables(), store)
    names = spark.createDataFrame([(x.table, x.label) for x in checks], "table_name string, check_name string")
    kept = reduce(DataFrame.unionByName, [
        c.kept_failures(store, t).select(F.lit(t).alias("table_name"), "check_name") for t in dict.fromkeys(x.table for x in checks)])
    counted = kept.groupBy("table_name", "check_name").agg(F.count("*").alias("n"))
    return names.join(counted, ["table_name", "check_name"], "left").select(
        "table_name", "check_name", F.coalesce("n", F.lit(0)).alias("stored_rows"))


# --- evaluation and monitoring ---------------------------------------------------------


def issue_recall(spark, sf_dir):
    layers = _layers(spark, sf_dir, scored=True)
    return evaluation.issue_recall(layers.bronze.answer_key, layers.quarantined, evaluation.issue_rule_map(spark))


def rule_precision(spark, sf_dir):
    layers = _layers(spark, sf_dir, scored=True)
    return evaluation.rule_precision(layers.bronze.answer_key, layers.quarantined, evaluation.issue_rule_map(spark))


def run_metrics(spark, sf_dir):
    layers = _layers(spark, sf_dir, "quarantine.po_items")
    return plain(_metrics(layers, FIRST_RUN))


def _run_layers(spark: SparkSession, sf_dir: str) -> build.Layers:
    """For several runs over the same tables."""
    return _layers(spark, sf_dir, *build.QUARANTINE, *build.SILVER)


def _metrics(layers: build.Layers, run_at: datetime) -> DataFrame:
    return monitoring.run_metrics(layers.placed_staging, layers.silver, layers.quarantined, run_at)


def _history(spark: SparkSession, layers: build.Layers, *runs: tuple[datetime, bool]) -> monitoring.RunHistory:
    """A history of these runs, each an instant and whether it starts the history again."""
    history = monitoring.RunHistory(spark, new_folder(spark, "run-history"))
    for run_at, full_refresh in runs:
        (history.full_refresh if full_refresh else history.append)(_metrics(layers, run_at), run_at)
    return history


def monitoring_latest(spark, sf_dir):
    """Two runs are appended; the second is shown."""
    return plain(_history(spark, _run_layers(spark, sf_dir), (FIRST_RUN, False), (SECOND_RUN, False)).latest())


def monitoring_latest_view(spark, sf_dir):
    """The same by way of a view in the catalogue, read by name; it was made before the second run."""
    layers = _run_layers(spark, sf_dir)
    history = _history(spark, layers, (FIRST_RUN, False))
    name = f"runs_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, name)}'")
    views.latest_run_view(history, name)
    history.append(_metrics(layers, SECOND_RUN), SECOND_RUN)
    spark.catalog.refreshTable(f"{name}.dq_monitoring_latest")
    return plain(spark.table(f"{name}.dq_monitoring_latest"))


def refreshed_history(spark, sf_dir):
    """A full refresh starts the history again with the second run; the third is appended."""
    history = _history(spark, _run_layers(spark, sf_dir), (FIRST_RUN, False), (SECOND_RUN, True), (THIRD_RUN, False))
    return plain(history.rows().drop("run_id"))


def staged_by_view(spark, sf_dir):
    """Loaded bronze seen through the staging views of the catalogue."""
    folder, loaded = new_folder(spark, "landing"), new_folder(spark, "bronze")
    landing.write_landing(_bronze(spark, sf_dir).stored().tables(), folder)
    landing.load_bronze(spark, folder, loaded)
    name = f"staging_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, name)}'")
    views.staging_views(spark, loaded, name)
    return plain(spark.sql(f"""
        SELECT h.po_id, h.order_date, h.currency, h.total_amount, s.country, i.n_lines, i.quantity
        FROM {name}.stg_po_headers h LEFT JOIN {name}.stg_suppliers s ON h.supplier_id = s.supplier_id
        LEFT JOIN (SELECT po_id, count(*) AS n_lines, sum(quantity) AS quantity FROM {name}.stg_po_items GROUP BY po_id) i
          ON h.po_id = i.po_id"""))


def row_accounting(spark, sf_dir):
    layers = _layers(spark, sf_dir, "quarantine.po_items")
    return build.account(layers)


def recall_from_csv(spark, sf_dir):
    """Land the tables as text, load them, run everything on what was loaded, and score the rules."""
    folder, loaded = new_folder(spark, "landing"), new_folder(spark, "bronze")
    with hashed_joins(spark):
        landing.write_landing(_bronze(spark, sf_dir).stored().tables(), folder)
        landing.load_bronze(spark, folder, loaded)
        bronze = landing.LoadedBronze(spark, loaded)
        return build.run(spark, bronze, new_folder(spark, "warehouse"), FIRST_RUN).recall


# --- generation ------------------------------------------------------------------------


def answer_key(spark, sf_dir):
    return _bronze(spark, sf_dir).answer_key


def inject_summary(spark, sf_dir):
    return inject.issue_summary(_bronze(spark, sf_dir).stored())


def order_totals(spark, sf_dir):
    return plain(inject.order_totals(staging.stage_items(_bronze(spark, sf_dir).items)))


def _synthetic(spark: SparkSession, sf_dir: str):
    """One made-up order per stored order, and one supplier per hundred of them."""
    orders = fixtures.table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("po_no"))
    suppliers = max(3, orders.count() // SYNTH_SUPPLIERS_PER_ORDER)
    return synth.SyntheticOrders(spark, orders, suppliers, SYNTH_SEED)


def synthetic_headers(spark, sf_dir):
    return plain(_synthetic(spark, sf_dir).headers.drop("order_hash", "supplier_hash", "supplier_no"))


def synthetic_items(spark, sf_dir):
    return plain(_synthetic(spark, sf_dir).items)


def seeded_answer_key(spark, sf_dir):
    return inject.Bronze(_synthetic(spark, sf_dir)).answer_key


# --- the same operators on the tables as they are ----------------------------------------


def table_profile(spark, sf_dir):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    return p.column_profile({name: fixtures.table(spark, sf_dir, name) for name in names})


def line_value_spread(spark, sf_dir):
    return p.numeric_spread(fixtures.table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])


def priority_distribution(spark, sf_dir):
    return p.frequency(fixtures.table(spark, sf_dir, "orders"), "o_orderpriority")


def repeated_line_keys(spark, sf_dir):
    return c.unique(fixtures.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def unlabelled_documents(spark, sf_dir):
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return c.relationships(documents, "doc_id", fixtures.table(spark, sf_dir, "labels"), "doc_id")


def unexpected_event_types(spark, sf_dir):
    return c.accepted_values(fixtures.table(spark, sf_dir, "events"), "event_type", ("view", "click"))


def shipped_before_ordered(spark, sf_dir):
    lines = fixtures.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("po_id"), F.col("l_linenumber").alias("item_no"),
        F.col("l_shipdate").cast("date").alias("delivery_date"))
    orders = fixtures.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("po_id"), F.col("o_orderdate").cast("date").alias("order_date"))
    return plain(po_checks.delivered_before_ordered(lines, orders))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        stg_suppliers, stg_po_headers, stg_po_items, staged_by_view,
        load_audit, bronze_from_csv, landed_files,
        load_counts, header_quick_profile, column_profile, pattern_checks, currency_distribution, numeric_spread,
        merged_profile,
        quarantine_po_headers, quarantine_po_items,
        silver_suppliers, silver_po_headers, silver_po_items,
        check_not_null, check_unique, check_accepted_values, check_relationships, check_custom,
        check_report, stored_failures,
        issue_recall, rule_precision, run_metrics, monitoring_latest, monitoring_latest_view, refreshed_history,
        row_accounting, recall_from_csv,
        answer_key, inject_summary, order_totals,
        synthetic_headers, synthetic_items, seeded_answer_key,
        table_profile, line_value_spread, priority_distribution, repeated_line_keys,
        unlabelled_documents, unexpected_event_types, shipped_before_ordered,
    )
}
