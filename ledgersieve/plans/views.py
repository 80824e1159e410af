"""Staging and the latest run as views in the catalogue, over the current versions of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgersieve.functions.convert import ISO_DATE
from ledgersieve.plans.monitoring import RunHistory
from ledgersieve.schemas import BRONZE_TABLES
from ledgersieve.sources.tables import source, stored_view

_DATE = f"try_to_date({{0}}, '{ISO_DATE}')"
# The columns of each staging view, as SQL over its bronze table.
STAGING = {
    "suppliers": f"""supplier_id, name AS supplier_name, country, payment_terms,
        {_DATE.format('created_date')} AS created_date""",
    "po_headers": f"""po_id, supplier_id, order_date AS order_date_raw, {_DATE.format('order_date')} AS order_date,
        upper(trim(currency)) AS currency, try_cast(total_amount AS decimal(18,2)) AS total_amount""",
    "po_items": f"""po_id, try_cast(item_no AS decimal(38,0)) AS item_no, description,
        try_cast(quantity AS decimal(38,0)) AS quantity, try_cast(unit_price AS decimal(18,2)) AS unit_price,
        delivery_date AS delivery_date_raw, {_DATE.format('delivery_date')} AS delivery_date""",
}


def _named(database: str, name: str) -> str:
    return f"{database}.{name}" if database else name


def staging_views(spark: SparkSession, bronze: str, database: str = "") -> dict[str, DataFrame]:
    """stg_suppliers, stg_po_headers and stg_po_items over loaded bronze. State them again after a load."""
    return {
        stem: stored_view(
            spark, _named(database, f"stg_{stem}"),
            f"SELECT {columns} FROM {source(spark, f'{bronze}/{BRONZE_TABLES[stem][0]}')}")
        for stem, columns in STAGING.items()
    }


def latest_run_view(history: RunHistory, database: str = "") -> DataFrame:
    """dq_monitoring_latest: whatever run is the most recent when the view is read, until a full refresh."""
    runs = f"parquet.`{history.version()}`"
    return stored_view(
        history.spark, _named(database, "dq_monitoring_latest"),
        f"""SELECT run_at, table_name, metric, value, pct_of_staging FROM {runs}
        WHERE run_id = (SELECT max(run_id) FROM {runs})""")
