"""One full run: staging, quarantine, silver, evaluation, monitoring, with checks in between."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgersieve.datagen.inject import Bronze
from ledgersieve.operators.checks import Check, run_checks, stop_on_errors, store_failures
from ledgersieve.operators.skew import HotKey, find_hot_keys
from ledgersieve.operators.steps import Step, StepFailed, run_steps
from ledgersieve.plans import checks, evaluation, monitoring, profiling
from ledgersieve.plans.quarantine import (
    JudgedHeaders, JudgedLines, judge_headers, judge_lines, quarantine_headers, quarantine_items,
)
from ledgersieve.plans.silver import silver_headers, silver_items, silver_suppliers
from ledgersieve.plans.staging import stage_headers, stage_items, stage_suppliers
from ledgersieve.sources.landing import LoadedBronze
from ledgersieve.sources.tables import Warehouse


def staging_tables(bronze: Bronze | LoadedBronze) -> dict[str, DataFrame]:
    return {
        "suppliers": stage_suppliers(bronze.suppliers),
        "po_headers": stage_headers(bronze.headers),
        "po_items": stage_items(bronze.items),
    }


QUARANTINE = ("quarantine.po_headers", "quarantine.po_items")
SILVER = ("silver.suppliers", "silver.po_headers", "silver.po_items")


class Layers:
    """Staging, quarantine and silver over one bronze, each built when first asked for.

    Staging is computed on read. Tables named in `kept` are stored once and read from then
    on; the others stay queries, for callers that read them a single time.
    """

    def __init__(self, bronze: Bronze | LoadedBronze, store: Warehouse, kept: Collection[str] = QUARANTINE + SILVER):
        self.bronze, self._store, self._kept = bronze, store, kept

    def _keep(self, layer: str, name: str, df: DataFrame, buckets: Sequence[str] = ()) -> DataFrame:
        return self._store.replace(layer, name, df, buckets=buckets) if f"{layer}.{name}" in self._kept else df

    @cached_property
    def staging(self) -> dict[str, DataFrame]:
        return staging_tables(self.bronze)

    @cached_property
    def hot_headers(self) -> dict[str, list[HotKey]]:
        """Heavy PO ids and suppliers of the headers, looked up once for rules and checks."""
        return find_hot_keys(self.staging["po_headers"], "po_id", "supplier_id")

    @cached_property
    def judged_headers(self) -> JudgedHeaders:
        """Both quarantine tables and silver headers are read off this one."""
        return judge_headers(self.staging["po_headers"], self.staging["suppliers"], self.hot_headers).stored()

    @cached_property
    def quarantined_headers(self) -> DataFrame:
        return self._keep("quarantine", "po_headers", quarantine_headers(self.judged_headers))

    @cached_property
    def judged_lines(self) -> JudgedLines:
        """The lines placed by PO: quarantine, silver, checks and accounting read them where they lie."""
        return judge_lines(self.staging["po_items"], self.judged_headers, self.bronze.hot_item_pos).stored()

    @cached_property
    def quarantined_items(self) -> DataFrame:
        return self._keep("quarantine", "po_items", quarantine_items(self.judged_lines))

    @property
    def quarantined(self) -> DataFrame:
        return self.quarantined_headers.unionByName(self.quarantined_items)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        lines = self.judged_lines
        # Silver lines stay placed as they are, unless that needs a column which silver does not have.
        placed = lines.placed_by if lines.placed_by == ("po_id",) else ()
        return {
            "suppliers": self._keep("silver", "suppliers", silver_suppliers(self.staging["suppliers"])),
            "po_headers": self._keep("silver", "po_headers", silver_headers(self.judged_headers)),
            "po_items": self._keep("silver", "po_items", silver_items(lines), placed),
        }

    @property
    def placed_staging(self) -> dict[str, DataFrame]:
        """Staging with the lines as the judged ones hold them: they are not converted again."""
        return self.staging | {"po_items": self.judged_lines.staged()}

    def checked_tables(self) -> dict[str, DataFrame]:
        tables = {f"stg_{name}": df for name, df in self.placed_staging.items()}
        return tables | {f"silver_{name}": df for name, df in self.silver.items()}

    def staging_checks(self) -> list[Check]:
        return checks.staging_checks(self.bronze.hot_item_pos, self.hot_headers["supplier_id"])

    def silver_checks(self) -> list[Check]:
        return checks.silver_checks(self.bronze.hot_item_pos, self.hot_headers["supplier_id"])


@dataclass(frozen=True)
class Run:
    layers: Layers
    staging_report: DataFrame
    silver_report: DataFrame
    accounting: DataFrame
    recall: DataFrame
    precision: DataFrame
    history: DataFrame


class RowsUnaccounted(StepFailed):
    """Some staged rows are neither in silver nor in quarantine. The accounting is already stored."""


def account(layers: Layers) -> DataFrame:
    return monitoring.row_accounting(
        layers.staging["po_headers"], layers.judged_lines.staged(), layers.silver["po_headers"],
        layers.silver["po_items"], layers.quarantined_headers, layers.quarantined_items)


def run(
    spark: SparkSession, bronze: Bronze | LoadedBronze, root: str, run_at: datetime, full_refresh: bool = False
) -> Run:
    """Profile bronze, then build every layer.

    Silver tables that fail a check, or rows that are unaccounted for, stop what is built on them and
    nothing else; the run then ends in StepsFailed, with everything else stored. Checks keep their
    failing rows either way.
    """
    store = Warehouse(spark, root)
    layers = Layers(bronze, store)
    history = monitoring.RunHistory(spark, store.path("monitoring", "run_history"))
    rule_map = evaluation.issue_rule_map(spark)

    def profiles(done):
        store.replace("profiling", "column_profile", profiling.column_profile(bronze.suppliers, bronze.headers, bronze.items))
        store.replace("profiling", "pattern_checks", profiling.pattern_checks(
            bronze.suppliers, bronze.headers, bronze.items, bronze.hot_item_pos))

    def staging_report(done):
        return run_checks(layers.staging_checks(), layers.checked_tables(), store)

    def silver_report(done):
        return store_failures(layers.silver_checks(), layers.checked_tables(), store)

    def silver(name):
        def judge(done):
            stop_on_errors(done["silver report"], f"silver_{name}")
            return layers.silver[name]
        return judge

    def accounting(done):
        table = store.replace("monitoring", "row_accounting", account(layers))
        lost = table.where("unaccounted <> 0").collect()  # one row per table at most
        if lost:
            raise RowsUnaccounted(", ".join(f"{r['table_name']}: {r['unaccounted']}" for r in lost))
        return table

    def recall(done):
        return store.replace("evaluation", "issue_recall", evaluation.issue_recall(bronze.answer_key, layers.quarantined, rule_map))

    def precision(done):
        return store.replace("evaluation", "rule_precision", evaluation.rule_precision(bronze.answer_key, layers.quarantined, rule_map))

    def monitor(done):
        metrics = monitoring.run_metrics(layers.placed_staging, layers.silver, layers.quarantined, run_at)
        add = history.full_refresh if full_refresh else history.append
        add(metrics, run_at)
        return history.rows()

    outcome = run_steps([
        Step("profiles", profiles),
        Step("staging report", staging_report),
        Step("silver report", silver_report),
        *[Step(name, silver(name.split(".")[1]), ("silver report",)) for name in SILVER],
        Step("recall", recall),
        Step("precision", precision),
        Step("accounting", accounting, ("silver.po_headers", "silver.po_items")),
        Step("history", monitor, (*SILVER, "accounting")),
    ])
    outcome.raise_if_failed()
    done = outcome.results
    return Run(layers, done["staging report"], done["silver report"], done["accounting"], done["recall"], done["precision"], done["history"])
