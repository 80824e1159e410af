"""Run history: one set of metric rows per run, appended, and the latest of them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from ledgersieve.functions.convert import percent
from ledgersieve.sources import files, tables

METRICS = StructType([
    StructField("run_at", TimestampType()), StructField("table_name", StringType()),
    StructField("metric", StringType()), StructField("value", LongType()),
    StructField("pct_of_staging", DoubleType()),
])
HISTORY = StructType([*METRICS, StructField("run_id", StringType())])


def run_metrics(
    staging: Mapping[str, DataFrame], silver: Mapping[str, DataFrame], quarantined: DataFrame, run_at: datetime
) -> DataFrame:
    """Rows per layer and table, and quarantined rows per rule. `run_at` is passed in, not read."""
    def size(table_name: str, metric: str, df: DataFrame) -> DataFrame:
        counted = df.agg(F.count("*").alias("value"))
        return counted.select(F.lit(table_name).alias("table_name"), F.lit(metric).alias("metric"), "value")

    sizes = [size(t, "rows_in_staging", df) for t, df in staging.items()]
    sizes += [size(t, "rows_in_silver", df) for t, df in silver.items()]
    per_rule = quarantined.groupBy("table_name", "rule_name").agg(F.count("*").alias("value")).select(
        "table_name", F.concat(F.lit("quarantined_by_"), F.col("rule_name")).alias("metric"), "value"
    )
    metrics = reduce(DataFrame.unionByName, [*sizes, per_rule])
    # A handful of metric rows per table, whatever the size of the data.
    staged = F.max(F.when(F.col("metric") == "rows_in_staging", F.col("value"))).over(W.partitionBy("table_name"))
    return metrics.select(
        F.lit(run_at).cast("timestamp").alias("run_at"), "table_name", "metric", "value",
        percent(F.col("value"), staged, 2).alias("pct_of_staging"),
    )


@dataclass(frozen=True)
class RunHistory:
    """The metric rows of all runs, one folder per run.

    A run is written aside and then given the name of its instant in one step, which fails where the
    name is taken: of two runs with the same instant, however they overlap, one is refused whole.
    """

    spark: SparkSession
    folder: str

    def version(self) -> str:
        """The folder that holds the runs."""
        return tables.current(self.spark, self.folder) if tables.is_versioned(self.spark, self.folder) else f"{self.folder}/v-0"

    def run_id(self, run_at: datetime) -> str:
        """The instant in UTC; ids sort as the instants do."""
        instant = F.unix_micros(F.lit(run_at).cast("timestamp"))
        micros = self.spark.range(1).select(instant.alias("t")).first()["t"]
        return f"{datetime(1970, 1, 1) + timedelta(microseconds=micros):%Y%m%dT%H%M%S.%f}"

    def append(self, metrics: DataFrame, run_at: datetime) -> None:
        """Add one run. A run instant may be used once, or two runs would merge."""
        aside = f"{self.folder}/_run-{uuid.uuid4().hex}"
        metrics.coalesce(1).write.parquet(aside)  # tens of rows
        try:
            files.publish(self.spark, aside, f"{self.version()}/run_id={self.run_id(run_at)}")
        except files.Taken:
            files.delete(self.spark, aside)
            raise ValueError(f"the history already holds a run at {run_at}") from None

    def full_refresh(self, metrics: DataFrame, run_at: datetime) -> None:
        """Start again with this run alone. Readers see the old runs until the new one is complete."""
        version = tables.draft(self.folder)
        metrics.coalesce(1).write.parquet(f"{version}/run_id={self.run_id(run_at)}")
        tables.switch(self.spark, version)

    def rows(self) -> DataFrame:
        version = self.version()
        return self.spark.read.schema(HISTORY).option("basePath", version).parquet(version)

    def latest(self) -> DataFrame:
        """The rows of the most recent run, found by the names of the folders: no row of another run is read."""
        version = self.version()
        runs = [n for n in files.names(self.spark, version) if n.startswith("run_id=")]
        if not runs:
            return self.spark.createDataFrame([], METRICS)
        return self.spark.read.schema(METRICS).parquet(f"{version}/{runs[-1]}").orderBy("table_name", "metric")


def row_accounting(
    headers: DataFrame, items: DataFrame, silver_headers: DataFrame, silver_items: DataFrame,
    quarantined_headers: DataFrame, quarantined_items: DataFrame,
) -> DataFrame:
    """Does every staged record land in silver or in quarantine? `unaccounted` must be 0.

    Headers are counted by row: a row is a silver PO, an extra copy, or copy 1 of a PO that
    broke a rule. Lines are counted by record (po_id and item_no), plus one for each line without a
    key; further lines of the same record are reported as `repeated`. Staged and silver lines are
    grouped on their own, as a union would lose their place: where they are placed by PO, that needs
    no shuffle. Of the quarantine only its own rows are shuffled.
    """
    def per_record(df: DataFrame):
        return df.groupBy("po_id", "item_no").agg(F.count("*").alias("lines"))

    no_key = F.col("po_id").isNull() | F.col("item_no").isNull()
    records = F.when(no_key, F.col("lines")).otherwise(F.lit(1))

    # Of a line without a key only the rule that says so is counted.
    bad_lines = quarantined_items.groupBy("record_id").agg(
        F.when(F.col("record_id").isNull(), F.count_if(F.col("rule_name") == "missing_key")).otherwise(F.lit(1)).alias("n"))

    is_copy = F.col("rule_name") == "duplicate_po_id"
    per_po = quarantined_headers.groupBy("record_id").agg(
        (F.count_if(is_copy) + F.max((~is_copy).cast("int"))).alias("n")
    )
    parts = [
        ("po_headers", headers.agg(F.count("*").alias("staged"))),
        ("po_headers", silver_headers.agg(F.count("*").alias("silver"))),
        ("po_headers", per_po.agg(F.sum("n").alias("quarantined"))),
        ("po_items", per_record(items).agg(
            F.sum(records).alias("staged"), F.sum(F.col("lines") - records).alias("repeated"))),
        ("po_items", per_record(silver_items).agg(F.count_if(~no_key).alias("silver"))),
        ("po_items", bad_lines.agg(F.sum("n").alias("quarantined"))),
    ]
    counts = reduce(DataFrame.unionByName, [
        df.unpivot([], df.columns, "kind", "n").select(F.lit(t).alias("table_name"), "kind", "n") for t, df in parts
    ])

    def pick(kind: str):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("bigint").alias(kind)

    kinds = ("staged", "repeated", "silver", "quarantined")
    table = counts.groupBy("table_name").agg(*[pick(k) for k in kinds])
    return table.withColumn("unaccounted", F.col("staged") - F.col("silver") - F.col("quarantined"))
