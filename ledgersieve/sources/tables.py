"""Tables under one root: bronze, profiling, quarantine, silver, evaluation, …

A table is a folder of versions and a small file that names the current one. A new version is
written beside the old one and becomes current in one step, so a job that is lost half way leaves
the old rows as they were. The version before the current one stays for readers that still use it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgersieve.sources import files

_CURRENT = "_current"
_WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """The current version and the one before it."""
    return (files.read_text(spark, f"{folder}/{_CURRENT}") or "").split()


def current(spark: SparkSession, folder: str) -> str:
    """The folder of a table's current version."""
    found = _versions(spark, folder)
    if not found:
        raise FileNotFoundError(folder)
    return f"{folder}/{found[0]}"


def is_versioned(spark: SparkSession, folder: str) -> bool:
    return bool(_versions(spark, folder))


def draft(folder: str) -> str:
    """A folder for a new version."""
    return f"{folder}/v-{uuid.uuid4().hex}"


def switch(spark: SparkSession, version: str) -> None:
    """Make a finished version current, and delete the version before the last."""
    folder, name = version.rsplit("/", 1)
    before = _versions(spark, folder)
    files.replace_text(spark, f"{folder}/{_CURRENT}", "\n".join([name, *before[:1]]))
    for old in before[1:]:
        files.delete(spark, f"{folder}/{old}")


def write_buckets(df: DataFrame, path: str, buckets: Sequence[str]) -> DataFrame:
    """Write rows placed by the hash of `buckets`, one bucket per shuffle partition, and read them as placed.

    Joins and groups on these columns then need no shuffle of this side. Rows that arrive placed that
    way (`repartition` on the same columns) are written as one file per bucket, and as one is open at a
    time, without being sorted by bucket first. A task that meets more buckets sorts its rows then.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"ledgersieve_{uuid.uuid4().hex}"
    writers = spark.conf.get(_WRITERS_CONF)
    spark.conf.set(_WRITERS_CONF, "2")
    try:
        df.write.format("parquet").bucketBy(parts, *buckets).option("path", path).saveAsTable(name)
    finally:
        spark.conf.set(_WRITERS_CONF, writers)
    return spark.table(name)


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def replace(
        self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = (), buckets: Sequence[str] = ()
    ) -> DataFrame:
        """Create or replace a table from a query, and read on from the stored rows."""
        version = draft(self.path(layer, name))
        if buckets:
            stored = write_buckets(df, version, buckets)
        else:
            df.write.partitionBy(*partition_by).parquet(version)
            stored = self._read(version, df.schema, partition_by)
        switch(self.spark, version)
        return stored

    def _read(self, version: str, schema: StructType, partition_by: Sequence[str]) -> DataFrame:
        # The schema is given, so that a table without rows can be read, and one that is partitioned keeps its types.
        return self.spark.read.schema(schema).option("basePath", version).parquet(version)

    def exists(self, layer: str, name: str) -> bool:
        return is_versioned(self.spark, self.path(layer, name))

    def table(self, layer: str, name: str, schema: StructType | None = None) -> DataFrame:
        """The current version. A partitioned table that may be empty needs its schema."""
        version = current(self.spark, self.path(layer, name))
        return self._read(version, schema, ()) if schema else self.spark.read.parquet(version)


def view(name: str, df: DataFrame) -> DataFrame:
    """Name a query for SQL in this session. It is evaluated anew on every read."""
    df.createOrReplaceTempView(name)
    return df


def stored_view(spark: SparkSession, name: str, select: str) -> DataFrame:
    """Name a statement over stored tables in the catalogue, for every session that uses the catalogue."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")
    return spark.table(name)


def source(spark: SparkSession, folder: str) -> str:
    """A table's current version as a source in SQL. A view has to be stated again after a new version."""
    return f"parquet.`{current(spark, folder)}`"
