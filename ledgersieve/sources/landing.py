"""Text landing files: written by the generator, loaded into bronze without judging them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgersieve.operators.skew import HotKey, find_hot_keys
from ledgersieve.operators.steps import at_once
from ledgersieve.schemas import BRONZE_TABLES
from ledgersieve.sources import tables

# Quotes inside a quoted field are doubled.
_CSV = {"header": True, "quote": '"', "escape": '"'}
# No file holds this text, so an unquoted empty field is NULL and a quoted one stays ''.
_NO_NULL_TEXT = "\u0001"


def write_landing(sources: Mapping[str, DataFrame], folder: str, compress: bool = True) -> None:
    """One CSV per table, with a header. Large tables become several part files."""
    def write(stem: str, df: DataFrame) -> None:
        writer = df.write.mode("overwrite").options(**_CSV)
        # Files are written once and read a few times: the fast level of gzip costs some bytes and saves most of its time.
        writer.option("compression", "gzip" if compress else "none").option("zlib.compress.level", "BEST_SPEED").csv(f"{folder}/{stem}.csv")

    if sources:
        at_once(next(iter(sources.values())).sparkSession, [partial(write, stem, df) for stem, df in sources.items()])


def read_landing(spark: SparkSession, folder: str, stem: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """All files of one table, plain or gzip, as text. Columns go by position, the header is skipped.

    A row with a wrong number of fields stops the load. `multiline` allows line breaks in
    quoted fields, at the price of reading each file in one task.
    """
    reader = spark.read.schema(schema).options(**_CSV).option("mode", "FAILFAST")
    reader = reader.option("nullValue", _NO_NULL_TEXT).option("multiLine", multiline)
    df = reader.csv(f"{folder}/*{stem}.csv*")
    files = df.inputFiles()
    # A gzip file cannot be split: spread the rows of a few large ones before going on.
    if len(files) < spark.sparkContext.defaultParallelism and any(f.endswith(".gz") for f in files):
        df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Name and size of every landed file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = files.option("pathGlobFilter", "*.csv*").load(folder)
    return files.select("path", F.col("length").alias("bytes"))


_AUDIT = StructType([StructField("table_name", StringType()), StructField("rows_loaded", LongType())])


def load_bronze(spark: SparkSession, landing: str, bronze: str, multiline: bool = False) -> DataFrame:
    """Replace every bronze table by its landing files. Running it again changes nothing.

    Set `multiline` when quoted fields hold line breaks (see read_landing).

    The audit counts come from the write itself, not from another scan. No table is replaced before
    all of them are loaded, so a load that fails leaves the old rows.
    """
    def load(stem: str) -> tuple[str, str, int]:
        table_name, schema = BRONZE_TABLES[stem]
        loaded = Observation(table_name)
        rows = read_landing(spark, landing, stem, schema, multiline).observe(loaded, F.count("*").alias("rows"))
        version = tables.draft(f"{bronze}/{table_name}")
        rows.write.parquet(version)
        return version, table_name, loaded.get["rows"]

    loads = at_once(spark, [partial(load, stem) for stem in BRONZE_TABLES])
    for version, _, _ in loads:
        tables.switch(spark, version)
    return spark.createDataFrame([(name, rows) for _, name, rows in loads], _AUDIT)  # one row per table


def read_bronze(spark: SparkSession, bronze: str, stem: str) -> DataFrame:
    table_name, schema = BRONZE_TABLES[stem]
    return spark.read.schema(schema).parquet(tables.current(spark, f"{bronze}/{table_name}"))


@dataclass(frozen=True)
class LoadedBronze:
    """The bronze tables under a folder that `load_bronze` filled."""

    spark: SparkSession
    root: str

    @property
    def suppliers(self) -> DataFrame:
        return read_bronze(self.spark, self.root, "suppliers")

    @property
    def headers(self) -> DataFrame:
        return read_bronze(self.spark, self.root, "po_headers")

    @property
    def items(self) -> DataFrame:
        return read_bronze(self.spark, self.root, "po_items")

    @property
    def answer_key(self) -> DataFrame:
        return read_bronze(self.spark, self.root, "corruption_log")

    @cached_property
    def hot_item_pos(self) -> list[HotKey]:
        return find_hot_keys(self.items, "po_id")["po_id"]
