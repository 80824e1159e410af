"""Joins that hold when one key owns a large share of the rows.

The few heavy keys are named before the join is planned. With
none, the join is left to Catalyst and AQE as it is. Otherwise only the heavy keys are
salted: their rows on the big side are spread by input split, and the matching rows on
the other side are repeated once per salt. Which keys are named affects only where rows
go, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StructField, StructType

# Rows of one key that a single task handles comfortably; smaller groups are never hot.
ROWS_CONF = "spark.ledgersieve.hotKeyRows"
DEFAULT_ROWS = 1_000_000


@dataclass(frozen=True)
class HotKey:
    value: Any
    fanout: int


def hot_key_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_CONF, str(DEFAULT_ROWS)))


_SLOTS = 1 << 16
_SHARE = 10_000


def find_hot_keys(df: DataFrame, *columns: str) -> dict[str, list[HotKey]]:
    """Values (NULL included) of each column that hold more rows than one task should take.

    That is at least `hot_key_rows` rows and a ten-thousandth of the table. One pass counts the rows
    of all columns by a hash of the value: a task sends at most `_SLOTS` numbers per column, not a row
    per value. Only values in a slot that reaches the limit are then counted themselves, so counts
    are exact and no heavy value is missed; usually there is no such slot and no second pass.
    """
    least = max(2, hot_key_rows(df.sparkSession))

    def slot(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(_SLOTS)).cast("int")

    # Slots of different columns are told apart by their number alone.
    slots = df.select(*[(slot(c) + i * _SLOTS).alias(f"slot_{i}") for i, c in enumerate(columns)])
    loads = slots.unpivot([], slots.columns, "column", "at").groupBy("at").agg(F.count("*").alias("n"))
    loads = loads.select((F.col("at") / _SLOTS).cast("int").alias("place"), (F.col("at") % _SLOTS).alias("slot"), "n")
    # One row per column, with at most one slot per `least` rows of the table.
    full = loads.groupBy("place").agg(F.sum("n").alias("rows"), F.collect_list(F.when(F.col("n") >= least, F.struct("slot", "n"))).alias("full"))
    hot: dict[str, list[HotKey]] = {c: [] for c in columns}
    for place, rows, found in full.collect():
        c, limit = columns[place], max(least, rows // _SHARE)
        candidates = [s for s, n in found if n >= limit]
        if candidates:
            counted = df.where(slot(c).isin(candidates)).groupBy(c).agg(F.count("*").alias("_rows"))
            hot[c] = [HotKey(value, max(2, math.ceil(n / limit))) for value, n in counted.where(F.col("_rows") >= limit).collect()]
    return hot


def hot_key_frame(
    spark: SparkSession, hot: Sequence[HotKey], key_type: DataType, key: str = "_hot_key"
) -> DataFrame:
    """One row per `hot_key_rows` rows of the table at most."""
    schema = StructType([StructField(key, key_type), StructField("_fanout", IntegerType())])
    return spark.createDataFrame([(h.value, h.fanout) for h in hot], schema)


def skew_safe_join(
    big: DataFrame,
    other: DataFrame,
    key: str,
    how: str,
    hot: Sequence[HotKey] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Equi-join on a column both sides share. `other` must not itself be heavy on the key.

    `how` is one of inner, left, left_semi, left_anti. The result keeps one `key` column.
    `where` is a residual condition and is only used with inner.
    """
    if hot is None:
        hot = find_hot_keys(big, key)[key]
    if hot:
        key_type = big.schema[key].dataType
        heavy = F.broadcast(hot_key_frame(big.sparkSession, hot, key_type))
        big = (
            big.join(heavy, F.col(key).eqNullSafe(F.col("_hot_key")), "left")
            .withColumn("_salt", F.coalesce(F.pmod(F.spark_partition_id(), F.col("_fanout")), F.lit(0)))
            .drop("_hot_key", "_fanout")
        )
        last = F.coalesce(F.col("_fanout"), F.lit(1)) - 1
        other = (
            other.join(heavy, F.col(key) == F.col("_hot_key"), "left")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
            .drop("_hot_key", "_fanout")
        )
        joined = big.join(other, [key, "_salt"], how).drop("_salt")
    else:
        joined = big.join(other, key, how)
    return joined if where is None else joined.where(where)


_HASHED_CONF = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
# Of a compressed partition: its rows take several times that in memory, and a hash table cannot spill.
HASHED_BYTES = 16 * 1024 * 1024


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """Joins that run meanwhile sort nothing where no partition of one side holds more than HASHED_BYTES.

    Spark goes by the sizes it finds after the shuffle; larger ones are sorted, and may spill, as ever. So are
    all in a session that lets AQE merge partitions beyond HASHED_BYTES, as it does by default. A session that
    names a threshold of its own keeps it.
    """
    before = spark.conf.get(_HASHED_CONF)
    if before not in ("0", "0b"):
        yield
        return
    spark.conf.set(_HASHED_CONF, str(HASHED_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_HASHED_CONF, before)


_CHUNK = 4096


def unroll(df: DataFrame, start: Column, times: Column, out: str, spread: bool) -> DataFrame:
    """Repeat each row `times` times, with `out` counting start + 1, start + 2, …

    Rows with 0 or NULL `times` vanish. A row is split into chunks first, so no long list
    is ever built. `spread` is for counts that are too many for one task: the chunks are
    then dealt to all tasks, and each task unrolls its own.
    """
    df = df.withColumns({"_start": start.cast("bigint"), "_times": times.cast("bigint")})
    chunks = df.where("_times > 0").withColumn(
        "_chunk", F.explode(F.expr(f"sequence(0L, (_times - 1) div {_CHUNK})"))
    )
    if spread:
        chunks = chunks.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    numbers = f"sequence(_start + _chunk * {_CHUNK} + 1, _start + least(_times, (_chunk + 1) * {_CHUNK}))"
    return chunks.withColumn(out, F.explode(F.expr(numbers))).drop("_start", "_times", "_chunk")
