"""Exact positions in a sorted group, however large the group.

A window over one huge group sorts it in one task. Here the rows are range-partitioned
on (group, order), each range is ranked on its own, and the range totals (one row per
range and group) shift the ranges into place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersieve.operators.skew import HotKey, hot_key_frame, unroll
from ledgersieve.sources.cut import cut


def weighted_positions(
    df: DataFrame, group: Sequence[str], order: Sequence[str], weight: str, out: str = "position"
) -> DataFrame:
    """Add `out`: the sum of `weight` over the rows of the group that sort before this one.

    Rows must be distinct on (group, order) and groups few: the totals that are broadcast
    hold one row per group and range, never more than ranges + groups.
    """
    sort_keys = [F.asc_nulls_last(c) for c in order]
    ranged = (
        df.repartitionByRange(*[F.asc_nulls_last(c) for c in group], *sort_keys)
        .withColumn("_range", F.spark_partition_id())
    )
    # Stored, so that totals and ranks see the same range bounds even after a lost executor.
    ranged = cut(ranged, "ranges")
    earlier_ranges = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy(*group, "_range")
        .agg(F.sum(weight).alias("_total"))
        .withColumn("_shift", F.coalesce(F.sum("_total").over(earlier_ranges), F.lit(0)))
        .select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_range").alias("_g_range"), "_shift")
    )
    same = F.col("_range") == F.col("_g_range")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    earlier_rows = W.partitionBy(*group, "_range").orderBy(*sort_keys).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(shifts), same)
        .withColumn(out, F.col("_shift") + F.coalesce(F.sum(weight).over(earlier_rows), F.lit(0)))
        .drop("_range", "_shift", "_g_range", *[f"_g_{c}" for c in group])
    )


def number_rows(
    df: DataFrame, key: str, order: Sequence[str], hot: Sequence[HotKey], out: str
) -> DataFrame:
    """1, 2, 3, … per key in the given order, which must cover every column but the key.

    Ordinary keys use a plain window. Rows of hot keys are folded into distinct rows with
    a count, ranked across tasks, and unrolled again.
    """
    per_key = W.partitionBy(key).orderBy(*[F.asc_nulls_last(c) for c in order])
    number = F.row_number().over(per_key).cast("bigint")
    if not hot:
        return df.withColumn(out, number)
    keys = hot_key_frame(df.sparkSession, hot, df.schema[key].dataType).select("_hot_key")
    is_hot = F.col(key).eqNullSafe(F.col("_hot_key"))
    light = df.join(F.broadcast(keys), is_hot, "left_anti").withColumn(out, number)
    heavy = df.join(F.broadcast(keys), is_hot, "left_semi")
    folded = heavy.groupBy(key, *order).agg(F.count("*").alias("_n"))
    placed = weighted_positions(folded, [key], order, "_n", "_before")
    unrolled = unroll(placed, F.col("_before"), F.col("_n"), out, spread=True)
    return light.unionByName(unrolled.drop("_before", "_n"))
