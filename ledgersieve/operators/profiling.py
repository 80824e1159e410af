"""Profiles of any set of tables. Each table is read once, whatever the number of columns."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersieve.functions.convert import number, percent
from ledgersieve.operators.ranking import weighted_positions


# --- column profiles ---------------------------------------------------------------------

# HyperLogLog registers, as a power of two: about 0.8 % standard error.
SKETCH_BITS = 14
PROFILE = """table_name string, column_name string, total_rows bigint, null_count bigint, min_value string,
    max_value string, sketch binary"""


def _measures(df: DataFrame, table_name: str) -> DataFrame:
    """Rows, nulls, text min and max, and a sketch of every column from one aggregate: a task sends one row."""
    def measures(c: str) -> Column:
        return F.struct(
            F.lit(table_name).alias("table_name"), F.lit(c).alias("column_name"), F.count("*").alias("total_rows"),
            (F.count("*") - F.count(c)).alias("null_count"), F.min(c).alias("min_value"), F.max(c).alias("max_value"),
            F.hll_sketch_agg(c, SKETCH_BITS).alias("sketch")).alias(c)

    text = df.select(*[F.col(c).cast("string") for c in df.columns])
    one_row = text.agg(*[measures(c) for c in df.columns])
    return one_row.select(F.inline(F.array(*[F.col(c) for c in df.columns])))


def _named_profile(measured: DataFrame) -> DataFrame:
    return measured.select(
        "table_name", "column_name", "total_rows", "null_count",
        percent(F.col("null_count"), F.col("total_rows"), 2).alias("null_pct"), "distinct_count", "min_value", "max_value")


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row, null and distinct counts with text min and max for every column of every table, all exact.

    Rows and nulls are one narrow aggregate per table. Distinct values are found column by column in
    their own type: a scan reads that column alone, each value leaves a task once, whatever its rows,
    and only distinct values become text. Tables that are costly to make should be stored first.
    """
    counted, distinct = [], []
    for table_name, df in tables.items():
        nulls = df.agg(F.count("*").alias("total_rows"), *[(F.count("*") - F.count(c)).alias(c) for c in df.columns])
        counted.append(nulls.unpivot(["total_rows"], list(df.columns), "column_name", "null_count").select(
            F.lit(table_name).alias("table_name"), "column_name", "total_rows", "null_count"))
        for c in df.columns:
            values = df.select(F.col(c).alias("v")).where(F.col("v").isNotNull()).distinct().select(F.col("v").cast("string").alias("v"))
            distinct.append(values.agg(F.count("*").alias("distinct_count"), F.min("v").alias("min_value"), F.max("v").alias("max_value")).select(
                F.lit(table_name).alias("table_name"), F.lit(c).alias("column_name"), "distinct_count", "min_value", "max_value"))
    # Both sides hold one row per column.
    found = F.broadcast(reduce(DataFrame.unionByName, distinct))
    return _named_profile(reduce(DataFrame.unionByName, counted).join(found, ["table_name", "column_name"]))


def profile_sketches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column, as PROFILE: exact measures and a sketch of the distinct values, from one narrow aggregate.

    To be stored: profiles of new rows are merged with it later, without reading the old rows again.
    """
    return reduce(DataFrame.unionByName, [_measures(df, name) for name, df in tables.items()])


def merge_profiles(*stored: DataFrame) -> DataFrame:
    """Profiles of parts of the same tables as one. The parts may overlap only as far as rows may repeat."""
    return reduce(DataFrame.unionByName, stored).groupBy("table_name", "column_name").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("null_count").alias("null_count"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.hll_union_agg("sketch").alias("sketch"))


def approximate_profile(sketched: DataFrame) -> DataFrame:
    """As column_profile, with distinct counts estimated from the sketches (about 0.8 % standard error)."""
    estimate = F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0).cast("bigint"))
    return _named_profile(sketched.withColumn("distinct_count", estimate))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(column))


# --- exact percentiles -------------------------------------------------------------------

_SKETCH_K = 800  # rank error of a KLL sketch: about 0.4 %
_MARGIN = 0.01
FEW_VALUES = 100_000


@dataclass
class _Search:
    """Where the value of one rank of one column lies: between `low` and `high`, with `below` rows under `low`."""

    column: str
    rank: int
    low: float
    high: float
    below: int = 0
    inside: int = 0

    def holds_rank(self) -> bool:
        return self.below <= self.rank < self.below + self.inside


def _bounds(numbers: DataFrame, columns: Sequence[str], quantiles: Mapping[str, Sequence[float]]) -> dict[str, list]:
    """Per column: rows, min, max, and values near the quantiles, from mergeable sketches. Not a value is shuffled.

    Sketches meet by task group first and then all together, so no task merges more than the square
    root of them.
    """
    groups = max(1, math.isqrt(int(numbers.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    parts = numbers.groupBy(F.pmod(F.spark_partition_id(), F.lit(groups)).alias("_part")).agg(*[
        x for c in columns for x in (
            F.count(c).alias(f"n_{c}"), F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"),
            F.kll_sketch_agg_double(c, F.lit(_SKETCH_K)).alias(f"kll_{c}"))])
    merged = parts.agg(*[
        x for c in columns for x in (
            F.sum(f"n_{c}").alias(f"n_{c}"), F.min(f"low_{c}").alias(f"low_{c}"), F.max(f"high_{c}").alias(f"high_{c}"),
            F.kll_merge_agg_double(f"kll_{c}").alias(f"kll_{c}"))])
    asked = {c: F.when(F.col(f"n_{c}") > 0, F.kll_sketch_get_quantile_double(
        f"kll_{c}", F.array(*[F.lit(min(1.0, max(0.0, q))) for q in quantiles[c]]))) for c in columns}
    row = merged.select(*[
        F.struct(F.coalesce(f"n_{c}", F.lit(0)).alias("n"), F.col(f"low_{c}").alias("low"), F.col(f"high_{c}").alias("high"), asked[c].alias("near")).alias(c)
        for c in columns]).first()
    return {c: [row[c]["n"], row[c]["low"], row[c]["high"], row[c]["near"]] for c in columns}


def _count(numbers: DataFrame, searches: Sequence[_Search]) -> None:
    """Rows under and inside each search range: one aggregate, one row per task."""
    row = numbers.agg(*[
        x for i, s in enumerate(searches) for x in (
            F.count_if(F.col(s.column) < F.lit(s.low)).alias(f"below_{i}"),
            F.count_if(F.col(s.column).between(F.lit(s.low), F.lit(s.high))).alias(f"inside_{i}"))]).first()
    for i, s in enumerate(searches):
        s.below, s.inside = row[f"below_{i}"], row[f"inside_{i}"]


def _narrowed(numbers: DataFrame, searches: Sequence[_Search]) -> None:
    """Cut ranges that still hold many rows by a sketch of what is inside them."""
    inside = numbers.select(*[
        F.when(F.col(s.column).between(F.lit(s.low), F.lit(s.high)), F.col(s.column)).alias(str(i)) for i, s in enumerate(searches)])
    names = [str(i) for i in range(len(searches))]
    share = [(s.rank - s.below) / s.inside for s in searches]
    found = _bounds(inside, names, {str(i): (q - _MARGIN, q + _MARGIN) for i, q in enumerate(share)})
    tried = [_Search(s.column, s.rank, *found[str(i)][3]) for i, s in enumerate(searches)]
    _count(numbers, tried)
    for s, t in zip(searches, tried):
        if t.holds_rank():
            s.low, s.high, s.below, s.inside = t.low, t.high, t.below, t.inside


def exact_ranks(numbers: DataFrame, searches: list[_Search], few: int = FEW_VALUES) -> list[float]:
    """The value at each rank (from 0) of its column, by selection. Every search knows how many rows it holds.

    Ranges are narrowed by sketches until they hold few rows or a single value, or until a sketch no
    longer helps; their rows are counted exactly at each step, so an unlucky sketch costs a pass and
    never the result. Only values inside the last ranges are shuffled.
    """
    while wide := [s for s in searches if s.inside > few and s.low < s.high]:
        before = [s.inside for s in wide]
        _narrowed(numbers, wide)
        if not any(s.inside < n for s, n in zip(wide, before)):
            break
    last = [F.when(F.col(s.column).between(F.lit(s.low), F.lit(s.high)), F.struct(F.lit(i).alias("i"), F.col(s.column).alias("value")))
            for i, s in enumerate(searches)]
    inside = numbers.select(F.inline(F.array_compact(F.array(*last))))
    counted = inside.groupBy("i", "value").agg(F.count("*").alias("n"))
    below = F.element_at(F.array(*[F.lit(s.below).cast("bigint") for s in searches]), F.col("i") + 1)
    rank = F.element_at(F.array(*[F.lit(s.rank).cast("bigint") for s in searches]), F.col("i") + 1)
    placed = weighted_positions(counted, ["i"], ["value"], "n") if any(s.inside > few for s in searches) else counted.withColumn(
        "position", F.coalesce(F.sum("n").over(W.partitionBy("i").orderBy("value").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    at = placed.where((below + F.col("position") <= rank) & (rank < below + F.col("position") + F.col("n")))
    found = {r["i"]: r["value"] for r in at.select("i", "value").collect()}  # one row per rank
    return [found[i] for i in range(len(searches))]


def numeric_spread(
    df: DataFrame, columns: Sequence[str], points: Mapping[str, float] | None = None, few: int = FEW_VALUES
) -> DataFrame:
    """Min, exact interpolated percentiles and max per column; text that is no number is ignored.

    A built-in exact percentile gathers every distinct value of a column in one task. Here each
    percentile is selected: sketches say between which values its rank must lie, and only the values
    in between are shuffled and counted. `df` is read a few times; store it first where it is costly.
    """
    points = points or {"p50": 0.50, "p95": 0.95, "p99": 0.99}
    spark = df.sparkSession
    numbers = df.select(*[number(F.col(c).cast("string")).alias(c) for c in columns])
    near = [q for p in points.values() for q in (p - _MARGIN, p + _MARGIN)]
    bounds = _bounds(numbers, columns, {c: near for c in columns})
    searches, wanted = [], []
    for c in columns:
        n, low, high, found = bounds[c]
        for k, (name, p) in enumerate(points.items() if n else ()):
            place = (n - 1) * p
            for rank in sorted({math.floor(place), math.ceil(place)}):
                searches.append(_Search(c, rank, found[2 * k], found[2 * k + 1]))
            wanted.append((c, name, place))
    if any(bounds[s.column][0] > few for s in searches):
        _count(numbers, searches)
    for s in searches:
        if not s.holds_rank():  # a small column, or an unlucky sketch: the whole column is searched
            s.low, s.high, s.below, s.inside = bounds[s.column][1], bounds[s.column][2], 0, bounds[s.column][0]
    values = {(s.column, s.rank): v for s, v in zip(searches, exact_ranks(numbers, searches, few) if searches else [])}
    spread: dict[str, dict[str, float]] = {c: {} for c in columns}
    for c, name, place in wanted:
        lower, upper = values[c, math.floor(place)], values[c, math.ceil(place)]
        spread[c][name] = lower + (upper - lower) * (place - math.floor(place))
    rows = [(c, bounds[c][1], *[spread[c].get(name) for name in points], bounds[c][2]) for c in columns if bounds[c][0]]
    return spark.createDataFrame(rows, ", ".join(["col string", "min_v double", *[f"{name} double" for name in points], "max_v double"]))
