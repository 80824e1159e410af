"""The paths for heavy keys give the same rows as the plain operators."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgersieve.operators.ranking import number_rows, weighted_positions
from ledgersieve.operators.skew import HotKey, find_hot_keys, hashed_joins, skew_safe_join, unroll


@pytest.fixture
def skewed(spark):
    """A third of the rows under one key, another third without a key."""
    values = ["hot"] * 300 + [None] * 300 + [f"k{i}" for i in range(300)]
    random.Random(1).shuffle(values)
    return spark.createDataFrame(list(enumerate(values)), "n int, k string").repartition(6)


def test_heavy_keys_are_found(skewed, hot_at_ten):
    hot = {h.value: h.fanout for h in find_hot_keys(skewed, "k")["k"]}
    assert hot == {"hot": 30, None: 30}


def test_small_tables_have_no_heavy_keys(skewed):
    assert find_hot_keys(skewed, "k") == {"k": []}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, skewed, rows, hot_at_ten, how):
    other = spark.createDataFrame([("hot", "H"), ("k1", "a"), ("k2", "b"), ("zz", "c")], "k string, v string")
    plain = skewed.join(other, "k", how)
    salted = skew_safe_join(skewed, other, "k", how)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_salting_spreads_the_heavy_key(spark, skewed, hot_at_ten):
    """With broadcasts off, no single task joins all rows of the heavy key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        other = spark.createDataFrame([("hot", "H"), ("k1", "a")], "k string, v string")
        joined = skew_safe_join(skewed, other, "k", "inner").where("k = 'hot'")
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r["count"] for r in per_task) == 300
    assert len(per_task) > 1


@pytest.mark.parametrize("spread", [False, True])
def test_unroll_repeats_rows(spark, spread):
    df = spark.createDataFrame([("a", 0), ("b", 3), ("c", 10_000), ("d", None)], "k string, n bigint")
    out = unroll(df, F.lit(5), F.col("n"), "i", spread)
    assert sorted(out.columns) == ["i", "k", "n"]
    counts = {r["k"]: (r["c"], r["lo"], r["hi"], r["d"]) for r in out.groupBy("k").agg(
        F.count("*").alias("c"), F.min("i").alias("lo"), F.max("i").alias("hi"),
        F.count_distinct("i").alias("d")).collect()}
    assert counts == {"b": (3, 6, 8, 3), "c": (10_000, 6, 10_005, 10_000)}


def test_numbering_of_heavy_keys_equals_the_window(spark, rows, hot_at_ten):
    rng = random.Random(2)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), rng.randint(1, 3), rng.choice([None, "x", "y"])) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, a int, b string")
    hot = find_hot_keys(df, "k")["k"]
    assert {h.value for h in hot} == {1, 2, 3, None}
    some = [h for h in hot if h.value in (1, None)]
    assert rows(number_rows(df, "k", ["a", "b"], some, "n")) == rows(number_rows(df, "k", ["a", "b"], [], "n"))


def test_positions_are_exact_over_ranges(spark):
    values = [(g, v, 1 + v % 3) for g in ("a", "b") for v in range(500)]
    df = spark.createDataFrame(values, "g string, v int, w int")
    got = {(r["g"], r["v"]): r["position"] for r in weighted_positions(df, ["g"], ["v"], "w").collect()}
    for g in ("a", "b"):
        before = 0
        for v in range(500):
            assert got[g, v] == before
            before += 1 + v % 3


def test_join_takes_known_heavy_keys_without_looking(spark, skewed, rows):
    other = spark.createDataFrame([("hot", 1)], "k string, v int")
    given = skew_safe_join(skewed, other, "k", "left", [HotKey("hot", 5), HotKey(None, 3)])
    assert rows(given) == rows(skewed.join(other, "k", "left"))
    assert Counter(r["v"] for r in given.collect()) == {1: 300, None: 600}


def test_heavy_keys_of_several_columns_are_told_apart(spark, hot_at_ten):
    rows = [("a", "b", i) for i in range(50)] + [("b", f"x{i}", i) for i in range(20)]
    found = find_hot_keys(spark.createDataFrame(rows, "k string, l string, m int"), "k", "l", "m")
    assert {c: {h.value for h in hot} for c, hot in found.items()} == {"k": {"a", "b"}, "l": {"b"}, "m": set()}


def test_joins_are_hashed_while_asked_for(spark, rows):
    """Small shuffled sides need no sort; outside, and under a threshold of the session's own, all is as before."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name)

    def joined():
        big = spark.range(1000).selectExpr("id % 100 AS k", "id AS n")
        df = big.join(spark.range(50).selectExpr("id AS k", "id * 2 AS m"), "k", "left")
        return rows(df), df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    try:
        plain, sorted_plan = joined()
        with hashed_joins(spark):
            found, hashed_plan = joined()
        assert found == plain and spark.conf.get(name) == before
        assert "SortMergeJoin" in sorted_plan and "ShuffledHashJoin" in hashed_plan and "SortMergeJoin" not in hashed_plan
        with pytest.raises(ValueError), hashed_joins(spark):
            raise ValueError
        assert spark.conf.get(name) == before
        spark.conf.set(name, "1")
        with hashed_joins(spark):
            assert spark.conf.get(name) == "1"
        assert spark.conf.get(name) == "1"
    finally:
        spark.conf.set(name, before)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
