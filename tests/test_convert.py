from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgersieve.functions.convert import (
    code, iso_date, line_key, money, number, padded, percent, whole_match, whole_number,
)


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v")).alias("r")).first()["r"]


def test_iso_date_takes_only_real_days_in_one_format(spark):
    assert one(spark, "2024-02-29", iso_date) == date(2024, 2, 29)
    for bad in ("2024-02-30", "01.02.2024", "2024-2-3", "", "x2024-01-01y", None):
        assert one(spark, bad, iso_date) is None


def test_numbers_become_null_instead_of_failing(spark):
    assert one(spark, "1234.565", money) == Decimal("1234.57")
    assert one(spark, "99999999999999999", money) is None
    assert one(spark, "2.5", whole_number) == 3
    assert one(spark, "-2.5", whole_number) == -3
    assert one(spark, "x", whole_number) is None
    assert one(spark, "1e3", number) == 1000.0
    assert one(spark, "ten", number) is None


def test_code_trims_and_uppercases(spark):
    assert one(spark, " eur ", code) == "EUR"
    assert one(spark, "  ", code) == ""
    assert one(spark, None, code) is None


def test_whole_match_is_anchored(spark):
    match = lambda c: whole_match(c, "[0-9]{4}-[0-9]{2}-[0-9]{2}")
    assert one(spark, "2024-01-01", match) is True
    assert one(spark, "x2024-01-01y", match) is False
    assert one(spark, None, match) is None


def test_line_key_needs_both_parts(spark):
    df = spark.createDataFrame([("A", 10), ("A", None), (None, 10)], "p string, n int")
    keys = [r[0] for r in df.select(line_key(F.col("p"), F.col("n").cast("decimal(38,0)"))).collect()]
    assert keys == ["A|10", None, None]


def test_padded_keeps_long_numbers(spark):
    assert one(spark, 7, lambda c: padded(c, 4), "bigint") == "0007"
    assert one(spark, 123456, lambda c: padded(c, 4), "bigint") == "123456"


def test_percent_rounds_half_up_and_survives_an_empty_whole(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (1, 2000), (0, 5), (0, 0), (201, 40000)], "a bigint, b bigint")
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [33.33, 66.67, 12.5, 0.05, 0.0, None, 0.5]
    assert [r[0] for r in df.select(percent(F.col("a"), F.col("b"), 1)).collect()][2] == 12.5


def test_number_takes_decimal_text_only(spark):
    texts = ["12d", "12f", "0x1p3", "NaN", "Infinity", "", " ", None, "1e3", " -2.5 ", ".5", "7."]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(number(F.col("t")))
    assert [r[0] for r in df.collect()] == [None] * 8 + [1000.0, -2.5, 0.5, 7.0]


def test_whole_match_refuses_a_trailing_line_break(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-01\n",), ("x2024-01-01",)], "t string")
    found = df.select(whole_match(F.col("t"), "[0-9]{4}-[0-9]{2}-[0-9]{2}")).collect()
    assert [r[0] for r in found] == [True, False, False]


def test_dates_read_by_cast_or_by_format_are_the_same(spark):
    texts = [f"{y:04d}-{m:02d}-{d:02d}" for y in (0, 1582, 1900, 2023, 2024, 9999) for m in (0, 2, 12, 13) for d in (0, 28, 29, 30, 31, 32)]
    texts += ["", " 2024-01-01", "2024-01-01 ", "2024-1-1", "+2024-01-01", "12024-01-01", "2024-01-01T", "2024-01-01\n", "today", "2024-01", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    read = df.select("t", iso_date(F.col("t")).alias("found"), F.try_to_date("t", "yyyy-MM-dd").alias("expected"))
    assert read.where("NOT (found <=> expected)").count() == 0
    assert "try_cast" in read._jdf.queryExecution().analyzed().toString()
