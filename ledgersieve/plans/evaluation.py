"""Scoring the rules against the answer key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersieve.functions.convert import percent

# Which rule is meant to catch which issue. Issues no rule covers are absent.
ISSUE_RULES = (
    ("missing_currency", "missing_currency"),
    ("invalid_currency", "invalid_currency"),
    ("bad_date_format", "bad_date_format"),
    ("orphan_supplier", "orphan_supplier"),
    ("exact_duplicate_header", "duplicate_po_id"),
    ("delivery_before_order", "delivery_before_order"),
    ("missing_item_field", "missing_description"),
    ("missing_item_field", "missing_quantity"),
)
# Issues that only a comparison of similar names or orders could find, and the labels of the methods below.
FUZZY_ISSUES = ("near_duplicate_po", "inconsistent_supplier_name")

_SLOTS = 1 << 20


def issue_rule_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ISSUE_RULES), "issue_type string, rule_name string")


def issue_recall(answer_key: DataFrame, quarantined: DataFrame, rule_map: DataFrame) -> DataFrame:
    """Per issue type: how many injected problems a mapped rule caught.

    Both sides are made distinct before they meet, so the join matches one row with one. Quarantined
    rows that no entry of the answer key can match are left out before that: the filter holds the
    entries' hash slots, _SLOTS numbers at most, whatever the size of the key.
    """
    injected = answer_key.select("issue_type", "record_id", "ml_target").distinct()
    slot = F.pmod(F.xxhash64("issue_type", "record_id"), F.lit(_SLOTS)).cast("int")
    wanted = F.broadcast(answer_key.select(slot.alias("_slot")).distinct())
    caught = (
        quarantined.select("record_id", "rule_name")
        .join(F.broadcast(rule_map), "rule_name")  # the fixed rule map
        .withColumn("_slot", slot).join(wanted, "_slot", "left_semi")
        .select("issue_type", "record_id").distinct()
        .withColumn("hit", F.lit(1))
    )
    scored = injected.join(caught, ["issue_type", "record_id"], "left").groupBy("issue_type").agg(
        F.max("ml_target").alias("ml_target"),
        F.count("*").alias("injected"),
        F.count("hit").alias("caught_by_rules"),
    )
    method = (
        F.when(F.col("ml_target") == "True", "ML anomaly detection")
        .when(F.col("issue_type").isin(*FUZZY_ISSUES), "Fuzzy matching (not built yet)")
        .otherwise("Rule-based validation")
    )
    return scored.select(
        "issue_type", method.alias("intended_method"), "injected", "caught_by_rules",
        percent(F.col("caught_by_rules"), F.col("injected"), 1).alias("recall_pct"),
    ).orderBy("issue_type")


def rule_precision(answer_key: DataFrame, quarantined: DataFrame, rule_map: DataFrame) -> DataFrame:
    """Per mapped rule: quarantined rows, those the answer key explains, and the rest.

    Counted per record on both sides first; a quarantine row pairs with every key row of
    its record and issue, which is the product of the two counts.
    """
    flagged = quarantined.groupBy("record_id", "rule_name").agg(F.count("*").alias("rows"))
    logged = answer_key.groupBy("record_id", "issue_type").agg(F.count("*").alias("entries"))
    paired = (
        flagged.join(F.broadcast(rule_map), "rule_name")  # the fixed rule map
        .join(logged, ["record_id", "issue_type"], "left")
        .withColumn("entries", F.coalesce("entries", F.lit(0)))
    )
    scored = paired.groupBy("rule_name").agg(
        F.sum(F.col("rows") * F.greatest("entries", F.lit(1))).alias("quarantined"),
        F.sum(F.col("rows") * F.col("entries")).alias("matches_injected_issue"),
    )
    return scored.withColumn(
        "not_in_log", F.col("quarantined") - F.col("matches_injected_issue")
    ).orderBy("rule_name")
