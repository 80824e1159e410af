"""Find secrets with a ledger of scanned contents.

Every version of every text is addressed by the SHA-256 of its bytes. A ledger in shared storage
holds which content was scanned under which version of which rule, and what was found. A run scans
each content once, for the rule versions the ledger has not seen, appends to the ledger, and joins
findings back to all rows that hold the content.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.sources.cut import cut

_LEDGER = "blob binary, pairs array<struct<rule: string, spans: array<struct<start: bigint, end: bigint>>>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_PAIRS = pa.list_(pa.struct([("rule", pa.string()), ("spans", pa.list_(_SPAN))]))


@dataclass(frozen=True)
class Rule:
    """A pattern, the group and least length a match needs, and words of which a text must hold one."""

    name: str
    version: int
    pattern: str
    group: int
    least: int
    needs: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


BASE = ("assign", "access", "hex")
RULES = (
    # The base kinds as agreed with the users of the findings.
    Rule("assign", 1, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12,
         ("passw", "secret", "token", "api")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),  # a shorter run fails anyway, and runs do not overlap
    # Added kinds.
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1, ("private key",)),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1, ("eyj",)),
)


def find_spans(text: str, rules: tuple[Rule, ...]) -> list[dict]:
    """For each rule its matches, leftmost and without overlap, as code point ranges; short ones are dropped."""
    lowered = text.lower()
    out = []
    for rule in rules:
        spans = []
        if not rule.needs or any(word in lowered for word in rule.needs):
            for m in re.finditer(rule.pattern, text, re.ASCII):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    spans.append({"start": m.start(), "end": m.end()})
        out.append({"rule": rule.key, "spans": spans})
    return out


def read_ledger(spark, ledger: str) -> DataFrame:
    """The ledger's rows; none where it was never written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    exists = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(_LEDGER).parquet(ledger) if exists else spark.createDataFrame([], _LEDGER)


def scan(
    docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: id, blob (hex), findings (array of kind, start, end by start, then rule order).

    A NULL text has the content of an empty one. Rows with the same text share one scan; rows that
    share an id are separate versions. Other columns are not read. An empty table gives an empty
    table. `ledger` is a folder that all executors reach; it may be new.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.withColumn("blob", F.unhex(F.sha2("text", 256)))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    by_key = {r.key: r for r in rules}
    seen = read_ledger(spark, ledger).groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("pairs.rule"))).alias("done"))

    def scan_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                find_spans(text, tuple(by_key[k] for k in keys))
                for text, keys in zip(batch["text"].to_pylist(), batch["todo"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch["blob"], pa.array(found, _PAIRS)], names=["blob", "pairs"])

    # Equal texts meet in a map-side aggregate first, so a hot content is one row per task.
    contents = own.groupBy("blob").agg(F.first("text").alias("text")).join(seen, "blob", "left")
    unseen = contents.withColumn("todo", F.coalesce(F.array_except(wanted, "done"), wanted)).where(F.size("todo") > 0)
    unseen.select("blob", "text", "todo").mapInArrow(scan_blobs, _LEDGER).write.mode("append").parquet(ledger)

    order = {r.key: i for i, r in enumerate(rules)}
    pairs = read_ledger(spark, ledger).select("blob", F.explode("pairs").alias("p")).where(F.col("p.rule").isin(*by_key))
    spans = pairs.select("blob", "p.rule", F.explode("p.spans").alias("s"))
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in order.items() for x in kv]), F.col("rule"))
    # Stored, so that Spark can split the rows of a hot content in the join.
    found = cut(spans.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct(
        F.col("s.start").alias("start"), rank.alias("rank"), F.col("s.end").alias("end"),
        F.split("rule", "@")[0].alias("kind")))).alias("found")), "findings")
    joined = own.select("id", "blob").join(found, "blob", "left")
    none = F.expr("cast(array() as array<struct<start: bigint, rank: int, end: bigint, kind: string>>)")
    return joined.select(
        F.col("id").alias(id_col), F.lower(F.hex("blob")).alias("blob"),
        F.transform(F.coalesce("found", none), lambda x: F.struct(x["kind"], x["start"], x["end"])).alias("findings"))
