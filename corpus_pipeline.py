"""A documents table made ready for training: rules, line dedup, near-duplicates, decontamination, packing.

Each stage takes what its predecessor kept, calls one operator, and returns the columns of documents;
the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersieve.llm import decontam_lsa, line_dedup, outlier_rules, packing, simhash
from ledgersieve.sources.cut import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test keep."""
    return outlier_rules.kept_documents(docs)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that three or more share; n_chars follows the text."""
    kept = line_dedup.line_dedup(docs, stats=False)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates; a row without an id only where none has one.

    Groups are told apart by their root fingerprint, not by ids, which may be NULL or repeated. Rows
    of a group that share the least id are told apart by their row hash, and one of equal rows stays.
    """
    row = F.xxhash64(*docs.columns)
    free = next(name for name in map("_row{}".format, range(len(docs.columns) + 1)) if name not in docs.columns)
    own = docs.select(F.col("doc_id").alias("_id"), row.alias("_row"), "text")
    found = simhash.near_duplicates(own, id_col="_id", root_col="_root")
    least = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_row"))
    first = found.groupBy("_root").agg(least.alias("_first"))
    first = cut(first.select("_first._id", "_first._row"), "kept")
    # The join shuffles a row hash, and equal rows are told apart by their place in it.
    kept = docs.withColumn(free, row).join(first, docs["doc_id"].eqNullSafe(first["_id"]) & (row == first["_row"]), "left_semi")
    return kept.dropDuplicates(["doc_id", free]).drop(free)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam_lsa.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training windows, with their token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("packing", pack_windows),
]

# Robust estimates, fingerprints, latent vectors and tokenisers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
