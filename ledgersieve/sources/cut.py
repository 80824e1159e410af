"""Cut points: a frame used more than once is written to the shared folder and read back.

A written table survives lost executors and keeps column pruning, which an RDD
checkpoint does not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; without it nothing can be stored safely, so there is no other."""
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/ledgersieve/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and continue from the stored rows."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
