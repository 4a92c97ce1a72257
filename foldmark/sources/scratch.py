"""Tables that cut a plan in two, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that may be broadcast; a table is counted before, and joined by shuffle beyond.
BROADCAST_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a plain local session may go without and gets a folder of its own."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"file://{tempfile.mkdtemp(prefix='foldmark-')}"
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once, written as Parquet in the shared folder and read again: what builds on it twice reads it,
    whatever executors are lost. A lazy result may read it, so it stays until that folder is cleared."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/foldmark/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """``df`` (cut before) as a broadcast side if it has few rows, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
