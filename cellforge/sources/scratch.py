"""Tables saved between steps, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; on one machine (tests) under a folder of our own where it is unset."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = getattr(scratch_path, "own", None)
        if root is None:
            root = scratch_path.own = tempfile.mkdtemp(prefix="cellforge-")
    return f"{root.rstrip('/')}/cellforge/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written under spark.checkpoint.dir and read back: lineage ends there, and what is read is what was counted."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
