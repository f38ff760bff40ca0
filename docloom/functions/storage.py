"""Where intermediate rows are written, and lineage that is cut there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh_folder(spark: SparkSession, tag: str) -> str:
    """A new folder where driver and executors both see it: below spark.checkpoint.dir, or in local mode a temporary one."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        shared = tempfile.mkdtemp(prefix="docloom-")
    return f"{shared.rstrip('/')}/docloom-plans/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """df as Parquet under path, read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
