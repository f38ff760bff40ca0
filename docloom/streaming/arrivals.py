"""Arriving documents as a stream. An extension: batch reading has the same operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def arriving(spark: SparkSession, path: str, schema: str, arrived: str = "arrived", late: str = "1 hour", files_per_batch: int = 100) -> DataFrame:
    """Parquet files as they come, with a watermark; a document that comes again within it is dropped by doc_id."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return rows.withWatermark(arrived, late).dropDuplicatesWithinWatermark(["doc_id"])


def arrivals_by_window(docs: DataFrame, arrived: str = "arrived", size: str = "10 minutes") -> DataFrame:
    """Documents and characters by arrival window and language."""
    return docs.groupBy(F.window(arrived, size).alias("w"), "lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).select(F.col("w.start").alias("window_start"), "lang", "n", "chars")


def append_to(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that has arrived and stop."""
    return docs.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start(path)
