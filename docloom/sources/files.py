"""Rendered documents, instruction lines and debug rows as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QA_LINE = "instruction string, input string, output string, metadata map<string,string>"


def _qa_lines(spark: SparkSession, path: str) -> DataFrame:
    parsed = F.from_json("value", f"{QA_LINE}, broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    return spark.read.text(path).where(F.trim("value") != "").select(parsed.alias("r")).select("r.*")


def read_qa_lines(spark: SparkSession, path: str) -> DataFrame:
    """One question and answer a JSON line. Lines that don't parse are left to broken_qa_lines(); blank ones are no lines."""
    return _qa_lines(spark, path).where("broken is null").drop("broken")


def broken_qa_lines(spark: SparkSession, path: str) -> DataFrame:
    """(broken): the lines that read_qa_lines() can't read, as they are."""
    return _qa_lines(spark, path).where("broken is not null").select("broken")


def write_lines(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines; null fields are left out. A folder that is there is replaced."""
    rows.write.mode("overwrite").json(path)


def write_rendered(rendered: DataFrame, path: str, doc: str = "doc_id", formats: tuple[str, ...] = ("markdown", "html", "json")) -> None:
    """rendered (doc, one column a format, others) to one Parquet folder a format, and the other columns to `meta`.

    Large corpora have too many documents for a file each: a folder has (doc, text) rows, clustered by document range so
    that a reader of a few documents skips the rest.
    """
    ordered = rendered.repartitionByRange(doc).sortWithinPartitions(doc)
    for name in formats:
        if name in rendered.columns:
            ordered.select(doc, name).withColumnRenamed(name, "text").write.mode("overwrite").parquet(f"{path}/{name}")
    ordered.select([c for c in rendered.columns if c not in formats]).write.mode("overwrite").parquet(f"{path}/meta")
