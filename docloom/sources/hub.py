"""The interchange JSON of documents, pages and blocks: reading, writing, and the files beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HUB = """document struct<id: string, pages: array<struct<page_num: int, blocks: array<struct<type: string, text: string, level: int, language: string>>>>>,
metadata map<string, string>, validation map<string, string>, raw_corpus struct<full_text: string, pages: array<struct<page_num: int, text: string>>, total_pages: int>"""


def read_hub(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row for each file, or with lines for each line, as Spark writes many documents."""
    return spark.read.schema(HUB).json(path, multiLine=not lines)


def hub_blocks(hub: DataFrame) -> DataFrame:
    """(doc_id, page_num, block_ord, block_type, text, level, language) in reading order over the document."""
    pages = hub.select(F.col("document.id").alias("doc_id"), F.explode("document.pages").alias("p"))
    each = pages.select("doc_id", F.col("p.page_num").alias("page_num"), F.posexplode("p.blocks").alias("k", "b"))
    ordinal = (F.col("page_num").cast("long") * 1_000_000 + F.col("k")).alias("block_ord")
    return each.select("doc_id", "page_num", ordinal, F.col("b.type").alias("block_type"), "b.text", "b.level", "b.language")


def to_hub(blocks: DataFrame) -> DataFrame:
    """Block rows to rows of HUB's document and raw_corpus."""
    b = F.struct("block_ord", F.struct(F.col("block_type").alias("type"), "text", "level", "language").alias("b"))
    pages = blocks.groupBy("doc_id", "page_num").agg(F.array_sort(F.collect_list(b)).alias("x"))
    one = pages.select("doc_id", F.struct("page_num", F.transform("x", lambda r: r["b"]).alias("blocks")).alias("page"), F.struct("page_num", F.array_join(F.transform("x", lambda r: F.coalesce(r["b"]["text"], F.lit(""))), "\n").alias("text")).alias("raw"))
    docs = one.groupBy("doc_id").agg(F.array_sort(F.collect_list("page"), lambda a, z: a["page_num"] - z["page_num"]).alias("pages"), F.array_sort(F.collect_list("raw"), lambda a, z: a["page_num"] - z["page_num"]).alias("raw"))
    return docs.select(F.struct(F.col("doc_id").alias("id"), "pages").alias("document"), F.struct(F.array_join(F.transform("raw", lambda r: r["text"]), "\n\n").alias("full_text"), F.col("raw").alias("pages"), F.size("raw").alias("total_pages")).alias("raw_corpus"))


def not_yet_written(files: DataFrame, done: DataFrame) -> DataFrame:
    """files whose base name has no output among `done` (both: path)."""
    base = F.regexp_extract("path", r"([^/]+?)(\.[^./]+)?$", 1)
    return files.withColumn("_base", base).join(done.select(base.alias("_base")).distinct(), "_base", "left_anti").drop("_base")


def page_range(text: str) -> list[int]:
    """"0,5-10" to its pages, ascending and distinct."""
    pages: set[int] = set()
    for part in filter(None, (p.strip() for p in text.split(","))):
        first, _, last = part.partition("-")
        pages.update(range(int(first), int(last or first) + 1))
    return sorted(pages)
