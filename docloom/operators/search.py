"""Search in block trees and graphs, and summaries of their shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import terms


def find(blocks: DataFrame, text: str | None = None, block_type: str | None = None, pattern: str | None = None, page_id: int | None = None, most: int = 100, order: tuple[str, ...] = ("block_ord",)) -> DataFrame:
    """Blocks that meet any of the given criteria, with the reasons, in order, at most `most`."""
    tests: list[tuple[Column, str]] = []
    if text is not None:
        tests.append((F.contains(F.lower("text"), F.lit(text.lower())), f"text contains {text}"))
    if block_type is not None:
        tests.append((F.col("block_type") == block_type, f"type is {block_type}"))
    if pattern is not None:
        tests.append((F.col("text").rlike(pattern), f"text matches {pattern}"))
    if page_id is not None:
        tests.append((F.col("page_id") == page_id, f"on page {page_id}"))
    reasons = F.array_compact(F.array(*[F.when(t, F.lit(r)) for t, r in tests])) if tests else F.array().cast("array<string>")
    return blocks.withColumn("reasons", F.concat_ws("; ", reasons)).where("reasons <> ''").orderBy(*order).limit(most)


def by_fields(documents: DataFrame, fields: dict) -> DataFrame:
    """Documents whose fields equal the given values; a null value asks for null."""
    for name, value in fields.items():
        documents = documents.where(F.col(name).eqNullSafe(F.lit(value)))
    return documents


def shape(nodes: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, n_blocks, max_depth, n_tables, n_pictures, types) of trees given as (doc, path array, block_type)."""
    counts = nodes.groupBy(*doc, "block_type").agg(F.count("*").alias("n"), F.max(F.size("path")).alias("deep"))
    of = lambda *t: F.sum(F.when(F.col("block_type").isin(*t), F.col("n")).otherwise(0))
    return counts.groupBy(*doc).agg(F.sum("n").alias("n_blocks"), F.max("deep").alias("max_depth"), of("Table").alias("n_tables"), of("Picture", "Figure").alias("n_pictures"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("block_type", "n")))).alias("types"))


def sample_graph(vertices: DataFrame, edges: DataFrame, most: int = 100) -> tuple[DataFrame, DataFrame]:
    """The first `most` vertices by key, and as many edges among them."""
    v = vertices.orderBy("key").limit(most)
    keys = v.select("key")
    e = edges.join(keys.withColumnRenamed("key", "src"), "src", "left_semi").join(keys.withColumnRenamed("key", "dst"), "dst", "left_semi")
    return v, e.orderBy("src", "dst").limit(most).select(edges.columns)


def word_overlaps(docs: DataFrame, items: DataFrame, least: float, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, shared, overlap): documents that have at least the share `least` of an item's distinct words.

    An item's words stand by how many documents have them. A document that lacks no more than the rest has one of the first
    n - ceil(least n) + 1, so those alone are join keys and common words bring nothing together; what the pairs share
    is then counted. Items without words match nothing.
    """
    own = items.select(item_id, terms(F.col(text)).alias("_w")).withColumn("_n", F.size("_w"))
    every = docs.select(doc_id, terms(F.col(text)).alias("_t"))
    words = every.select(doc_id, F.explode("_t").alias("w"))
    asked = own.select(item_id, "_n", F.explode("_w").alias("w"))
    often = words.join(asked.select("w").distinct(), "w", "left_semi").groupBy("w").agg(F.count("*").alias("_df"))
    place = F.row_number().over(Window.partitionBy(item_id).orderBy(F.coalesce("_df", F.lit(0)), "w"))
    keys = asked.join(often, "w", "left").withColumn("_k", place).where(F.col("_k") <= F.col("_n") - F.ceil(least * F.col("_n") - 1e-9) + 1)
    met = words.join(keys.select("w", item_id), "w").select(doc_id, item_id).distinct()
    pairs = met.join(every, doc_id).join(own, item_id).select(doc_id, item_id, "_n", F.size(F.array_intersect("_t", "_w")).cast("bigint").alias("shared"))
    return pairs.select(doc_id, item_id, "shared", (F.col("shared") / F.col("_n")).alias("overlap")).where(F.col("overlap") >= least)
