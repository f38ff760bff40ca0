"""Entities by pattern, and edges between those of one document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What the entity types look like; word borders are those of Unicode letters.
PATTERNS = {
    "person": r"(?U)\b[A-Z][a-z]+ [A-Z][a-z]+\b",
    "organization": r"(?U)\b(?:Inc\.|LLC|Corp\.|Company|University|Institute)\b",
    "location": r"(?U)\b(?:New York|London|Paris|Tokyo|[A-Z][a-z]+ City)\b",
    "email": r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "url": r"https?://[^\s]+",
    "date": r"(?U)\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b",
}


def mentions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, entity_type, entity, n): how often each entity is named in a document."""
    found = F.concat(*[_typed(text, kind, p) for kind, p in PATTERNS.items()])
    return docs.select(doc_id, F.explode(found).alias("e")).groupBy(doc_id, "e.entity_type", "e.entity").agg(F.count("*").alias("n"))


def _typed(text: str, kind: str, pattern: str):
    return F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(pattern), 0), lambda m: F.struct(F.lit(kind).alias("entity_type"), m.alias("entity")))


def cooccurrences(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Edges between distinct entities of different types that a document names, once each, and in how many documents.

    found: the rows of mentions(). Pairs are made from the sorted array of a document's distinct entities.
    """
    each = found.groupBy(doc_id).agg(F.array_sort(F.collect_set(F.struct("entity_type", "entity"))).alias("e"))
    pairs = each.select(doc_id, F.posexplode("e").alias("i", "a"), "e").select(doc_id, "a", F.explode(F.filter(F.slice("e", F.col("i") + 2, F.size("e")), lambda x: x["entity_type"] != F.col("a")["entity_type"])).alias("b"))
    return pairs.groupBy(F.col("a.entity_type").alias("type_a"), F.col("a.entity").alias("entity_a"), F.col("b.entity_type").alias("type_b"), F.col("b.entity").alias("entity_b")).agg(F.count("*").alias("n_docs"))


def capitalised(docs: DataFrame, stop: tuple[str, ...], doc_id: str = "doc_id", text: str = "text", around: int = 20) -> DataFrame:
    """(doc_id, entity, context): runs of capitalised words of more than three letters, and the text around the first of each."""
    runs = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"(?U)\b[A-Z][a-z]+(?: [A-Z][a-z]+)*\b"), 0))
    kept = F.filter(runs, lambda m: (F.length(m) > 3) & ~m.isin(*stop))
    out = docs.select(doc_id, text, F.explode(kept).alias("entity"))
    at = F.expr(f"locate(entity, {text})")
    first = F.greatest(at - around, F.lit(1))
    return out.select(doc_id, "entity", F.substring(F.col(text), first, at + F.length("entity") + around - first).alias("context"))
