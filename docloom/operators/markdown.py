"""Markdown documents to sections, and how well formats of one document agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hierarchy import section_contents


def heading_level(line: Column, line_no: Column) -> Column:
    """Level of a heading line, else null: # signs, or a line all in bold, which near the top is a title."""
    hashes = F.regexp_extract(line, r"^(#{1,6})\s+\S.+$", 1)
    bold = F.regexp_extract(line, r"^\*\*([^*]{2,})\*\*\s*$", 1)
    title = (line_no < 20) & ((F.length(bold) > 30) | F.lower(bold).rlike("abstract|introduction|conclusion"))
    return F.when(hashes != "", F.length(hashes)).when(bold != "", F.when(title, 1).otherwise(2)).cast("int")


def lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, block_ord, level, text): every line that isn't blank; headings without their marks. Lines in code fences are no headings."""
    each = docs.select(doc_id, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    w = Window.partitionBy(doc_id).orderBy("line_no")
    fenced = F.sum(F.col("line").startswith("```").cast("int")).over(w) % 2 == 1
    each = each.withColumn("level", F.when(~fenced, heading_level(F.col("line"), F.col("line_no"))))
    clean = F.when(F.col("level").isNotNull(), F.regexp_replace(F.col("line"), r"^#{1,6}\s+|^\*\*|\*\*\s*$", "")).otherwise(F.col("line"))
    return each.where(F.trim("line") != "").select(doc_id, F.col("line_no").cast("long").alias("block_ord"), "level", clean.alias("text"))


def sections(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Sections of Markdown texts, as section_contents() gives them."""
    return section_contents(lines(docs, doc_id, text), [doc_id])


def agreement(sizes: DataFrame, doc: list[str], measures: list[str]) -> DataFrame:
    """(doc, agreement): one row for each format of a document in; 1 less the greatest relative distance from the mean, averaged over measures."""
    w = Window.partitionBy(*doc)
    parts = [F.when(F.avg(m).over(w) == 0, 0.0).otherwise(F.abs(F.col(m) - F.avg(m).over(w)) / F.avg(m).over(w)).alias(m) for m in measures]
    worst = sizes.select(*doc, *parts).groupBy(*doc).agg(*[(1 - F.max(m)).alias(m) for m in measures])
    return worst.select(*doc, (sum((F.col(m) for m in measures), F.lit(0.0)) / len(measures)).alias("agreement"))


def cleaned(text: Column) -> Column:
    """Markdown for comparison: links and images to their words, spans and marks away, spaces single, lower case."""
    t = F.regexp_replace(text, r"!?\[([^\]]*)\]\([^)]*\)", "$1")
    t = F.regexp_replace(t, r"</?span[^>]*>|<br\s*/?>", " ")
    t = F.regexp_replace(t, r"\$\$?([^$]+)\$\$?", "$1")
    t = F.regexp_replace(t, r"[*_`#>|]+", "")
    return F.lower(F.trim(F.regexp_replace(t, r"\s+", " ")))


def unfenced_json(text: Column) -> Column:
    """The JSON of a model's reply: the text itself, else what a fence holds, else its first [..] or {..}; null where none parses."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    piece = F.regexp_extract(text, r"(?s)(\[.*\]|\{.*\})", 1)
    ok = lambda c: F.try_parse_json(c).isNotNull() & (c != "")
    return F.when(ok(text), text).when(ok(fenced), fenced).when(ok(piece), piece)
