"""Blocks to text: HTML, Markdown, JSON trees and page statistics, each an ordered aggregate by document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def span_html(text: Column, formats: Column, url: Column, superscript: Column) -> Column:
    """One span: escaped, then bold, italic and mathematics, superscript and link around it."""
    out = escape(text)
    for name, tag in (("bold", "b"), ("italic", "i"), ("math", "math")):
        out = F.when(F.array_contains(formats, name), F.concat(F.lit(f"<{tag}>"), out, F.lit(f"</{tag}>"))).otherwise(out)
    out = F.when(superscript, F.concat(F.lit("<sup>"), out, F.lit("</sup>"))).otherwise(out)
    return F.when(url.isNotNull() & (url != ""), F.concat(F.lit("<a href='"), url, F.lit("'>"), out, F.lit("</a>"))).otherwise(out)


def merge_tags(html: Column, tags: tuple[str, ...] = ("b", "i", "math"), passes: int = 3) -> Column:
    """Neighbouring spans of one tag become one; nested ones need a pass for each depth."""
    for _ in range(passes):
        for t in tags:
            html = F.regexp_replace(html, f"</{t}>(\\s*)<{t}>", "$1")
    return html


def block_html(block_type: Column, level: Column, text: Column) -> Column:
    h = F.coalesce(level, F.lit(2)).cast("string")
    wrap = lambda tag: F.concat(F.lit(f"<{tag}>"), text, F.lit(f"</{tag}>"))
    return (
        F.when(block_type == "SectionHeader", F.concat(F.lit("<h"), h, F.lit(">"), text, F.lit("</h"), h, F.lit(">"))).when(block_type == "ListItem", wrap("li")).when(block_type == "Code", F.concat(F.lit("<pre>"), text, F.lit("</pre>")))
        .when(block_type == "Equation", F.concat(F.lit('<math display="block">'), text, F.lit("</math>"))).when(block_type.isin("Table", "Form"), text).otherwise(wrap("p"))
    )


def ordered_text(blocks: DataFrame, doc: list[str], line: Column, name: str, order: str = "block_ord", by: str = "\n") -> DataFrame:
    rows = blocks.select(*doc, F.struct(F.col(order).alias("o"), line.alias("t")).alias("r"))
    return rows.groupBy(*doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["t"]), by).alias(name))


def html(blocks: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """(doc, html); page headers and footers, and blocks marked ignore, are left out."""
    shown = ~F.col("block_type").isin("PageHeader", "PageFooter")
    if "ignore" in blocks.columns:
        shown = shown & ~F.coalesce("ignore", F.lit(False))
    return ordered_text(blocks.where(shown), doc, block_html(F.col("block_type"), F.col("level"), F.col("text")), "html", order)


def json_tree(blocks: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """(doc, json): pages with their blocks in order."""
    b = F.struct(F.col(order).alias("o"), F.struct(F.col("block_type").alias("type"), "text", "level").alias("b"))
    pages = blocks.groupBy(*doc, "page_id").agg(F.transform(F.array_sort(F.collect_list(b)), lambda x: x["b"]).alias("blocks"))
    return pages.groupBy(*doc).agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("page_id", "blocks")), lambda a, z: a["page_id"] - z["page_id"]).alias("pages"))).alias("json"))


def page_stats(blocks: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, page_id, counts): how many blocks of each type a page has."""
    each = blocks.groupBy(*doc, "page_id", "block_type").agg(F.count("*").alias("n"))
    return each.groupBy(*doc, "page_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("block_type", "n")))).alias("counts"))


def migrate(messages: DataFrame, target: str = "2.1") -> DataFrame:
    """Messages of version 1.0, 1.1 or 2.0 (columns version, data, timestamp, payload, metadata, routing; JSON texts) brought to `target`.

    1.1 adds a timestamp; 2.0 makes data the payload and notes where it came from; 2.1 adds routing.
    """
    steps = ["1.0", "1.1", "2.0", "2.1"]
    at = F.array_position(F.array(*map(F.lit, steps)), F.col("version"))
    to = steps.index(target) + 1
    moves = (at < 3) & (to >= 3)
    return messages.withColumns({
        "timestamp": F.when((at < 2) & (to >= 2), F.coalesce("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))).otherwise(F.col("timestamp")),
        "payload": F.when(moves, F.when(F.col("data").rlike(r"^\s*\{"), F.col("data")).otherwise(F.concat(F.lit('{"data":'), F.coalesce("data", F.lit("null")), F.lit("}")))).otherwise(F.col("payload")),
        "metadata": F.when(moves, F.to_json(F.struct(F.lit("1.1").alias("migrated_from"), F.col("timestamp").alias("original_timestamp")))).otherwise(F.col("metadata")),
        "data": F.when(moves, F.lit(None)).otherwise(F.col("data")),
        "routing": F.when((at < 4) & (to >= 4), F.coalesce("routing", F.lit("{}"))).otherwise(F.col("routing")),
        "version": F.when(at < to, target).otherwise(F.col("version")),
    })
