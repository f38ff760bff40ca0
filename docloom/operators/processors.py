"""Rewrites of blocks in reading order: neighbours by window, repeated text by grouping. Thresholds are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import fuzzy
from ..functions.text import strip_edge_digits


#: Rows of a task that sorts whole pages, so that its memory is the same for any number of pages.
_TASK_ROWS = 200_000


def repeated_edges(blocks: DataFrame, doc: list[str], page: str = "page_id", order: str = "block_ord", share: float = 0.2, streak: int = 3, more_than: int = 3, match: float = 90) -> DataFrame:
    """blocks with ignore set on each page's first and last text block that is like a common one of the document.

    First and last blocks are judged apart. A text, without newlines and edge digits, is common if more than `more_than`
    of these blocks have it and either `share` of them do or `streak` pages on end; like means a fuzzy ratio above
    `match`, taken once for each distinct text of a document against its common ones.
    """
    texts = blocks.where(F.col("block_type").isin("Text", "SectionHeader", "TextInlineMath"))
    ends = texts.groupBy(*doc, page).agg(F.min(order).alias("first"), F.max(order).alias("last"))
    ends = ends.select(*doc, page, F.explode(F.create_map(F.lit("first"), "first", F.lit("last"), "last")).alias("edge", order))
    t = ends.join(texts.select(*doc, page, order, strip_edge_digits(F.col("text")).alias("clean")), [*doc, page, order])
    side = Window.partitionBy(*doc, "edge").orderBy(page)
    t = t.withColumn("_new", (~F.lag("clean").over(side).eqNullSafe(F.col("clean"))).cast("int"))
    t = t.withColumns({"_run": F.sum("_new").over(side), "_all": F.count("*").over(Window.partitionBy(*doc, "edge"))})
    runs = t.groupBy(*doc, "edge", "clean", "_run", "_all").agg(F.count("*").alias("n"))
    common = runs.groupBy(*doc, "edge", "clean", "_all").agg(F.sum("n").alias("n"), F.max("n").alias("longest"))
    common = common.where((F.col("n") > more_than) & ((F.col("n") >= share * F.col("_all")) | (F.col("longest") >= streak))).select(*doc, "edge", F.col("clean").alias("common"))
    kinds = t.select(*doc, "edge", "clean").distinct().join(common, [*doc, "edge"])
    alike = kinds.where((F.col("clean") == F.col("common")) | (fuzzy(F.col("clean"), F.col("common")) > match)).select(*doc, "edge", "clean").distinct()
    gone = t.join(alike, [*doc, "edge", "clean"], "left_semi").select(*doc, page, order).distinct().withColumn("_gone", F.lit(True))
    return blocks.join(gone, [*doc, page, order], "left").withColumn("ignore", F.coalesce("_gone", F.lit(False))).drop("_gone")


def line_number_spans(spans: DataFrame, page: list[str], share: float = 0.6) -> DataFrame:
    """spans with ignore set on each line's leftmost span where it is a number and most lines of the page begin with one.

    spans: page columns, line_id, x0, text. Pages are dealt once, to as many tasks as leave each some _TASK_ROWS spans; they are counted for that.
    """
    spans = spans.repartition(spans.count() // _TASK_ROWS + 1, *page)
    numeric = F.trim("text").rlike(r"^[0-9]+$")
    line = Window.partitionBy(*page, "line_id")
    left = F.row_number().over(line.orderBy("x0", "text")) == 1
    marked = spans.withColumn("_n", left & numeric).withColumn("_left", left)
    most = F.sum(F.col("_n").cast("int")).over(Window.partitionBy(*page)) > share * F.sum(F.col("_left").cast("int")).over(Window.partitionBy(*page))
    return marked.withColumn("ignore", F.col("_n") & most).drop("_n", "_left")


def is_line_number_block(text: Column, box: Column, least: int = 4, share: float = 0.6) -> Column:
    """A block of several tokens, mostly digits, taller than wide."""
    tokens = F.filter(F.split(text, r"\s+"), lambda t: t != "")
    digits = F.size(F.filter(tokens, lambda t: t.rlike("^[0-9]+$")))
    return (F.size(tokens) >= least) & (digits > share * F.size(tokens)) & (box["y1"] - box["y0"] > box["x1"] - box["x0"])


def blockquotes(blocks: DataFrame, page: list[str], order: str = "block_ord", aligned: float = 0.01, indent: float = 0.10) -> DataFrame:
    """blocks with quote and quote_level: Text blocks below the one before and indented from it, or aligned with a quote.

    Each indented block opens a level and each aligned one keeps it, so the level is a count of openings since the last
    block that is neither. blocks: page columns, order, block_type, box, page_width.
    """
    w = Window.partitionBy(*page).orderBy(order)
    before, box = F.lag("box").over(w), F.col("box")
    both = (F.col("block_type") == "Text") & F.coalesce(F.lag("block_type").over(w) == "Text", F.lit(False)) & F.coalesce(box["y0"] >= before["y1"], F.lit(False))
    shift = (box["x0"] - before["x0"]) / F.col("page_width")
    b = blocks.withColumns({"_in": F.coalesce(both & (shift >= indent), F.lit(False)), "_same": F.coalesce(both & (F.abs(shift) <= aligned), F.lit(False))})
    b = b.withColumn("_part", F.sum((~F.col("_in") & ~F.col("_same")).cast("int")).over(w))
    level = F.sum(F.col("_in").cast("int")).over(Window.partitionBy(*page, "_part").orderBy(order))
    return b.withColumn("quote_level", level).withColumn("quote", F.col("quote_level") > 0).drop("_in", "_same", "_part")


def continuations(blocks: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """blocks with continues: the text goes on in the next block, over a column or page break.

    The last line is full or hyphenated, the next block isn't indented, and it starts a new column, or a new page within
    its first quarter. blocks: document columns, order, page_id, box, page_width, page_height, n_lines, full_last_line,
    hyphenated, indented.
    """
    w = Window.partitionBy(*doc).orderBy(order)
    nxt, box = F.lead("box").over(w), F.col("box")
    new_page = F.lead("page_id").over(w) == F.col("page_id") + 1
    quarter = (nxt["x0"] < F.col("page_width") / 2) & (nxt["y0"] < F.col("page_height") / 2)
    column = (F.lead("page_id").over(w) == F.col("page_id")) & (nxt["x0"] > box["x1"]) & (nxt["y0"] < box["y1"])
    goes = (F.col("n_lines") >= 2) & (F.col("full_last_line") | F.col("hyphenated")) & ~F.lead("indented").over(w) & ((new_page & quarter) | column)
    text = (F.col("block_type") == "Text") & (F.lead("block_type").over(w) == "Text")
    return blocks.withColumn("continues", F.coalesce(text & goes, F.lit(False)))


def reading_order(blocks: DataFrame, page: list[str], order: str = "block_ord") -> DataFrame:
    """blocks with read_ord: page headers first and footnotes last on their page, otherwise as they were."""
    rank = F.when(F.col("block_type") == "PageHeader", 0).when(F.col("block_type") == "Footnote", 2).otherwise(1)
    return blocks.withColumn("read_ord", F.row_number().over(Window.partitionBy(*page).orderBy(rank, order)) - 1)


def table_of_contents(headers: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """One row for each document: its headers in order, as (title, level, page_id)."""
    entry = F.struct(order, F.struct(F.trim("text").alias("title"), "level", "page_id").alias("e"))
    return headers.groupBy(*doc).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"]).alias("toc"))


def indent_code(lines: DataFrame, block: list[str], order: str = "line_no") -> DataFrame:
    """(block columns, code): lines with as many spaces before them as their offset from the leftmost line holds characters.

    lines: block columns, order, x0, x1, text.
    """
    w = Window.partitionBy(*block)
    wide = F.sum(F.col("x1") - F.col("x0")).over(w) / F.greatest(F.sum(F.length("text")).over(w), F.lit(1))
    spaces = F.floor((F.col("x0") - F.min("x0").over(w)) / F.when(wide > 0, wide).otherwise(1)).cast("int")
    one = lines.select(*block, F.struct(order, F.concat(F.repeat(F.lit(" "), spaces), F.rtrim("text")).alias("t")).alias("r"))
    return one.groupBy(*block).agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["t"]), "\n").alias("code"))


def missing_from_corpus(blocks: DataFrame, corpus: DataFrame, doc: list[str], least: int = 20, head: int = 100, match: float = 97) -> DataFrame:
    """Blocks whose beginning is nowhere in their document's raw text, with the best ratio. corpus: document columns, full_text."""
    t = blocks.where(F.length("text") >= least).join(corpus, doc)
    found = F.contains(F.col("full_text"), F.substring("text", 1, head))
    ratio = F.when(found, F.lit(100.0)).otherwise(fuzzy(F.substring("text", 1, head), F.col("full_text"), "partial"))
    return t.withColumn("ratio", ratio).where(F.col("ratio") < match).drop("full_text")
