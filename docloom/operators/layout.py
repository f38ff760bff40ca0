"""Pages and their layout: which text source a page takes, what its boxes cover, and where its footnotes and list items go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g


def usable_pages(objects: DataFrame, page: list[str], strip_hidden: bool = False, image_share: float = 0.65) -> DataFrame:
    """(page, usable): whether a page's own text layer can be read.

    objects: page columns, kind (text or image), box, page_box, hidden, embedded, font. A page without a text object is
    not usable. With strip_hidden neither is one with hidden text, with no embedded font at all, with glyphless fonts
    only, or with an image over image_share of it. Null flags count as false.
    """
    text, image = F.col("kind") == "text", F.col("kind") == "image"
    no = F.lit(False)
    usable = F.count_if(text) > 0
    if strip_hidden:
        glyphless = F.contains(F.lower(F.coalesce("font", F.lit(""))), F.lit("glyphless"))
        usable = (
            usable & (F.count_if(text & F.coalesce("hidden", no)) == 0) & (F.count_if(text & F.coalesce("embedded", no)) > 0)
            & (F.count_if(text & ~glyphless) > 0) & (F.count_if(image & (g.intersection_share(F.col("page_box"), F.col("box")) >= image_share)) == 0)
        )
    return objects.groupBy(*page).agg(usable.alias("usable"))


def text_source(pages: DataFrame, doc: list[str], most: float = 0.85) -> DataFrame:
    """pages (document columns, good) with source, `layer` or `recognition`: its own where the page is good, and for all pages of a document over `most` of which are."""
    good = F.coalesce("good", F.lit(False))
    share = F.avg(good.cast("double")).over(Window.partitionBy(*doc))
    return pages.withColumn("source", F.when(good | (share > most), "layer").otherwise("recognition"))


def layout_coverage(blocks: DataFrame, lines: DataFrame, page: list[str], least: float = 0.25, least_lines: int = 1) -> DataFrame:
    """(page, coverage, covered) for pages with blocks: the share of blocks that least_lines lines or more touch, and whether it is `least`.

    blocks: page columns, block_id, box, block_type, page_box. A page whose only block is text over four fifths of it is
    covered whatever its lines: layout models say so of blank pages.
    """
    touching = lines.groupBy(*page, F.col("box").alias("line_box")).agg(F.count("*").alias("n"))  # equal boxes are measured once
    met = blocks.select(*page, "box").distinct().join(touching, page).where(g.intersection_area(F.col("box"), F.col("line_box")) > 0)
    met = met.groupBy(*page, "box").agg(F.sum("n").alias("n"))
    touched = F.sum(F.coalesce("n", F.lit(0))) >= least_lines
    whole = (F.col("block_type") == "Text") & (g.intersection_share(F.col("page_box"), F.col("box")) > 0.8)
    each = blocks.join(met, [*page, "box"], "left").groupBy(*page, "block_id").agg(touched.alias("touched"), F.first(whole).alias("whole"))
    share = F.count_if("touched") / F.count("*")
    return each.groupBy(*page).agg(share.alias("coverage"), ((share >= least) | ((F.count("*") == 1) & F.coalesce(F.max("whole"), F.lit(False)))).alias("covered"))


def mark_math_lines(lines: DataFrame, formulas: DataFrame, page: list[str], tallest: float = 2.0) -> DataFrame:
    """lines (page columns, line_id, box) with math: whether some formula's greatest overlap is with the line, and the line is not taller than `tallest` widths.

    formulas: page columns, formula_id, box. Ties go to the smaller line_id.
    """
    line = lines.groupBy(*page, F.col("box").alias("line_box")).agg(F.min("line_id").alias("line_id"))
    shared = g.intersection_area(F.col("box"), F.col("line_box"))
    best = formulas.select(*page, "box").distinct().join(line, page).where(shared > 0).groupBy(*page, "box").agg(F.min(F.struct((-shared).alias("k"), "line_id"))["line_id"].alias("line_id"))
    marked = lines.join(best.select(*page, "line_id", F.lit(True).alias("_m")).distinct(), [*page, "line_id"], "left")
    upright = g.height(F.col("box")) <= tallest * g.width(F.col("box"))
    return marked.withColumn("math", F.coalesce(F.col("_m") & upright, F.lit(False))).drop("_m")


def missed_boxes(found: DataFrame, other: DataFrame, page: list[str], most: float = 0.8) -> DataFrame:
    """Rows of other (page columns, box) that no box of found on the page matches by more than `most` of union."""
    f = found.select(*page, F.col("box").alias("f_box")).distinct()
    matched = other.select(*page, "box").distinct().join(f, page).where(g.iou(F.col("box"), F.col("f_box")) > most).select(*page, "box").distinct()
    return other.join(matched, [*page, "box"], "left_anti").select(other.columns)


def footnotes_last(blocks: DataFrame, page: list[str], order: str = "block_ord") -> DataFrame:
    """blocks with place, from 0 on each page: footnotes after all else, otherwise as before."""
    w = Window.partitionBy(*page).orderBy(F.coalesce(F.col("block_type") == "Footnote", F.lit(False)), order)
    return blocks.withColumn("place", F.row_number().over(w) - 1)


def footnote_marks(spans: DataFrame, block: list[str], order: str = "span_ord") -> DataFrame:
    """Spans of footnotes with superscript: set for a footnote's first span where it starts with digits or marks."""
    first = F.row_number().over(Window.partitionBy(*block).orderBy(order)) == 1
    return spans.withColumn("superscript", first & F.coalesce(F.col("text").rlike(r"^[0-9\W]+"), F.lit(False)))


def list_levels(items: DataFrame, group: list[str], order: str = "block_ord", indent: float = 0.01) -> DataFrame:
    """(group, order, level): nesting of list items by their left edges.

    items: list columns, order, box, page_width. An item is a level below the last one above it that starts more than
    `indent` of the page's width to its left; an item that starts right of the one before's end begins a new column,
    which nests within nothing before it. A group is one list of one page, folded in the JVM as one array.
    """
    one = F.struct(F.col(order).alias("o"), F.col("box.x0").alias("x"), F.col("box.x1").alias("end"), F.col("box.y0").alias("y"), (indent * F.col("page_width")).cast("double").alias("step"))
    empty = F.expr("struct(cast(array() as array<struct<x:double,y:double,level:int>>) as open, cast(null as double) as end, cast(array() as array<int>) as levels)")

    def nest(state: Column, item: Column) -> Column:
        kept = F.when(item["x"] > state["end"], F.slice(state["open"], 1, 0)).otherwise(F.filter(state["open"], lambda s: s["x"] + item["step"] < item["x"]))
        above = F.try_element_at(kept, F.lit(-1))
        level = F.when(above["y"] < item["y"], above["level"] + 1).otherwise(0)
        return F.struct(
            F.concat(kept, F.array(F.struct(item["x"].alias("x"), item["y"].alias("y"), level.alias("level")))).alias("open"),
            item["end"].alias("end"), F.concat(state["levels"], F.array(level)).alias("levels"),
        )

    lists = items.groupBy(*group).agg(F.array_sort(F.collect_list(one)).alias("l"))
    levels = F.aggregate("l", empty, nest, lambda s: s["levels"])
    return lists.select(*group, F.explode(F.arrays_zip(F.transform("l", lambda i: i["o"]).alias(order), levels.alias("level"))).alias("z")).select(*group, f"z.{order}", "z.level")


def content_statistics(blocks: DataFrame, doc: list[str], order: str = "block_ord", first_sections: int = 5, first_chars: int = 10_000) -> DataFrame:
    """(doc, counts, sections, head): blocks of each type, the first section titles, and the start of the text of all blocks."""
    kinds = blocks.groupBy(*doc, "block_type").agg(F.count("*").alias("n")).groupBy(*doc).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("block_type", "n")))).alias("counts"))
    before = F.coalesce(F.sum(F.length("text") + 1).over(Window.partitionBy(*doc).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    titled = F.col("block_type") == "SectionHeader"
    nth = F.sum(titled.cast("int")).over(Window.partitionBy(*doc).orderBy(order))
    marked = blocks.withColumns({"_at": before, "_nth": nth})
    ordered = lambda keep: F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct(F.col(order).alias("o"), F.col("text").alias("t"))))), lambda r: r["t"])
    texts = marked.groupBy(*doc).agg(
        ordered(titled & (F.col("_nth") <= first_sections)).alias("sections"),
        F.substring(F.array_join(ordered((F.col("_at") < first_chars) & F.col("text").isNotNull()), "\n"), 1, first_chars).alias("head"),
    )
    return kinds.join(texts, doc)


def structure_statistics(blocks: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, page_id, n_blocks, counts, has_toc, has_header, has_footer): what each page is made of."""
    each = blocks.groupBy(*doc, "page_id", F.coalesce("block_type", F.lit("Unknown")).alias("block_type")).agg(F.count("*").alias("n"))
    has = lambda kind: F.max(F.col("block_type") == kind)
    return each.groupBy(*doc, "page_id").agg(
        F.sum("n").alias("n_blocks"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("block_type", "n")))).alias("counts"),
        has("TableOfContents").alias("has_toc"), has("PageHeader").alias("has_header"), has("PageFooter").alias("has_footer"),
    )
