"""Which tables are parts of one, and their merging. Pairs are made within a document; scores are expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.similarity import fuzzy


def vertical_proximity(a: Column, b: Column, page_a: Column, page_b: Column, page_height: Column) -> Column:
    """On one page, the gap between the two as a share of its height, from 1. On neighbouring pages the mean of what is
    left below the first one's end and the second one's start; so it can pass 1 where tables of a page overlap."""
    between = F.when(a["y1"] <= b["y0"], b["y0"] - a["y1"]).otherwise(a["y0"] - b["y1"])
    over = lambda first, second: (2 - first["y1"] / page_height - second["y0"] / page_height) / 2
    return (
        F.when(page_a == page_b, F.greatest(F.lit(0.0), 1 - between / page_height)).when(page_a + 1 == page_b, over(a, b))
        .when(page_b + 1 == page_a, over(b, a)).otherwise(0.0)
    )


def horizontal_overlap(a: Column, b: Column) -> Column:
    """Shared width against the width of both together."""
    both = F.greatest(a["x1"], b["x1"]) - F.least(a["x0"], b["x0"])
    shared = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    return F.when((shared >= 0) & (both > 0), shared / both).otherwise(0.0)


def merge_evidence(columns_equal: Column, columns_alike: Column, header_alike: Column, content_alike: Column, goes_on: Column, near: Column, overlap: Column, adjacent: Column, same_page: Column, threshold: float = 0.65) -> Column:
    """(score, merge): structure 0.4, content 0.3, position 0.3; like headers on neighbouring pages lift the position to 0.8
    at least, and close tables of one page with like columns merge whatever the score."""
    structure = 0.7 * columns_equal.cast("double") + 0.3 * columns_alike
    content = 0.5 * header_alike + 0.3 * content_alike + 0.2 * goes_on.cast("double")
    position = 0.5 * near + 0.5 * overlap
    position = F.when(adjacent & (header_alike > 0.7) & (columns_alike > 0.7), F.greatest(position, F.lit(0.8))).otherwise(position)
    score = 0.4 * structure + 0.3 * content + 0.3 * position
    return F.struct(score.alias("score"), ((score >= threshold) | (same_page & (near > 0.8) & (columns_alike > 0.7))).alias("merge"))


def merge_candidates(tables: DataFrame, doc: list[str]) -> DataFrame:
    """Scored pairs (doc, a, b, score, merge) of a document's tables on one page or neighbouring ones, a before b.

    tables: document columns, table_ord, page_id, page_height, box, header array<string>, body string, first_row, last_row.
    """
    side = lambda df, s: df.select(*doc, *[F.col(c).alias(f"{c}_{s}") for c in ("table_ord", "page_id", "page_height", "box", "header", "body", "first_row", "last_row")])
    pairs = side(tables, "a").join(side(tables, "b"), doc).where((F.col("table_ord_a") < F.col("table_ord_b")) & (F.abs(F.col("page_id_a") - F.col("page_id_b")) <= 1))
    header = fuzzy(F.array_join("header_a", " "), F.array_join("header_b", " ")) / 100
    body = fuzzy(F.col("body_a"), F.col("body_b")) / 100
    edge = fuzzy(F.col("last_row_a"), F.col("first_row_b")) / 100
    alike = F.least(F.size("header_a"), F.size("header_b")) / F.greatest(F.size("header_a"), F.size("header_b"), F.lit(1))
    near = vertical_proximity(F.col("box_a"), F.col("box_b"), F.col("page_id_a"), F.col("page_id_b"), F.col("page_height_a"))
    p = pairs.withColumns({"_h": header, "_c": body, "_e": edge})
    e = merge_evidence(F.size("header_a") == F.size("header_b"), alike, F.col("_h"), F.col("_c"), (F.col("_h") > 0.8) & (F.col("_e") < 0.5), near, horizontal_overlap(F.col("box_a"), F.col("box_b")), F.abs(F.col("page_id_a") - F.col("page_id_b")) == 1, F.col("page_id_a") == F.col("page_id_b"))
    return p.withColumn("_m", e).select(*doc, F.col("table_ord_a").alias("a"), F.col("table_ord_b").alias("b"), "_m.score", "_m.merge")


def merged_into(pairs: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, table_ord, into): each table that another absorbs. In order, a table that none has absorbed takes its later matches.

    The matches of a document, which neighbour_pairs() and merge_candidates() keep to its neighbouring pages, are folded in order in the JVM.
    """
    kind = dict(pairs.dtypes)["a"]
    matches = pairs.where("merge").groupBy(*doc).agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("_m"))
    fold = f"aggregate(_m, cast(array() as array<struct<table_ord:{kind},into:{kind}>>), (s, p) -> if(exists(s, x -> x.table_ord = p.a or x.table_ord = p.b), s, concat(s, array(struct(p.b as table_ord, p.a as into)))))"
    return matches.select(*doc, F.inline(F.expr(fold)))


def neighbour_pairs(tables: DataFrame, doc: list[str], order: str = "table_ord", near: float = 0.05) -> DataFrame:
    """(doc, a, b, same_page, columns_match, adjacent, continues, confidence, candidate, merge): each table with the one after it.

    tables: document columns, order, page_id, page_height, box, n_columns, first_cell, last_cell (of the first column). Pairs are
    neighbours on one page, or the last of a page and the first of the next. Confidence is 0.5, 0.3 more for as many
    columns, 0.1 for tables that lie close (within `near` of the page's height, or over the page break) and 0.1 where row
    numbers go on. Candidates have more than 0.7, over a page break more than 0.8; those with as many columns merge.
    """
    w = Window.partitionBy(*doc).orderBy(order)
    nxt = lambda c: F.lead(c).over(w)
    number = lambda c: F.trim(c).try_cast("bigint")
    p = tables.select(
        *doc, F.col(order).alias("a"), nxt(order).alias("b"), (nxt("page_id") == F.col("page_id")).alias("same_page"), (nxt("page_id") == F.col("page_id") + 1).alias("_over"),
        (nxt("n_columns") == F.col("n_columns")).alias("columns_match"), g.gap(F.col("box"), nxt("box")).alias("_gap"), "page_height", (number(nxt("first_cell")) == number(F.col("last_cell")) + 1).alias("continues"),
    )
    p = p.where("b is not null and (same_page or _over)").withColumn("adjacent", ~F.col("same_page") | F.coalesce(F.col("_gap") < near * F.col("page_height"), F.lit(False)))
    p = p.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("columns_match", "continues")})
    tenths = 5 + 3 * F.col("columns_match").cast("int") + F.col("adjacent").cast("int") + F.col("continues").cast("int")
    candidate = F.when(F.col("same_page"), tenths > 7).otherwise(tenths > 8)
    return p.select(*doc, "a", "b", "same_page", "columns_match", "adjacent", "continues", (tenths / 10).alias("confidence"), candidate.alias("candidate"), (candidate & F.col("columns_match")).alias("merge"))


def merge_chains(tables: DataFrame, pairs: DataFrame, doc: list[str], order: str = "table_ord") -> DataFrame:
    """tables with chain: the order of the first of the tables that merge one into the next. pairs: as neighbour_pairs() gives them."""
    goes_on = pairs.where("merge").select(*doc, F.col("b").alias(order), F.lit(True).alias("_on"))
    marked = tables.join(goes_on, [*doc, order], "left")
    first = F.when(F.col("_on").isNull(), F.col(order))
    return marked.withColumn("chain", F.last(first, ignorenulls=True).over(Window.partitionBy(*doc).orderBy(order))).drop("_on")


_MARKERS = "table|exhibit|figure"
_KEYWORDS = "data|results|statistics|analysis|comparison|summary|breakdown|distribution|metrics|performance"


def table_titles(blocks: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """(doc, order, title, source, inferred) of the Table blocks of a document.

    A title is the text right before the table, right after it, or the section header above it, in this order, if it is
    shorter than 200 characters and names a table, exhibit or figure. Otherwise it is inferred: the first sentence of the
    last Text above that tells of data (by keywords), or else a section header of under 100 characters; cut at 80
    characters. Tables aren't neighbours of each other: what stands right before or after is the nearest other block.
    All of it is the last or next value of one window of the document.
    """
    w = Window.partitionBy(*doc).orderBy(order)
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    kind, text = F.col("block_type"), F.coalesce("text", F.lit(""))
    last = lambda c: F.coalesce(F.last(F.when(c, text), ignorenulls=True).over(before), F.lit(""))
    near = blocks.withColumns({"_above": last(kind != "Table"), "_below": F.coalesce(F.first(F.when(kind != "Table", text), ignorenulls=True).over(after), F.lit("")), "_head": last(kind == "SectionHeader"), "_text": last(kind == "Text")})
    says = lambda c: F.lower(c).rlike(_MARKERS) & (F.length(F.trim(c)) < 200)
    sentence = F.trim(F.coalesce(F.get(F.filter(F.split("_text", r"\."), lambda s: F.lower(s).rlike(_KEYWORDS)), F.lit(0)), F.lit("")))
    head = F.trim("_head")
    short = lambda c: F.when(F.length(c) > 80, F.concat(F.substring(c, 1, 77), F.lit("..."))).otherwise(c)
    found = lambda c, source: F.struct(c.alias("title"), F.lit(source).alias("source"), F.lit(source.startswith("inferred")).alias("inferred"))
    title = (
        F.when(says(F.col("_above")), found(F.trim("_above"), "caption_above")).when(says(F.col("_below")), found(F.trim("_below"), "caption_below")).when(says(F.col("_head")), found(head, "section_header"))
        .when(sentence != "", found(F.concat(F.lit("Inferred: "), short(sentence)), "inferred_from_preceding_paragraph")).when((head != "") & (F.length(head) < 100), found(F.concat(F.lit("Inferred: "), short(head)), "inferred_from_section_header"))
        .otherwise(found(F.lit(None).cast("string"), "none"))
    )
    return near.where(kind == "Table").select(*doc, order, title.alias("t")).select(*doc, order, "t.*")
