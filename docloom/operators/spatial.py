"""Joins of boxes on pages: every join is an equi-join on the page, with the geometry as its condition or order.

Equal boxes of a page are measured once: the distinct boxes meet, and what comes out is joined back to their rows. So a page of
many rows costs what its distinct boxes cost, and its rows only go into equi-joins. Where pairs of rows are the result, the
distinct boxes carry lists of their rows instead.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g


def assign_lines(lines: DataFrame, blocks: DataFrame, page: list[str], near: float = 20.0, x_weight: float = 5.0) -> DataFrame:
    """Each line's block: the one it shares most area with, else the nearest centre closer than `near`; null if none.

    lines: page columns, line_id, box. blocks: page columns, block_id, box. Returns page columns, line_id, block_id, how.
    One aggregate over the pairs that share area or are near does both steps: ties go to the smaller block_id.
    """
    b = blocks.groupBy(*page, F.col("box").alias("block_box")).agg(F.min("block_id").alias("block_id"))
    shared = g.intersection_area(F.col("box"), F.col("block_box"))
    apart = g.center_distance(F.col("box"), F.col("block_box"), x_weight=x_weight)
    pairs = lines.select(*page, "box").distinct().join(b, page).where((shared > 0) | (apart < near)).select(*page, "box", "block_id", shared.alias("shared"), apart.alias("apart"))
    met = pairs.groupBy(*page, "box").agg(
        F.min(F.when(F.col("shared") > 0, F.struct((-F.col("shared")).alias("k"), "block_id"))).alias("by_area"),
        F.min(F.when(F.col("apart") < near, F.struct(F.col("apart").alias("k"), "block_id"))).alias("by_distance"),
    )
    best = lines.join(met, [*page, "box"], "left").groupBy(*page, "line_id").agg(F.min("by_area").alias("by_area"), F.min("by_distance").alias("by_distance"))
    chosen = F.coalesce(F.col("by_area.block_id"), F.col("by_distance.block_id"))
    how = F.when(F.col("by_area").isNotNull(), "area").when(F.col("by_distance").isNotNull(), "distance")
    return best.select(*page, "line_id", chosen.alias("block_id"), how.alias("how"))


def orphan_islands(lines: DataFrame, page: list[str], order: str, within: float = 20.0) -> DataFrame:
    """Consecutive lines no farther apart than `within` share an island number, from 0 on each page."""
    w = Window.partitionBy(*page).orderBy(order)
    new = F.coalesce(g.gap(F.lag("box").over(w), F.col("box")) > within, F.lit(False)).cast("int")
    return lines.withColumn("island", F.sum(new).over(w))


def new_blocks(orphans: DataFrame, blocks: DataFrame, page: list[str], order: str = "line_ord", within: float = 20.0, x_weight: float = 5.0) -> DataFrame:
    """Text blocks for lines that no block took: page columns, first_line, n_lines, box around them, after: the block_id to stand behind.

    orphans: page columns, order (a line's number on its page), box. blocks: page columns, block_id, box, without types that
    nothing may follow. Lines with consecutive numbers whose centres lie closer than `within` are one block. It follows the
    block whose centre is nearest its first line's, sidewise distances counting x_weight times; ties go to the smaller
    block_id, and after is null on pages without blocks. A line without a box is a block of its own.
    """
    w = Window.partitionBy(*page).orderBy(order)
    goes_on = (F.lag(order).over(w) + 1 == F.col(order)) & (g.center_distance(F.lag("box").over(w), F.col("box")) < within)
    numbered = orphans.withColumn("_new", F.sum((~F.coalesce(goes_on, F.lit(False))).cast("int")).over(w))
    made = numbered.groupBy(*page, "_new").agg(F.min(order).alias("first_line"), F.count("*").alias("n_lines"), g.merged(F.col("box")).alias("box"), F.min_by("box", order).alias("_first"))
    b = blocks.select(*page, "block_id", F.col("box").alias("_box"))
    apart = g.center_distance(F.col("_first"), F.col("_box"), x_weight=x_weight, absolute=True)
    near = made.join(b, page, "left").groupBy(*page, "first_line", "n_lines", "box").agg(F.min(F.when(apart.isNotNull(), F.struct(apart.alias("d"), "block_id"))).alias("m"))
    return near.select(*page, "first_line", "n_lines", "box", F.col("m.block_id").alias("after"))


def covered(inner: DataFrame, outer: DataFrame, page: list[str], share: float = 0.95, keep: bool = False) -> DataFrame:
    """Rows of inner that no box of outer on the page covers by more than `share` (keep: those that one does)."""
    o = outer.select(*page, F.col("box").alias("o_box")).distinct()
    hidden = inner.select(*page, "box").distinct().join(o, page).where(g.intersection_share(F.col("box"), F.col("o_box")) > share).select(*page, "box").distinct()
    return inner.join(hidden, [*page, "box"], "left_semi" if keep else "left_anti").select(inner.columns)


def nearest(points: DataFrame, blocks: DataFrame, page: list[str], point_id: str = "ref_id") -> DataFrame:
    """Each point's block with the nearest top-left corner, without a limit; ties go to the smaller block_id."""
    corner = lambda of: g.box(F.col("box")["x0"], F.col("box")["y0"], F.lit(None), F.lit(None)).alias(of)
    b = blocks.select(*page, "block_id", corner("_b")).groupBy(*page, "_b").agg(F.min("block_id").alias("block_id"))
    d = g.corner_distance(F.col("_p"), F.col("_b"))
    placed = points.select(*page, point_id, corner("_p"))
    best = placed.select(*page, "_p").distinct().join(b, page).groupBy(*page, "_p").agg(F.min(F.struct(d.alias("d"), "block_id")).alias("m"))
    return placed.join(best, [*page, "_p"]).groupBy(*page, point_id).agg(F.min("m").alias("m")).select(*page, point_id, F.col("m.block_id").alias("block_id"))


def group_captions(blocks: DataFrame, page: list[str], order: str = "block_ord", gap: float = 0.05) -> DataFrame:
    """blocks with group_of: the order of the Table, Figure or Picture that a Caption or Footnote beside it belongs to.

    A neighbour counts when it is closer than `gap` of the page's height; the block before wins over the one after.
    blocks: page columns, order, block_type, box, page_height.
    """
    w = Window.partitionBy(*page).orderBy(order)
    holds = lambda t: t.isin("Table", "Figure", "Picture")
    close = lambda f: holds(f("block_type").over(w)) & (g.gap(f("box").over(w), F.col("box")) < gap * F.col("page_height"))
    mine = F.col("block_type").isin("Caption", "Footnote")
    return blocks.withColumn("group_of", F.when(mine & close(F.lag), F.lag(order).over(w)).when(mine & close(F.lead), F.lead(order).over(w)))


def group_lists(blocks: DataFrame, page: list[str], order: str = "block_ord", gap: float = 0.10) -> DataFrame:
    """blocks with list_group (a number for each run of close ListItems, null for others) and block_type Text for lone items."""
    w = Window.partitionBy(*page).orderBy(order)
    item = F.col("block_type") == "ListItem"
    goes_on = item & F.coalesce(F.lag("block_type").over(w) == "ListItem", F.lit(False)) & (g.gap(F.lag("box").over(w), F.col("box")) < gap * F.col("page_height"))
    run = F.sum((~F.coalesce(goes_on, F.lit(False))).cast("int")).over(w)
    size = Window.partitionBy(*page, "run")
    out = blocks.withColumn("run", run).withColumn("n", F.count("*").over(size))
    grouped = (F.col("block_type") == "ListItem") & (F.col("n") > 1)
    return out.withColumns({"list_group": F.when(grouped, F.col("run")), "block_type": F.when((F.col("block_type") == "ListItem") & ~grouped, "Text").otherwise(F.col("block_type"))}).drop("run", "n")


#: measured_pairs: rows of a page that meet in one cell, from each side; ids of equal boxes in one list; pairs of a task.
_SIDE, _LIST, _TASK_PAIRS = 1_024, 4_096, 4_000_000


def measured_pairs(a: DataFrame, b: DataFrame, page: list[str], measures: Callable[[Column, Column], list[Column]], keep: Column | None = None) -> DataFrame:
    """(page columns, a_id, b_id, measures) of the pairs of boxes of a page that meet `keep`, a condition on the measures.

    a, b: page columns, id, box; rows without a box meet nothing. As many rows come out as there are pairs. Equal boxes of a page carry
    the list of their ids, so their measures are taken once and a pair of lists is written out where it was made. Large pages are
    dealt out as cells, parts of a against parts of b, to as many tasks as the pairs take; rows are counted for that first.
    """
    sides = {side: df.where(F.col("box").isNotNull()) for side, df in (("a", a), ("b", b))}
    counts = [df.groupBy(*page).agg(F.count("*").alias(f"_n{side}")) for side, df in sides.items()]
    parts = lambda side: F.ceil(F.col(f"_n{side}") / _SIDE).cast("int").alias(f"_parts_{side}")
    sizes = counts[0].join(counts[1], page)
    n_pairs = sizes.agg(F.sum(F.col("_na").cast("double") * F.col("_nb"))).first()[0] or 0
    tasks = max(1, math.ceil(n_pairs / _TASK_PAIRS), min(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_pairs / 100_000)))
    sizes = sizes.select(*page, parts("a"), parts("b"))

    def dealt(side: str, other: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*page, "box").orderBy("id")) - 1
        lists = sides[side].select(*page, "box", "id", F.floor(place / _LIST).alias("_no")).groupBy(*page, "box", "_no").agg(F.collect_list(F.struct(F.col("id").alias(f"{side}_id"))).alias(f"_{side}"))
        own = F.pmod(F.xxhash64("box", "_no"), F.col(f"_parts_{side}")).cast("int").alias(f"_at_{side}")
        met = F.explode(F.sequence(F.lit(0), F.col(f"_parts_{other}") - 1)).alias(f"_at_{other}")
        return lists.join(sizes, page).select(*page, F.col("box").alias(f"{side}_box"), f"_{side}", own, met).repartition(tasks, *page, "_at_a", "_at_b")

    values = measures(F.col("a_box"), F.col("b_box"))
    met = dealt("a", "b").join(dealt("b", "a"), [*page, "_at_a", "_at_b"]).select(*page, "_a", "_b", *values)
    if keep is not None:
        met = met.where(keep)
    names = [c for c in met.columns if c not in (*page, "_a", "_b")]
    return met.select(*page, "_b", *names, F.inline("_a")).select(*page, "a_id", *names, F.inline("_b")).select(*page, "a_id", "b_id", *names)


def overlapping_pairs(a: DataFrame, b: DataFrame, page: list[str], least: float = 0.0) -> DataFrame:
    """(page columns, a_id, b_id, iou) of boxes whose intersection over union is above `least`."""
    return measured_pairs(a, b, page, lambda x, y: [g.iou(x, y).alias("iou")], F.col("iou") > least)
