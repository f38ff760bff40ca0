"""Lines that belong together: broken lines of one text line, pieces of a formula, and lists that go on over a break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g


def banded_pairs(a: DataFrame, b: DataFrame, key: list[str], box_a: str, box_b: str, band: float = 40.0) -> DataFrame:
    """Pairs of rows of one key whose boxes share some height: an equi-join on bands of `band` units, so that rows far
    apart never meet. A pair stands in the band where the later of the two begins, so it comes out once.

    Column names of a and b differ but for the key. Boxes that are or lack an end meet nothing.
    """
    cut = lambda v: F.floor(v / band)
    spread = lambda df, box: df.withColumn("_band", F.explode(F.sequence(cut(F.col(box)["y0"]), cut(F.greatest(F.col(box)["y0"], F.col(box)["y1"])))))
    later = F.greatest(F.col(box_a)["y0"], F.col(box_b)["y0"])
    return spread(a, box_a).join(spread(b, box_b), [*key, "_band"]).where(F.col("_band") == cut(later)).drop("_band")


def merge_broken_lines(lines: DataFrame, block: list[str], order: str = "line_ord", grow: float = 0.05, least: float = 0.015, level: float = 0.8, share: float = 0.5) -> DataFrame:
    """(block columns, order, text, box, n_lines, math): lines of a block, those merged that are pieces of one text line.

    Boxes grow by `grow` of their width to either side. In order, a line joins the open merge if what it shares with the
    merge's lines is `least` of its own area, more than `share` of what it shares with all lines but the next one, and
    more than `level` of its height lies beside the merge's first line. A line that doesn't join ends the merge and stays
    alone; the one after it opens a new one. Lines five times as high as wide and more take no part. A merged line stands
    at its first one's place with the texts in order and is math. Lines without a box stay as they are.

    Lines meet by bands of height, and a block's lines are folded in order in the JVM.
    """
    flat = lines.where(g.height(F.col("box")) < 5 * g.width(F.col("box")))
    flat = flat.withColumn("_i", F.row_number().over(Window.partitionBy(*block).orderBy(order))).withColumn("_wide", g.expand(F.col("box"), grow, 0))
    one, other = flat.select(*block, "_i", "_wide"), flat.select(*block, F.col("_i").alias("_j"), F.col("_wide").alias("_other"))
    met = banded_pairs(one, other, block, "_wide", "_other").where("_i <> _j and _j <> _i + 1")
    met = met.withColumn("_s", g.intersection_area(F.col("_wide"), F.col("_other"))).where("_s > 0")
    # summed in the order of lines: another order gives other last digits, which decide where shares lie at a limit
    met = met.groupBy(*block, "_i").agg(F.array_sort(F.collect_list(F.struct("_j", "_s"))).alias("_met"))
    met = met.select(*block, "_i", F.map_from_entries("_met").alias("_with"), F.aggregate("_met", F.lit(0.0), lambda t, m: t + m["_s"]).alias("_all"))
    item = F.struct("_i", F.col(order).alias("o"), F.col("box.y0").alias("y0"), F.col("box.y1").alias("y1"), g.area(F.col("box")).alias("area"), F.coalesce("_all", F.lit(0.0)).alias("shared"), F.col("_with").alias("by"))
    whole = flat.join(met, [*block, "_i"], "left").groupBy(*block).agg(F.array_sort(F.collect_list(item), lambda a, b: a["_i"] - b["_i"]).alias("_lines"))
    mine = "coalesce(aggregate(s.open, 0D, (t, j) -> t + coalesce(c.by[j], 0D)), 0D)"
    beside = "greatest(0D, least(s.y1, c.y1) - greatest(s.y0, c.y0)) / greatest(1D, c.y1 - c.y0)"
    joins = f"{mine} / greatest(1D, c.area) >= {least}D and {beside} > {level}D and {mine} / greatest(1D, c.shared) > {share}D"
    state = "struct(cast(array() as array<int>) as open, cast(null as double) as y0, cast(null as double) as y1, {o} as head, cast(array() as array<{o_type}>) as heads)"
    kind = dict(lines.dtypes)[order]
    fold = f"""aggregate(_lines, {state.format(o=f"cast(null as {kind})", o_type=kind)}, (s, c) -> case
      when size(s.open) = 0 then struct(array(c._i) as open, c.y0 as y0, c.y1 as y1, c.o as head, concat(s.heads, array(c.o)) as heads)
      when {joins} then struct(concat(s.open, array(c._i)) as open, s.y0 as y0, s.y1 as y1, s.head as head, concat(s.heads, array(s.head)) as heads)
      else struct(cast(array() as array<int>) as open, s.y0 as y0, s.y1 as y1, s.head as head, concat(s.heads, array(c.o)) as heads) end, s -> s.heads)"""
    heads = whole.select(*block, F.explode(F.arrays_zip(F.expr("transform(_lines, c -> c.o)").alias("o"), F.expr(fold).alias("head"))).alias("z")).select(*block, F.col("z.o").alias(order), F.col("z.head").alias("_head"))
    return _joined(lines.join(heads, [*block, order], "left").withColumn("_head", F.coalesce("_head", order)), block, order)


def _joined(lines: DataFrame, key: list[str], order: str, joiner: str = "") -> DataFrame:
    """Lines of one _head as one."""
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce("text", F.lit("")).alias("t")))), lambda x: x["t"]), joiner)
    had = F.max(F.coalesce("math", F.lit(False))) if "math" in lines.columns else F.lit(False)
    out = lines.groupBy(*key, "_head").agg(texts.alias("text"), g.merged(F.col("box")).alias("box"), F.count("*").alias("n_lines"), had.alias("_math"))
    return out.select(*key, F.col("_head").alias(order), "text", "box", "n_lines", ((F.col("n_lines") > 1) | F.col("_math")).alias("math"))


def merge_formula_lines(lines: DataFrame, found: DataFrame, page: list[str], order: str = "line_ord", least: float = 0.3, near: float = 8.0) -> DataFrame:
    """(page columns, order, text, box, n_lines, math): a page's lines, those merged that a detected line says are one.

    lines: page columns, order, text, box. found: page columns, found_id, box, math (it is a formula). A line goes to the
    detected line it shares most area with, the smaller found_id on ties, if that is over `least` of its own area. Of a
    detected line's lines in order, neighbours whose tops or bottoms lie within `near` merge; so a detected line over
    several rows of text gives one line for each. A merged line stands at its first one's place and is math; one by itself
    is if its detected line is. Lines five times as high as wide and more, and those that nothing takes, stay as they are.
    """
    flat = lines.where(g.height(F.col("box")) < 5 * g.width(F.col("box"))).select(*page, order, "box")
    pairs = banded_pairs(flat, found.select(*page, "found_id", F.col("box").alias("_found"), F.coalesce("math", F.lit(False)).alias("_math")), page, "box", "_found")
    pairs = pairs.withColumn("_s", g.intersection_area(F.col("box"), F.col("_found"))).where("_s > 0")
    best = pairs.groupBy(*page, order).agg(F.min(F.struct((-F.col("_s")).alias("k"), "found_id", "_math", "box")).alias("m"))
    best = best.where(-F.col("m.k") / F.greatest(F.lit(1.0), g.area(F.col("m.box"))) > least)
    w = Window.partitionBy(*page, "m.found_id").orderBy(order)
    apart = lambda end: F.abs(F.col(f"m.box.{end}") - F.lag(f"m.box.{end}").over(w)) >= near
    parts = best.withColumn("_part", F.sum(F.coalesce(apart("y0") & apart("y1"), F.lit(False)).cast("int")).over(w))
    heads = parts.select(*page, order, F.min(order).over(Window.partitionBy(*page, "m.found_id", "_part")).alias("_head"), F.col("m._math").alias("math"))
    return _joined(lines.select(*page, order, "text", "box").join(heads, [*page, order], "left").withColumn("_head", F.coalesce("_head", order)), page, order)


def continued_lists(groups: DataFrame, doc: list[str], order: str = "block_ord", passed_over: tuple[str, ...] = ("PageHeader", "PageFooter")) -> DataFrame:
    """The ListGroups of groups with list_id, the order of the first one of their list: a list goes on in the next block if that is
    a ListGroup too and begins no lower than the list ends (a new column), or in the first quarter of another page.

    groups: document columns, order, block_type, page_id, box, page_width, page_height; blocks of `passed_over` types
    don't stand between.
    """
    w = Window.partitionBy(*doc).orderBy(order)
    kept = groups.where(~F.coalesce(F.col("block_type"), F.lit("")).isin(*passed_over))
    before, box = F.lag("box").over(w), F.col("box")
    same = F.lag("page_id").over(w) == F.col("page_id")
    quarter = (box["x0"] < F.floor(F.col("page_width") / 2)) & (box["y0"] < F.floor(F.col("page_height") / 2))
    goes_on = (F.lag("block_type").over(w) == "ListGroup") & F.when(same, box["y0"] <= before["y1"]).otherwise(quarter)
    marked = kept.withColumn("_first", F.when(~F.coalesce(goes_on, F.lit(False)), F.col(order)))
    return marked.withColumn("list_id", F.last("_first", ignorenulls=True).over(w)).where("block_type = 'ListGroup'").drop("_first")


def nested_levels(items: DataFrame, list_: list[str], order: str, indent: float = 0.01) -> DataFrame:
    """(list columns, order, level): nesting of a list's items, over all the columns and pages it goes on in.

    items: list columns, order (over the whole list), x0, column_x0, page_width. An item's place is its distance from its column's left edge,
    so what is open at the end of a column stays open in the next. An item is a level below the last open one that starts
    more than `indent` of the page's width to its left; those that don't are closed. One list is folded as one array.
    """
    one = F.struct(F.col(order).alias("o"), (F.col("x0") - F.col("column_x0")).cast("double").alias("x"), (indent * F.col("page_width")).cast("double").alias("step"))
    lists = items.groupBy(*list_).agg(F.array_sort(F.collect_list(one)).alias("_l"))
    start = F.expr("struct(cast(array() as array<double>) as open, cast(array() as array<int>) as levels)")

    def nest(state: Column, item: Column) -> Column:
        kept = F.filter(state["open"], lambda x: x + item["step"] < item["x"])
        return F.struct(F.concat(kept, F.array(item["x"])).alias("open"), F.concat(state["levels"], F.array(F.size(kept))).alias("levels"))

    levels = F.aggregate("_l", start, nest, lambda s: s["levels"])
    return lists.select(*list_, F.explode(F.arrays_zip(F.transform("_l", lambda i: i["o"]).alias("o"), levels.alias("level"))).alias("z")).select(*list_, F.col("z.o").alias(order), "z.level")
