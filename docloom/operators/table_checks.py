"""Checks of HTML tables: their cells, where spans put them, and what is wrong with the grid they make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What browsers take of a span.
MOST_DOWN, MOST_ACROSS = 65_534, 1_000


def html_cells(tables: DataFrame, key: list[str], html: str = "html") -> DataFrame:
    """(key, row_id, ord, is_header, rowspan, colspan, text) of the first table in each html; no row where there is no table.

    Tables end at the first end tag, or with the text. A row begins at each <tr>; cells before the first one are no cells.
    A span that is no number is 1. Expressions only, one pass over the text.
    """
    body = F.regexp_extract(F.coalesce(F.col(html), F.lit("")), r"(?is)<table\b[^>]*>(.*?)(?:</table\s*>|\z)", 1)
    rows = F.slice(F.split(body, r"(?i)<tr\b"), 2, 1_000_000)
    whole = tables.where(F.coalesce(F.col(html), F.lit("")).rlike(r"(?i)<table\b"))
    row = whole.select(*key, F.posexplode(rows).alias("row_id", "_r"))
    cell = row.select(*key, "row_id", F.posexplode(F.slice(F.split("_r", r"(?i)(?=<t[dh]\b)"), 2, 1_000_000)).alias("ord", "_c"))
    span = lambda name: F.coalesce(F.regexp_extract("_c", rf"""(?is)^<t[dh]\b[^>]*?\b{name}\s*=\s*["']?(\d{{1,6}})""", 1).try_cast("int"), F.lit(1))
    text = F.regexp_replace(F.regexp_replace("_c", r"(?s)<[^>]*(?:>|\z)", ""), r"\s+", " ")
    return cell.select(*key, "row_id", "ord", F.lower(F.substring("_c", 1, 3)).eqNullSafe(F.lit("<th")).alias("is_header"), span("rowspan").alias("rowspan"), span("colspan").alias("colspan"), F.trim(text).alias("text"))


def placed_cells(cells: DataFrame, table: list[str]) -> DataFrame:
    """(table, row_id, ord, col_id, rowspan, colspan): each cell in the first place of its row, from the cell before on, that no
    span from above covers. cells: table columns, row_id from 0, ord (in its row), rowspan, colspan.

    Spans go down to the table's last row at most; a rowspan of 0 goes all the way. The cells of a table are folded in
    order in the JVM; what the fold holds is the columns that spans from above still cover.
    """
    down, across = F.least(F.coalesce("rowspan", F.lit(1)), F.lit(MOST_DOWN)), F.greatest(F.lit(1), F.least(F.coalesce("colspan", F.lit(1)), F.lit(MOST_ACROSS)))
    one = F.struct(F.col("row_id").cast("int").alias("r"), F.col("ord").cast("int").alias("o"), down.cast("int").alias("d"), across.cast("int").alias("a"))
    whole = cells.groupBy(*table).agg(F.array_sort(F.collect_list(one)).alias("_c"), F.max("row_id").cast("int").alias("_last"))
    start = "struct(-1 as row, 0 as next, cast(array() as array<struct<c:int,until:int>>) as open, cast(array() as array<struct<r:int,o:int,c:int,d:int,a:int>>) as out)"
    # columns that are covered in a row, and the first one from a place on that isn't
    held = "transform(filter(s.open, x -> x.until >= c.r), x -> x.c)"
    first = f"array_min(array_except(sequence(if(s.row = c.r, s.next, 0), if(s.row = c.r, s.next, 0) + size({held})), {held}))"
    tall = "if(c.d <= 0, _last - c.r + 1, least(c.d, _last - c.r + 1))"
    step = f"""aggregate(array({first}), s, (s, at) -> struct(c.r as row, at + c.a as next,
      concat(filter(s.open, x -> x.until >= c.r), if({tall} > 1, transform(sequence(at, at + c.a - 1), k -> struct(k as c, c.r + {tall} - 1 as until)), cast(array() as array<struct<c:int,until:int>>))) as open,
      concat(s.out, array(struct(c.r as r, c.o as o, at as c, {tall} as d, c.a as a))) as out))"""
    placed = whole.select(*table, F.explode(F.expr(f"aggregate(_c, {start}, (s, c) -> {step}, s -> s.out)")).alias("p"))
    return placed.select(*table, F.col("p.r").alias("row_id"), F.col("p.o").alias("ord"), F.col("p.c").alias("col_id"), F.col("p.d").alias("rowspan"), F.col("p.a").alias("colspan"))


def grid_faults(cells: DataFrame, table: list[str]) -> DataFrame:
    """(table, width, n_overlaps, n_holes): places that several cells cover, and places of the table's rectangle that none does.

    cells: as placed_cells() gives them. Spans are spread to places and counted, with nothing gathered.
    """
    places = cells.select(*table, F.explode(F.sequence(F.col("row_id"), F.col("row_id") + F.col("rowspan") - 1)).alias("y"), "col_id", "colspan")
    places = places.select(*table, "y", F.explode(F.sequence(F.col("col_id"), F.col("col_id") + F.col("colspan") - 1)).alias("x"))
    each = places.groupBy(*table, "y", "x").agg(F.count("*").alias("n"))
    size = each.groupBy(*table).agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("_rows"), F.count("*").alias("_filled"), F.count_if(F.col("n") > 1).alias("n_overlaps"))
    return size.select(*table, "width", "n_overlaps", (F.col("width") * F.col("_rows") - F.col("_filled")).alias("n_holes"))


def check_tables(tables: DataFrame, cells: DataFrame, table: list[str], min_rows: int | None = None, max_rows: int | None = None, min_cols: int | None = None, max_cols: int | None = None, need_header: bool = False, even_rows: bool = True, sound_grid: bool = True) -> DataFrame:
    """tables with n_rows, n_cols (cells of the first row), has_header, width, n_overlaps, n_holes, problems and valid.

    cells: as html_cells() gives them. problems are, in this order: `no table`, `too few rows`, `too many rows`, `too few columns`,
    `too many columns`, `no header`, `rows of unequal length` (even_rows: in cells, spans aside), `cells overlap` and
    `places without a cell` (sound_grid).
    """
    rows = cells.groupBy(*table, "row_id").agg(F.count("*").alias("n"), F.max("is_header").alias("h"))
    shape = rows.groupBy(*table).agg(F.count("*").alias("n_rows"), F.min_by("n", "row_id").alias("n_cols"), F.max("h").alias("has_header"), (F.min("n") != F.max("n")).alias("_uneven"))
    out = tables.join(shape, table, "left").join(grid_faults(placed_cells(cells, table), table), table, "left")
    there = F.col("n_rows").isNotNull()
    says: list[tuple[Column, str]] = [(~there, "no table")]
    for bound, column, name in ((min_rows, "n_rows", "few rows"), (max_rows, "n_rows", "many rows"), (min_cols, "n_cols", "few columns"), (max_cols, "n_cols", "many columns")):
        if bound is not None:
            says.append((F.col(column) < bound if "few" in name else F.col(column) > bound, f"too {name}"))
    if need_header:
        says.append((~F.col("has_header"), "no header"))
    if even_rows:
        says.append((F.col("_uneven"), "rows of unequal length"))
    if sound_grid:
        says += [(F.col("n_overlaps") > 0, "cells overlap"), (F.col("n_holes") > 0, "places without a cell")]
    problems = F.array_compact(F.array(*[F.when(c, F.lit(s)) for c, s in says]))
    return out.withColumn("problems", problems).withColumn("valid", F.size("problems") == 0).drop("_uneven")
