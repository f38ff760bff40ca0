"""Table analytics over cells: one row a cell, (table columns, row_id, col_id, text)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import intersection_area

NUMERIC = r"^\d+$"
DATE = r"^(\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}[/-]\d{1,2}[/-]\d{1,2})$"
CURRENCY = r"^[$€£¥]\s?[\d,]+(\.\d+)?$"


def is_numeric(text: Column) -> Column:
    """Digits only, one decimal point aside."""
    return F.regexp_replace(F.trim(text), r"^([^.]*)\.", "$1").rlike(NUMERIC)


def melt(df: DataFrame, table: Column, row: Column, columns: list[str]) -> DataFrame:
    """A wide table to cells: (table_id, row_id, col_id, text)."""
    cells = F.array(*[F.struct(F.lit(k).alias("col_id"), F.col(c).cast("string").alias("text")) for k, c in enumerate(columns)])
    return df.select(table.alias("table_id"), row.alias("row_id"), F.explode(cells).alias("c")).select("table_id", "row_id", "c.col_id", "c.text")


def clean_text(text: Column) -> Column:
    """Cell text without dot leaders and doubled spaces; lone dots go."""
    t = F.regexp_replace(F.regexp_replace(text, r"(\s\.){2,}", ""), r"\.{2,}", "")
    t = F.trim(F.regexp_replace(t, r"\s{2,}", " "))
    return F.when(t == ".", "").otherwise(t)


def completeness(cells: DataFrame, table: list[str]) -> DataFrame:
    """Share of cells that are neither null, empty nor one space; 0 for a table without cells."""
    filled = F.count_if(F.col("text").isNotNull() & ~F.col("text").isin("", " "))
    return cells.groupBy(*table).agg((filled / F.count("*")).alias("completeness"))


def consistency(cells: DataFrame, table: list[str]) -> DataFrame:
    """0.7 if all rows are equally wide, and 0.3 times the share of columns of one type (numbers or not), from three rows up."""
    rows = cells.groupBy(*table, "row_id").agg(F.count("*").alias("wide"))
    widths = rows.groupBy(*table).agg(F.count("*").alias("n_rows"), (F.min("wide") == F.max("wide")).alias("even"))
    kinds = cells.groupBy(*table, "col_id").agg(F.count_if(is_numeric(F.col("text"))).alias("numbers"), F.count("*").alias("n"))
    pure = kinds.groupBy(*table).agg(F.avg(((F.col("numbers") == 0) | (F.col("numbers") == F.col("n"))).cast("double")).alias("pure"))
    score = F.when(F.col("even"), 0.7).otherwise(0.0) + F.when(F.col("n_rows") >= 3, 0.3 * F.col("pure")).otherwise(0.3)
    return widths.join(pure, table).select(*table, score.alias("consistency"))


def purity_penalty(cells: DataFrame, table: list[str]) -> DataFrame:
    """0.8 for tables of three rows and more where a mostly numeric column holds something else that isn't blank, else 1."""
    blank = F.trim(F.coalesce(F.col("text"), F.lit(""))) == ""
    columns = cells.groupBy(*table, "col_id").agg(F.count("*").alias("n"), F.count_if(is_numeric(F.col("text"))).alias("numbers"), F.count_if(~is_numeric(F.coalesce(F.col("text"), F.lit(""))) & ~blank).alias("others"))
    mixed = (F.col("n") >= 3) & (F.col("numbers") > 0.5 * F.col("n")) & (F.col("others") > 0)
    return columns.groupBy(*table).agg(F.when(F.max(mixed), 0.8).otherwise(1.0).alias("purity"))


def column_types(cells: DataFrame, table: list[str]) -> DataFrame:
    """numeric, date or currency where more than 70 % of a column's filled cells are; else text, or empty."""
    t = F.trim(F.coalesce(F.col("text"), F.lit("")))
    each = cells.withColumn("kind", F.when(t == "", "empty").when(is_numeric(t), "numeric").when(t.rlike(DATE), "date").when(t.rlike(CURRENCY), "currency").otherwise("text"))
    n = F.count_if(F.col("kind") != "empty")
    most = lambda k: F.count_if(F.col("kind") == k) > 0.7 * n
    return each.groupBy(*table, "col_id").agg(F.when(n == 0, "empty").when(most("numeric"), "numeric").when(most("date"), "date").when(most("currency"), "currency").otherwise("text").alias("column_type"))


def structure_score(cells: DataFrame, table: list[str]) -> DataFrame:
    """Mean of 1 / (1 + variance of row widths) and the share of filled cells."""
    rows = cells.groupBy(*table, "row_id").agg(F.count("*").alias("wide"), F.count_if(F.trim(F.coalesce(F.col("text"), F.lit(""))) != "").alias("filled"))
    return rows.groupBy(*table).agg(((1 / (1 + F.var_pop("wide")) + F.sum("filled") / F.sum("wide")) / 2).alias("structure"))


def confidence(accuracy: Column, completeness: Column, consistency: Column, whitespace: Column) -> Column:
    """0 to 100."""
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 * (0.4 * accuracy + 0.3 * completeness + 0.1 * consistency + 0.2 * whitespace)))


def needs_fallback(n_cells: Column, quality: Column, method: Column) -> Column:
    return (n_cells < 4) | (quality < 0.6) | (method == "failed")


def rows_of(cells: DataFrame, table: list[str]) -> DataFrame:
    """Cells to rows: (table columns, row_id, cells array<string>), ordered by col_id."""
    return cells.groupBy(*table, "row_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("col_id", "text"))), lambda c: c["text"]).alias("cells"))


def split_stacked_rows(cells: DataFrame, table: list[str]) -> DataFrame:
    """Tables in which at least half the rows are stacks of lines get a row for each line; others stay.

    A row is a stack if it has several cells, each of as many lines, more than one. New rows are numbered on.
    """
    lines = cells.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    per_row = lines.groupBy(*table, "row_id").agg(F.count("*").alias("n"), F.min(F.size("lines")).alias("least"), F.max(F.size("lines")).alias("most"))
    per_row = per_row.withColumn("stack", (F.col("n") > 1) & (F.col("least") == F.col("most")) & (F.col("most") > 1))
    whole = Window.partitionBy(*table)
    before = whole.orderBy("row_id").rowsBetween(Window.unboundedPreceding, -1)
    split = F.col("stack") & (F.avg(F.col("stack").cast("double")).over(whole) >= 0.5)
    tall = F.when(F.col("split"), F.col("most")).otherwise(1)
    rows = per_row.withColumn("split", split).withColumn("first", F.coalesce(F.sum(tall).over(before), F.lit(0))).select(*table, "row_id", "split", "first")
    parts = F.when(F.col("split"), F.col("lines")).otherwise(F.array("text"))
    return lines.join(rows, [*table, "row_id"]).select(*table, "first", "col_id", F.posexplode(parts).alias("k", "text")).select(*table, (F.col("first") + F.col("k")).alias("row_id"), "col_id", "text")


def merge_dollar_columns(cells: DataFrame, table: list[str]) -> DataFrame:
    """A column that holds only blanks and dollar signs, two cells or more, goes into the next column of the same rows."""
    columns = cells.groupBy(*table, "col_id").agg(F.count("*").alias("n"), F.min(F.trim(F.coalesce("text", F.lit(""))).isin("", "$")).alias("signs"), F.max(F.trim(F.coalesce("text", F.lit(""))) == "$").alias("any"), F.array_sort(F.collect_set("row_id")).alias("row_ids"))
    w = Window.partitionBy(*table).orderBy("col_id")
    gone = F.col("signs") & F.col("any") & (F.col("n") > 1) & (F.lead("row_ids").over(w) == F.col("row_ids"))
    columns = columns.withColumns({"gone": F.coalesce(gone, F.lit(False)), "next": F.lead("col_id").over(w)})
    marked = cells.join(columns.select(*table, "col_id", "gone", "next"), [*table, "col_id"])
    signs = marked.where("gone").select(*table, "row_id", F.col("next").alias("col_id"), F.trim("text").alias("sign"))
    return marked.where("not gone").drop("gone", "next").join(signs, [*table, "row_id", "col_id"], "left").withColumn("text", F.concat(F.coalesce("sign", F.lit("")), F.coalesce("text", F.lit("")))).select(*cells.columns)


def to_html(cells: DataFrame, table: list[str]) -> DataFrame:
    """(table columns, html): rows in order, header cells where is_header is set."""
    escape = F.replace(F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    tag = F.when(F.coalesce("is_header", F.lit(False)), "th").otherwise("td") if "is_header" in cells.columns else F.lit("td")
    one = cells.select(*table, "row_id", F.struct("col_id", F.concat(F.lit("<"), tag, F.lit(">"), escape, F.lit("</"), tag, F.lit(">")).alias("h")).alias("c"))
    rows = one.groupBy(*table, "row_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["h"]), "").alias("h"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "h"))), lambda r: F.concat(F.lit("<tr>"), r["h"], F.lit("</tr>"))), "\n")
    return rows.groupBy(*table).agg(F.concat(F.lit("<table>\n"), body, F.lit("\n</table>")).alias("html"))


def to_csv(cells: DataFrame, table: list[str]) -> DataFrame:
    quoted = lambda t: F.when(t.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t)
    rows = rows_of(cells, table).withColumn("line", F.array_join(F.transform("cells", lambda t: quoted(F.coalesce(t, F.lit("")))), ","))
    return rows.groupBy(*table).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "line"))), lambda r: r["line"]), "\n").alias("csv"))


def to_json(cells: DataFrame, table: list[str]) -> DataFrame:
    """(table columns, json): headers and rows. The first row with a header cell names the fields of all rows without one, of
    fields with one name the last counts; tables without such a row give arrays. Null texts and names are empty."""
    flag = F.coalesce("is_header", F.lit(False)) if "is_header" in cells.columns else F.lit(False)
    one = cells.select(*table, "row_id", flag.alias("_head"), F.struct("col_id", F.coalesce("text", F.lit("")).alias("text")).alias("_c"))
    rows = one.groupBy(*table, "row_id").agg(F.max("_head").alias("head"), F.transform(F.array_sort(F.collect_list("_c")), lambda c: c["text"]).alias("cells"))
    whole = rows.groupBy(*table).agg(F.array_sort(F.collect_list(F.struct("row_id", "head", "cells"))).alias("rows"))
    names = F.get(F.filter("rows", lambda r: r["head"]), F.lit(0))["cells"]

    def fields(row: Column) -> Column:
        keys = F.slice("names", F.lit(1), F.least(F.size("names"), F.size(row)))
        last = lambda k: F.size(keys) - F.array_position(F.reverse(keys), k)
        return F.map_from_entries(F.transform(F.array_distinct(keys), lambda k: F.struct(k, F.get(row, last(k).cast("int")))))

    named = F.to_json(F.struct(F.col("names").alias("headers"), F.transform(F.filter("rows", lambda r: ~r["head"]), lambda r: fields(r["cells"])).alias("rows")))
    plain = F.to_json(F.struct(F.array().cast("array<string>").alias("headers"), F.transform("rows", lambda r: r["cells"]).alias("rows")))
    return whole.withColumn("names", names).select(*table, F.when(F.col("names").isNotNull(), named).otherwise(plain).alias("json"))


def append_html_body(first: Column, second: Column) -> Column:
    """HTML of one table from two: the rows of the second one's first body go before the last end of a body in the first.
    Without both bodies, or where text begins with the tag, the second follows on a line of its own. Null if either is."""
    start, end = F.instr(second, "<tbody>"), F.instr(second, "</tbody>")
    rows = F.substring(second, start + F.lit(len("<tbody>")), end - start - F.lit(len("<tbody>")))
    at = F.when(F.instr(first, "</tbody>") > 0, F.length(first) - F.length(F.substring_index(first, "</tbody>", -1)) - F.lit(len("</tbody>"))).otherwise(F.lit(0))
    joined = F.concat(F.substring(first, F.lit(1), at), rows, F.substring(first, at + 1, F.length(first)))
    return F.when((start > 1) & (end > start) & (at > 0), joined).otherwise(F.concat(first, F.lit("\n"), second))


def runs(tables: DataFrame, doc: list[str], order: str = "table_ord") -> DataFrame:
    """tables with run: consecutive tables of one document that go on over a page break, beside or below each other share a number.

    tables: document columns, order, page_id, box, page_width, page_height. Four cases link a table to the one before:
    the next page with like widths; side by side; stacked; a new column of the page.
    """
    w = Window.partitionBy(*doc).orderBy(order)
    a, b = F.lag("box").over(w), F.col("box")
    wide = lambda x: x["x1"] - x["x0"]
    alike = F.abs(wide(a) - wide(b)) < 0.1 * F.col("page_width")
    same_page = F.lag("page_id").over(w) == F.col("page_id")
    next_page = F.lag("page_id").over(w) + 1 == F.col("page_id")
    level = F.abs(a["y0"] - b["y0"]) < 0.05 * F.col("page_height")
    side = same_page & level & (F.abs(b["x0"] - a["x1"]) < 0.05 * F.col("page_width"))
    stacked = same_page & alike & (F.abs(b["y0"] - a["y1"]) < 0.05 * F.col("page_height"))
    column = same_page & alike & (b["x0"] > a["x1"]) & (b["y0"] < a["y0"])
    linked = F.coalesce((next_page & alike) | side | stacked | column, F.lit(False))
    return tables.withColumn("run", F.sum((~linked).cast("int")).over(w))


def append(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables one after another; columns that one lacks are empty text there."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.fillna("")


def whitespace_patterns(cells: DataFrame, table: list[str]) -> DataFrame:
    """Per table: mean leading and trailing spaces and inner double spaces of cell lines, and whether at most two indents occur."""
    lines = cells.select(*table, F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    lead, trail = F.length("line") - F.length(F.ltrim("line")), F.length("line") - F.length(F.rtrim("line"))
    return lines.groupBy(*table).agg(F.avg(lead).alias("leading"), F.avg(trail).alias("trailing"), F.avg(F.regexp_count(F.trim("line"), F.lit(" {2,}"))).alias("inner_runs"), (F.count_distinct(lead) <= 2).alias("consistent"))


def case_patterns(cells: DataFrame, table: list[str]) -> DataFrame:
    """Per table: kinds of letter case among its filled cells, the most frequent one, and whether there are at most two."""
    t = F.trim(F.col("text"))
    kind = F.when(t == F.upper(t), "upper").when(t == F.lower(t), "lower").when(t == F.initcap(t), "title").otherwise("mixed")
    counts = cells.where(t != "").withColumn("kind", kind).groupBy(*table, "kind").agg(F.count("*").alias("n"))
    return counts.groupBy(*table).agg(F.count("*").alias("kinds"), F.min(F.struct((-F.col("n")).alias("n"), "kind"))["kind"].alias("dominant"), (F.count("*") <= 2).alias("consistent"))


def join_cells(first: DataFrame, second: DataFrame, table: list[str], direction: str = "bottom") -> DataFrame:
    """Cells of both tables of each key as one: the second's columns go to the right of the first's, or its rows below them.

    Where the two don't fit (five rows apart and more, or two columns), the first one stays as it is. direction: right or
    bottom. A key that only one side has keeps its cells.
    """
    id_, across = ("col_id", "row_id") if direction == "right" else ("row_id", "col_id")
    most = 5 if direction == "right" else 2
    span = lambda df, s: df.groupBy(*table).agg(F.count_distinct(id_).alias(f"_shift{s}"), F.count_distinct(across).alias(f"_across{s}"))
    sizes = span(first, 1).join(span(second, 2), table, "right")
    fits = F.col("_across1").isNull() | (F.abs(F.col("_across1") - F.col("_across2")) < most)
    moved = second.join(sizes.where(fits).select(*table, "_shift1"), table)
    moved = moved.withColumn(id_, (F.col(id_) + F.coalesce("_shift1", F.lit(0))).cast(first.schema[id_].dataType))
    return first.unionByName(moved.select(first.columns))


def spread_spans(cells: DataFrame, table: list[str]) -> DataFrame:
    """cells with col_id on the table's grid: a cell goes to the first place of its row that no span above or before it covers.

    cells: table columns, row_id, col_id (the order in its row), rowspan, colspan. Spans are cut at the table's edges;
    its width is the widest sum of a row's colspans. Cells without room, and those with a span of 0, are left out.
    """

    def placed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["row_id", "col_id"]).reset_index(drop=True)
        down, across = rows["rowspan"].fillna(1).astype(int), rows["colspan"].fillna(1).astype(int)
        width, bottom = int(across.groupby(rows["row_id"]).sum().max()), int(rows["row_id"].max())
        taken: set[tuple[int, int]] = set()
        kept, row, column = [], None, 0
        for k, (r, high, wide) in enumerate(zip(rows["row_id"], down, across, strict=True)):
            row, column = r, column if r == row else 0
            while (r, column) in taken:
                column += 1
            high, wide = min(high, bottom - r + 1), min(wide, width - column)
            if high > 0 and wide > 0:
                taken.update((y, x) for y in range(r, r + high) for x in range(column, column + wide))
                kept.append((k, column, high, wide))
                column += wide
        place = pd.DataFrame(kept, columns=["k", "col_id", "rowspan", "colspan"])
        return rows.iloc[place["k"]].assign(**{c: place[c].to_numpy() for c in ("col_id", "rowspan", "colspan")})

    return cells.groupBy(*table).applyInPandas(placed, cells.schema)


def text_to_cells(lines: DataFrame, cells: DataFrame, page: list[str]) -> DataFrame:
    """(page columns, cell_id, text): each line goes to the cell it shares most area with, the smaller cell_id on ties.

    lines: page columns, line_id, text, box; cells: page columns, cell_id, box. A cell's lines stand from top to bottom,
    joined by a space; a cell without one has null text, and lines that touch no cell are left out.
    """
    other = cells.select(*page, "cell_id", F.col("box").alias("cell_box"))
    shared = intersection_area(F.col("box"), F.col("cell_box"))
    best = lines.join(other, page).where(shared > 0).groupBy(*page, "line_id", "text", "box").agg(F.min(F.struct((-shared).alias("k"), "cell_id"))["cell_id"].alias("cell_id"))
    held = best.groupBy(*page, "cell_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("box.y0", "box.x0", "line_id", "text"))), lambda x: x["text"]), " ").alias("text"))
    return cells.select(*page, "cell_id").join(held, [*page, "cell_id"], "left")


def parameter_grid(spark, values: dict[str, list]) -> DataFrame:
    """Every combination of the given values, one row each; as small as the product of the lists."""
    out = None
    for name, each in values.items():
        one = spark.createDataFrame([(v,) for v in each], [name])
        out = one if out is None else out.crossJoin(one)
    return out


def best_parameters(trials: DataFrame, table: list[str], parameters: list[str], score: str = "score", enough: float = 0.9, order: str | None = None) -> DataFrame:
    """(table, parameters, score): each table's best trial; with `order`, the first that is good enough, if one is.

    Ties go to the smaller parameters. Trials without a score count last.
    """
    tie = [F.col(p) for p in parameters]
    s = F.coalesce(F.col(score), F.lit(float("-inf")))
    rank = [F.when(s >= enough, F.col(order)).asc_nulls_last()] if order else []
    w = Window.partitionBy(*table).orderBy(*rank, s.desc(), *tie)
    return trials.withColumn("_k", F.row_number().over(w)).where("_k = 1").select(*table, *parameters, score)
