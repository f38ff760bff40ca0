"""Rewrites by a model that sees several lines or table rows at once, taken whole or left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .table_checks import html_cells


def rewrite_line_batches(lines: DataFrame, doc: list[str], select: Column, model: Callable[[Column], Column], order: str = "line_ord", size: int = 10, text: str = "text") -> DataFrame:
    """lines with the texts that select picks replaced by the model's, and failed set on the first line of a batch that wasn't taken.

    A document's picked lines go to the model in order, `size` at a time: it takes the array of their texts and gives
    another. An answer is taken for all lines of its batch or for none: it has a text for each, none null, in each of which math tags
    open as often as they close. Batches don't depend on each other. model: a pandas UDF around a service, or an expression.
    """
    picked = lines.where(F.coalesce(select, F.lit(False)))
    place = F.row_number().over(Window.partitionBy(*doc).orderBy(order)) - 1
    numbered = picked.select(*doc, F.col(order).alias("_o"), F.col(text).alias("_t"), F.floor(place / size).alias("_batch"))
    batches = numbered.groupBy(*doc, "_batch").agg(F.array_sort(F.collect_list(F.struct("_o", F.coalesce("_t", F.lit("")).alias("t")))).alias("_l"))
    answered = batches.withColumn("_new", model(F.transform("_l", lambda x: x["t"])))
    count = lambda t, tag: F.regexp_count(t, F.lit(tag))
    sound = (F.size("_new") == F.size("_l")) & F.forall("_new", lambda t: t.isNotNull() & (count(t, "<math") == count(t, "</math>")))
    taken = answered.withColumn("_ok", F.coalesce(sound, F.lit(False)))
    each = taken.select(*doc, "_ok", "_new", F.posexplode("_l").alias("_k", "x"))
    new = each.select(*doc, F.col("x._o").alias(order), F.when(F.col("_ok"), F.get("_new", F.col("_k"))).alias("_text"), "_ok", (~F.col("_ok") & (F.col("_k") == 0)).alias("_failed"))
    out = lines.join(new, [*doc, order], "left")
    return out.withColumns({text: F.when(F.col("_ok"), F.col("_text")).otherwise(F.col(text)), "failed": F.coalesce("_failed", F.lit(False))}).drop("_text", "_ok", "_failed")


def row_batches(cells: DataFrame, table: list[str], most: int = 60) -> DataFrame:
    """(table, row_id, batch): a table's rows in batches of at most `most`, which end where no span crosses; where a span leaves no such
    place, the batch goes on to the next one. cells: table columns, row_id, rowspan. A table's rows are folded in order."""
    down = F.greatest(F.lit(1), F.coalesce("rowspan", F.lit(1)))
    rows = cells.groupBy(*table, "row_id").agg(F.max(F.col("row_id") + down).cast("bigint").alias("_to"))
    above = F.max("_to").over(Window.partitionBy(*table).orderBy("row_id").rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("_clean", F.coalesce(above <= F.col("row_id"), F.lit(True)))
    w = Window.partitionBy(*table).orderBy("row_id")
    # rows between two clean places stay together; their sizes are what batches are filled with
    parts = marked.withColumn("_part", F.sum(F.col("_clean").cast("int")).over(w))
    sizes = parts.groupBy(*table, "_part").agg(F.count("*").cast("int").alias("n"))
    whole = sizes.groupBy(*table).agg(F.array_sort(F.collect_list(F.struct("_part", "n"))).alias("_p"))
    fold = f"""aggregate(_p, struct(0 as held, 0 as batch, cast(array() as array<struct<_part:bigint,batch:int>>) as out), (s, p) -> if(s.held > 0 and s.held + p.n > {int(most)},
      struct(p.n as held, s.batch + 1 as batch, concat(s.out, array(struct(p._part as _part, s.batch + 1 as batch))) as out),
      struct(s.held + p.n as held, s.batch as batch, concat(s.out, array(struct(p._part as _part, s.batch as batch))) as out)), s -> s.out)"""
    return parts.join(whole.select(*table, F.inline(F.expr(fold))), [*table, "_part"]).select(*table, "row_id", "batch")


def rewrite_table_batches(cells: DataFrame, table: list[str], model: Callable[[Column], Column], most: int = 60, most_rows: int = 175) -> DataFrame:
    """(table, row_id, col_id, text, rewritten): the cells of tables as a model gives them anew, or as they were.

    cells: table columns, row_id, col_id, text, rowspan, colspan, is_header. The model gets the HTML of a batch of rows (see row_batches) and
    gives HTML. A table is rewritten if all of its batches are sound: the answer ends with </table>, has more than one
    cell (or the one that the batch has) and at least half as much text as the batch; a table with an answer that says `no corrections`, or with more
    than most_rows rows, stays. The rows of the answers follow one another; col_id is a cell's place in its row.
    """
    escaped = F.replace(F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    tag = F.when(F.coalesce("is_header", F.lit(False)), "th").otherwise("td")
    span = lambda c: F.when(F.coalesce(c, F.lit(1)) > 1, F.concat(F.lit(f' {c}="'), F.col(c).cast("string"), F.lit('"'))).otherwise("")
    one = cells.select(*table, "row_id", F.length(F.coalesce("text", F.lit(""))).alias("_n"), F.struct("col_id", F.concat(F.lit("<"), tag, span("rowspan"), span("colspan"), F.lit(">"), escaped, F.lit("</"), tag, F.lit(">")).alias("h")).alias("_c"))
    joined = lambda c, f: F.array_join(F.transform(F.array_sort(F.collect_list(c)), f), "")
    rows = one.groupBy(*table, "row_id").agg(joined("_c", lambda c: c["h"]).alias("h"), F.sum("_n").alias("_n"), F.count("*").alias("_own")).join(row_batches(cells, table, most), [*table, "row_id"])
    batches = rows.groupBy(*table, "batch").agg(F.concat(F.lit("<table>"), joined(F.struct("row_id", "h"), lambda r: F.concat(F.lit("<tr>"), r["h"], F.lit("</tr>"))), F.lit("</table>")).alias("_old"), F.sum("_n").alias("_n"), F.sum("_own").alias("_own"), F.count("*").alias("_rows"))
    answer = F.trim(F.regexp_replace(F.trim("_raw"), r"^```(?:html)?|```$", ""))
    batches = batches.withColumn("_raw", model(F.col("_old"))).withColumn("html", answer)
    made = html_cells(batches, [*table, "batch"])
    shape = made.groupBy(*table, "batch").agg(F.count("*").alias("_cells"), F.sum(F.length("text")).alias("_text"), (F.max("row_id") + 1).alias("_tall"))
    judged = batches.join(shape, [*table, "batch"], "left")
    sound = F.endswith("html", F.lit("</table>")) & (F.col("_cells") >= F.least(F.lit(2), "_own")) & (2 * F.col("_text") >= F.col("_n")) & ~F.contains(F.lower("html"), F.lit("no corrections"))
    judged = judged.withColumn("_ok", F.coalesce(sound, F.lit(False)))
    every = Window.partitionBy(*table)
    judged = judged.withColumns({"_all": F.min("_ok").over(every) & (F.sum("_rows").over(every) <= most_rows), "_first": F.coalesce(F.sum("_tall").over(every.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    new = made.join(judged.where("_all").select(*table, "batch", "_first"), [*table, "batch"])
    new = new.select(*table, (F.col("row_id") + F.col("_first")).cast("bigint").alias("row_id"), F.col("ord").cast("bigint").alias("col_id"), "text", F.lit(True).alias("rewritten"))
    kept = cells.join(judged.where("_all").select(*table).distinct(), table, "left_anti").select(*table, F.col("row_id").cast("bigint"), F.col("col_id").cast("bigint"), "text", F.lit(False).alias("rewritten"))
    return new.unionByName(kept)
