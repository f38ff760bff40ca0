"""A document's blocks as JSON: sections inside sections to any depth, in full or in short, and pages with adjacent blocks merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hierarchy import section_of

MERGED = ("Span", "Line", "Text")


def hierarchical_json(blocks: DataFrame, doc: list[str], order: str = "block_ord", compact: bool = False) -> DataFrame:
    """(doc, json): {"blocks": those before any header, "sections": [...]}, each section with its own blocks and subsections.

    blocks: document columns, order, block_type, level (of headers, else null), text, page_id. A section holds what comes
    until a header of its level or a higher one. In full a section has id, title, level, parent_id, page_range, blocks
    (type, text, page_id) and subsections; compact ones have id, title, level, block types and subsections. Headers are
    folded from the last to the first: each takes what stands open below it, so depth is not bounded and each header is
    touched once. A document's JSON is one text, so its blocks meet in one row.
    """
    owned = section_of(blocks, doc, order)
    shown = F.col("block_type") if compact else F.struct(F.col("block_type").alias("type"), "text", "page_id")
    own = owned.where("level is null").groupBy(*doc, F.col("parent_ord").alias("_s")).agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), shown.alias("b")))), lambda x: x["b"])).alias("_blocks"), F.max("page_id").alias("_last")
    )
    heads = owned.where("level is not null").select(*doc, F.col(order).cast("bigint").alias("o"), F.col("level").cast("int").alias("level"), F.col("text").alias("title"), "parent_ord", "page_id")
    heads = heads.join(own.withColumnRenamed("_s", "o"), [*doc, "o"], "left")
    pages = F.array("page_id", F.greatest("page_id", F.coalesce("_last", "page_id")))
    fields = F.struct(F.col("o").alias("id"), "title", "level") if compact else F.struct(F.col("o").alias("id"), "title", "level", F.col("parent_ord").alias("parent_id"), pages.alias("page_range"))
    start = F.concat(F.expr("substring({0}, 1, length({0}) - 1)".format("_f")), F.lit(',"blocks":'), F.coalesce("_blocks", F.lit("[]")), F.lit(',"subsections":['))
    heads = heads.withColumn("_f", F.to_json(fields)).select(*doc, F.struct((-F.col("o")).alias("back"), "level", start.alias("start")).alias("h"))
    fold = """aggregate(array_sort(collect_list(h)), cast(array() as array<struct<level:int,json:string>>),
      (s, h) -> concat(array(struct(h.level as level, concat(h.start, array_join(transform(filter(s, x -> x.level > h.level), x -> x.json), ','), ']}') as json)), filter(s, x -> x.level <= h.level)),
      s -> array_join(transform(s, x -> x.json), ','))"""
    sections = heads.groupBy(*doc).agg(F.expr(fold).alias("_sections"))
    first = own.where("_s is null").select(*doc, "_blocks")
    every = blocks.select(*doc).distinct().join(first, doc, "left").join(sections, doc, "left")
    return every.select(*doc, F.concat(F.lit('{"blocks":'), F.coalesce("_blocks", F.lit("[]")), F.lit(',"sections":['), F.coalesce("_sections", F.lit("")), F.lit("]}")).alias("json"))


def merged_blocks(blocks: DataFrame, page: list[str], order: str = "block_ord", types: tuple[str, ...] = MERGED) -> DataFrame:
    """(page columns, order, block_type, text, box, merged_count, merged_ids): runs of adjacent blocks of one of the types, merged.

    A block joins the one before it, with all that that has taken, if they share more than 0.6 of the smaller height and
    lie less than two such heights apart sideways, or else less than half of it apart vertically. Texts are joined by a space, boxes
    grow. A page's blocks are folded in order.
    """
    one = F.struct(F.col(order).alias("o"), F.col("block_type").alias("kind"), F.coalesce("text", F.lit("")).alias("t"), *[F.col(f"box.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")])
    kind = dict(blocks.dtypes)[order]
    item = f"struct<o:{kind},kind:string,t:string,x0:double,y0:double,x1:double,y1:double,ids:array<{kind}>>"
    low = "least(a.y1 - a.y0, b.y1 - b.y0)"
    beside = f"least(a.y1, b.y1) - greatest(a.y0, b.y0) > 0.6D * {low}"
    near = f"{low} > 0 and if({beside}, greatest(0D, b.x0 - a.x1) < 2 * {low}, greatest(0D, b.y0 - a.y1) < 0.5D * {low})"
    names = ", ".join(f"'{t}'" for t in types)
    joins = f"coalesce(a.kind = b.kind and b.kind in ({names}) and {near}, false)"
    both = "struct(a.o as o, a.kind as kind, trim(concat(a.t, ' ', b.t)) as t, least(a.x0, b.x0) as x0, least(a.y0, b.y0) as y0, greatest(a.x1, b.x1) as x1, greatest(a.y1, b.y1) as y1, concat(a.ids, array(b.o)) as ids)"
    alone = "struct(b.o as o, b.kind as kind, b.t as t, b.x0 as x0, b.y0 as y0, b.x1 as x1, b.y1 as y1, array(b.o) as ids)"
    # the state is a struct, so that an empty one can stand for the start
    step = f"if(size(s.out) > 0 and exists(slice(s.out, -1, 1), a -> {joins}), struct(concat(slice(s.out, 1, size(s.out) - 1), transform(slice(s.out, -1, 1), a -> {both})) as out), struct(concat(s.out, array({alone})) as out))"
    fold = f"aggregate(array_sort(collect_list(one)), struct(cast(array() as array<{item}>) as out), (s, b) -> {step}, s -> s.out)"
    runs = blocks.select(*page, one.alias("one")).groupBy(*page).agg(F.expr(fold).alias("_r")).select(*page, F.explode("_r").alias("r"))
    box = F.struct("r.x0", "r.y0", "r.x1", "r.y1")
    return runs.select(*page, F.col("r.o").alias(order), F.col("r.kind").alias("block_type"), F.col("r.t").alias("text"), box.alias("box"), F.size("r.ids").alias("merged_count"), F.col("r.ids").alias("merged_ids"))


def merged_json(blocks: DataFrame, doc: list[str], page: str = "page_id", order: str = "block_ord") -> DataFrame:
    """(doc, json): pages with their blocks as merged_blocks() gives them, and how many each page lost to merging."""
    m = merged_blocks(blocks, [*doc, page], order)
    b = F.struct(F.col(order).alias("id"), F.col("block_type").alias("type"), "text", F.array("box.x0", "box.y0", "box.x1", "box.y1").alias("bbox"), "merged_count", "merged_ids")
    pages = m.groupBy(*doc, page).agg(F.array_sort(F.collect_list(b), lambda x, y: (x["id"] - y["id"]).cast("int")).alias("blocks"), (F.sum("merged_count") - F.count("*")).alias("children_merged"))
    whole = pages.groupBy(*doc).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("page_id"), "children_merged", "blocks")), lambda x, y: (x["page_id"] - y["page_id"]).cast("int")).alias("pages"))
    return whole.select(*doc, F.to_json(F.struct("pages")).alias("json"))
