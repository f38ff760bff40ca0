"""Documents as a graph: sections below sections, vertices and edges with keys, and the folders they are kept in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .entities import PATTERNS
from .hierarchy import section_of

# Collections by the start of a key, in order.
COLLECTIONS = [
    (("doc_", "document_"), "documents"),
    (("page_",), "pages"),
    (("section_header_",), "sections"),
    (("text_", "code_", "table_", "equation_", "image_"), "content"),
]


def collection(key: Column) -> Column:
    """The collection that a key's prefix names; `blocks` for all others."""
    out = F.lit("blocks")
    for prefixes, name in reversed(COLLECTIONS):
        starts = F.lit(False)
        for p in prefixes:
            starts = starts | F.startswith(key, F.lit(p))
        out = F.when(starts, name).otherwise(out)
    return out


def block_key(block_type: Column, doc: Column, page: Column, order: Column) -> Column:
    """A key that no other block has: type, document, page and place."""
    kind = F.when(block_type == "SectionHeader", "section_header").otherwise(F.lower(F.regexp_replace(F.coalesce(block_type, F.lit("block")), r"(?<=[a-z])(?=[A-Z])", "_")))
    return F.concat_ws("_", kind, doc.cast("string"), page.cast("string"), order.cast("string"))


def section_tree(blocks: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """(doc, order, level, title, parent_ord, depth, n_children): the tree of a document's headers, one row a header.

    parent_ord is the last header before it with a smaller level; depth counts from 0 at headers without one.
    """
    heads = section_of(blocks.where("level is not null"), doc, order)
    rows = heads.select(*doc, order, "level", F.col("text").alias("title"), "parent_ord", F.size("path").alias("depth"))
    children = rows.where("parent_ord is not null").groupBy(*doc, F.col("parent_ord").alias(order)).agg(F.count("*").alias("n_children"))
    return rows.join(children, [*doc, order], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def subsections(blocks: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """(doc, order, level, title, subsections): for each header, the places of the headers one level below it in its section."""
    tree = section_tree(blocks, doc, order)
    below = tree.select(*doc, F.col("parent_ord").alias("_p"), F.col("level").alias("_l"), F.col(order).alias("_o"))
    heads = tree.select(*doc, order, "level", "title")
    own = heads.join(below.withColumnRenamed("_p", order), [*doc, order], "left")
    places = F.array_sort(F.collect_list(F.when(F.col("_l") == F.col("level") + 1, F.col("_o"))))
    return own.groupBy(*doc, order, "level", "title").agg(places.alias("subsections"))


def vertices(blocks: DataFrame, doc: str, page: str = "page_id", order: str = "block_ord") -> DataFrame:
    """(collection, key, doc, page, place, type, text) of documents, pages and blocks."""
    d, p = F.col(doc).cast("string"), F.col(page).cast("string")
    row = lambda df, key, pg, place, kind, text: df.select(collection(key).alias("collection"), key.alias("key"), d.alias("doc"), pg.alias("page"), place.alias("place"), kind.alias("type"), text.alias("text"))
    none = F.lit(None).cast("string")
    docs = row(blocks.select(doc).distinct(), F.concat(F.lit("doc_"), d), none, F.lit(None).cast("bigint"), F.lit("Document"), none)
    pages = row(blocks.select(doc, page).distinct(), F.concat_ws("_", F.lit("page"), d, p), p, F.lit(None).cast("bigint"), F.lit("Page"), none)
    own = row(blocks, block_key(F.col("block_type"), d, p, F.col(order)), p, F.col(order).cast("bigint"), F.col("block_type"), F.col("text"))
    return docs.unionByName(pages).unionByName(own)


def edges(blocks: DataFrame, doc: str, page: str = "page_id", order: str = "block_ord") -> DataFrame:
    """(type, src, dst, src_collection, dst_collection, key): documents contain pages, pages blocks, and sections what stands in them."""
    d, p = F.col(doc).cast("string"), F.col(page).cast("string")
    page_key = F.concat_ws("_", F.lit("page"), d, p)
    own = block_key(F.col("block_type"), d, p, F.col(order))
    pair = lambda df, a, b: df.select(a.alias("src"), b.alias("dst"))
    keyed = section_of(blocks, [doc], order).select(doc, order, "parent_ord", own.alias("key"))
    heads = blocks.where("level is not null").select(doc, F.col(order).alias("parent_ord"), own.alias("head"))
    found = (
        pair(blocks.select(doc, page).distinct(), F.concat(F.lit("doc_"), d), page_key).unionByName(pair(blocks, page_key, own))
        .unionByName(pair(keyed.join(heads, [doc, "parent_ord"]), F.col("head"), F.col("key")))
    )
    kind = F.lit("CONTAINS")
    return found.select(kind.alias("type"), "src", "dst", collection(F.col("src")).alias("src_collection"), collection(F.col("dst")).alias("dst_collection"), F.substring(F.sha2(F.concat_ws("|", "src", "dst", kind), 256), 1, 16).alias("key"))


def write_graph(vertices_: DataFrame, edges_: DataFrame, path: str) -> None:
    """Parquet folders vertices and edges under path, by collection and by type. Folders that are there are replaced."""
    vertices_.write.mode("overwrite").partitionBy("collection").parquet(f"{path}/vertices")
    edges_.write.mode("overwrite").partitionBy("type").parquet(f"{path}/edges")


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) as write_graph left them; a filter on collection or type reads only its folders."""
    return spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/edges")


_MARK, _OTHER = "￿", "￾"  # no pattern matches the first; where a text has it, the second stands in


def found_at(text: Column, pattern: str) -> Column:
    """array<struct<position, value>>: the matches of a pattern with the code points before each, leftmost first."""
    parts = F.split(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _MARK, _OTHER), pattern, f"{_MARK}$0{_MARK}"), _MARK)
    start = F.expr("struct(0 as at, false as hit, cast(array() as array<struct<position:int,value:string>>) as found)")

    def step(s: Column, part: Column) -> Column:
        return F.struct((s["at"] + F.length(part)).alias("at"), (~s["hit"]).alias("hit"), F.when(s["hit"], F.concat(s["found"], F.array(F.struct(s["at"].alias("position"), part.alias("value"))))).otherwise(s["found"]).alias("found"))

    return F.aggregate(parts, start, step, lambda s: s["found"])


def entity_key(kind: Column, value: Column) -> Column:
    return F.concat(F.lit("entity_"), F.substring(F.sha2(F.concat_ws("_", kind, value), 256), 1, 16))


def entity_mentions(blocks: DataFrame, doc: str, page: str = "page_id", order: str = "block_ord") -> DataFrame:
    """(doc, order, block, entity_type, value, entity, position): every mention in a block's text, with the keys of both."""
    d, p = F.col(doc).cast("string"), F.col(page).cast("string")
    typed = lambda kind: lambda m: F.struct(F.lit(kind).alias("entity_type"), m["value"].alias("value"), m["position"].alias("position"))
    found = F.concat(*[F.transform(found_at(F.col("text"), pattern), typed(kind)) for kind, pattern in PATTERNS.items()])
    each = blocks.select(doc, order, block_key(F.col("block_type"), d, p, F.col(order)).alias("block"), F.explode(found).alias("m"))
    return each.select(doc, order, "block", "m.entity_type", "m.value", entity_key(F.col("m.entity_type"), F.col("m.value")).alias("entity"), "m.position")


def reference_edges(mentions: DataFrame) -> DataFrame:
    """(type, src, dst, position): a block REFERENCES an entity, once for each mention."""
    return mentions.select(F.lit("REFERENCES").alias("type"), F.col("block").alias("src"), F.col("entity").alias("dst"), "position")


def related_entities(mentions: DataFrame) -> DataFrame:
    """(type, src, dst, weight): two entities of different types that a block mentions are RELATES_TO; weight counts such blocks.

    Pairs come from the distinct entities of one block, so a long document's entities don't all meet. src is the smaller key.
    """
    held = mentions.groupBy("block").agg(F.array_sort(F.collect_set(F.struct("entity", "entity_type"))).alias("e"))
    pairs = held.select(F.posexplode("e").alias("i", "a"), "e").select("a", F.explode(F.filter(F.slice("e", F.col("i") + 2, F.size("e")), lambda x: x["entity_type"] != F.col("a")["entity_type"])).alias("b"))
    return pairs.groupBy(F.col("a.entity").alias("src"), F.col("b.entity").alias("dst")).agg(F.count("*").alias("weight")).select(F.lit("RELATES_TO").alias("type"), "src", "dst", "weight")


def table_records(cells: DataFrame, blocks: DataFrame, doc: str, page: str = "page_id", order: str = "block_ord") -> DataFrame:
    """(key, block, n_rows, n_columns, headers) of Table blocks, from their cells (doc, order, row_id, col_id, is_header, text);
    the CONTAINS edge of each goes from block to key. Tables without cells have none of each and no header."""
    d, p = F.col(doc).cast("string"), F.col(page).cast("string")
    own = blocks.where("block_type = 'Table'").select(doc, order, block_key(F.col("block_type"), d, p, F.col(order)).alias("block"))
    first = F.transform(F.array_sort(F.collect_list(F.when(F.col("is_header") & (F.col("row_id") == 0), F.struct("col_id", "text")))), lambda c: c["text"])
    shape = cells.groupBy(doc, order).agg(F.count_distinct("row_id").alias("n_rows"), F.count_distinct("col_id").alias("n_columns"), first.alias("headers"))
    out = own.join(shape, [doc, order], "left").fillna(0, ["n_rows", "n_columns"])
    return out.select(F.concat(F.lit("table_"), F.substring(F.sha2("block", 256), 1, 16)).alias("key"), "block", "n_rows", "n_columns", F.coalesce("headers", F.array().cast("array<string>")).alias("headers"))


LABEL = r"\b(Table|Figure|Section|Equation) ([0-9]+(?:\.[0-9]+)*)"


def label_edges(blocks: DataFrame, doc: str, page: str = "page_id", order: str = "block_ord") -> DataFrame:
    """(type, src, dst, label, position): a block that names a label REFERS_TO the nearest block before it that bears it.

    A Caption bears the label it begins with; a SectionHeader that begins with a number bears that section's. One window
    over labels and mentions together, by document and label, finds the last bearer before each mention; a block's own
    label is none of its mentions, and a label that only comes later or never has no edge.
    """
    d, p = F.col(doc).cast("string"), F.col(page).cast("string")
    b = blocks.select(doc, F.col(order).cast("bigint").alias("_o"), "block_type", F.col("text").alias("_t"), block_key(F.col("block_type"), d, p, F.col(order)).alias("_key"))
    numbered = F.regexp_extract("_t", r"^([0-9]+(?:\.[0-9]+)*)", 1)
    own = F.when(F.col("block_type") == "Caption", F.nullif(F.regexp_extract("_t", f"^{LABEL}", 0), F.lit(""))).when((F.col("block_type") == "SectionHeader") & (numbered != ""), F.concat(F.lit("Section "), numbered))
    b = b.withColumn("_own", own)
    bearers = b.where("_own is not null").select(doc, F.col("_own").alias("label"), "_o", F.lit(1).alias("_kind"), "_key", F.lit(None).cast("int").alias("position"))
    named = b.select(doc, "_o", "_key", "_own", F.explode(found_at(F.col("_t"), LABEL)).alias("m")).where("not (m.position = 0 and m.value <=> _own)")
    named = named.select(doc, F.col("m.value").alias("label"), "_o", F.lit(0).alias("_kind"), "_key", "m.position")
    w = Window.partitionBy(doc, "label").orderBy("_o", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    target = F.last(F.when(F.col("_kind") == 1, F.col("_key")), ignorenulls=True).over(w)
    return bearers.unionByName(named).withColumn("_to", target).where("_kind = 0 and _to is not null").select(F.lit("REFERS_TO").alias("type"), F.col("_key").alias("src"), F.col("_to").alias("dst"), "label", "position")
