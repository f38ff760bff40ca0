"""Sections, graphs and traversal over blocks in reading order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import fresh_folder, written

LEVELS = range(1, 7)
OWNING = range(7)  # a document's title is a header of level 0


def short_hash(*parts: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(F.concat(*parts), 256), 1, length)


def section_of(blocks: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """blocks with parent_ord, the order of the innermost open header before each block, and path, the titles down to it.

    blocks: document columns, order, level (0 to 6 for headers, else null), text. A header closes those of its level and
    deeper. One sort per document serves all levels: for each, the last header of it that no higher one has closed.
    """
    before = Window.partitionBy(*doc).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last: dict[int, Column] = {k: F.last(F.when(F.col("level") == k, F.struct(F.col(order).alias("ord"), F.col("text").alias("title"))), ignorenulls=True).over(before) for k in OWNING}
    out = blocks.withColumns({f"_h{k}": c for k, c in last.items()})

    def open_at(k: int) -> Column:
        inside = F.col("level").isNull() | (F.col("level") > k)
        higher = [F.col(f"_h{j}.ord") for j in OWNING if j < k]
        closed = F.coalesce(F.greatest(F.lit(None).cast("bigint"), *[h.cast("bigint") for h in higher]) > F.col(f"_h{k}.ord"), F.lit(False)) if higher else F.lit(False)
        return F.when(inside & ~closed, F.col(f"_h{k}"))

    opened = F.array_compact(F.array(*[open_at(k) for k in OWNING]))
    out = out.withColumn("_open", opened)
    return out.withColumns({"parent_ord": F.try_element_at("_open", F.lit(-1))["ord"], "path": F.transform("_open", lambda h: h["title"])}).drop("_open", *[f"_h{k}" for k in OWNING])


def number_sections(sections: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """Headers with number ("1.2.3"): each level counts since the last header of a higher level."""
    w = Window.partitionBy(*doc).orderBy(order)
    out = sections.withColumns({f"_g{k}": F.sum((F.col("level") < k).cast("int")).over(w) for k in LEVELS})
    for k in LEVELS:
        group = Window.partitionBy(*doc, f"_g{k}").orderBy(order)
        out = out.withColumn(f"_n{k}", F.sum((F.col("level") == k).cast("int")).over(group))
    parts = F.array(*[F.when((F.col("level") >= k) & (F.col(f"_n{k}") > 0), F.col(f"_n{k}").cast("string")) for k in LEVELS])
    return out.withColumn("number", F.array_join(F.array_compact(parts), ".")).drop(*[f"_{x}{k}" for x in "gn" for k in LEVELS])


def section_contents(blocks: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """One row for each header: its own text blocks joined by blank lines, their words, and a hash of title and content."""
    owned = section_of(blocks, doc, order)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("text").alias("t")))), lambda x: x["t"]), "\n\n")
    content = owned.where("level is null and parent_ord is not null").groupBy(*doc, F.col("parent_ord").alias(order)).agg(text.alias("content"))
    heads = blocks.where("level is not null").select(*doc, order, "level", F.col("text").alias("title"))
    out = heads.join(content, [*doc, order], "left").withColumn("content", F.coalesce("content", F.lit("")))
    words = F.size(F.filter(F.split("content", r"\s+"), lambda w: w != ""))
    return out.withColumns({"n_words": words, "reading_minutes": F.greatest(F.lit(1), F.floor(words / 200).cast("int")), "section_hash": short_hash(F.col("title"), F.col("content"))})


def containment_edges(blocks: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """contains edges (from innermost open header) and follows edges (from the block before), as src_ord and dst_ord."""
    owned = section_of(blocks, doc, order)
    w = Window.partitionBy(*doc).orderBy(order)
    contains = owned.where("parent_ord is not null").select(*doc, F.lit("contains").alias("type"), F.col("parent_ord").alias("src_ord"), F.col(order).alias("dst_ord"))
    follows = blocks.select(*doc, F.lit("follows").alias("type"), F.lag(order).over(w).cast("bigint").alias("src_ord"), F.col(order).alias("dst_ord")).where("src_ord is not null")
    return contains.unionByName(follows)


def header_levels(headers: DataFrame, doc: list[str], height: str = "height", kinds: int = 4) -> DataFrame:
    """headers with level by line height: taller kinds come first.

    Documents of `kinds` headers or fewer have level 2 throughout. Otherwise heights are parted at their largest gaps
    into at most `kinds` bands, the tallest being level 1; gaps under a quarter of the mean of heights don't part.
    """
    w = Window.partitionBy(*doc)
    down = w.orderBy(F.desc(height), F.desc("block_ord"))
    gap = F.lag(height).over(down) - F.col(height)
    out = headers.withColumns({"_n": F.count("*").over(w), "_mean": F.avg(height).over(w), "_gap": F.coalesce(gap, F.lit(0.0))})
    out = out.withColumn("_rank", F.row_number().over(w.orderBy(F.desc("_gap"), F.desc(height), F.desc("block_ord"))))
    parts = ((F.col("_rank") < kinds) & (F.col("_gap") > 0.25 * F.col("_mean"))).cast("int")
    return out.withColumn("level", F.when(F.col("_n") <= kinds, 2).otherwise(1 + F.sum(parts).over(down)).cast("int")).drop("_n", "_mean", "_gap", "_rank")


def keep_whole_edges(edges: DataFrame, vertices: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(edges with both ends among the vertices, the others)."""
    keys = vertices.select(key).distinct()
    mark = lambda end: keys.select(F.col(key).alias(end), F.lit(True).alias(f"_{end}"))
    marked = edges.join(mark("src"), "src", "left").join(mark("dst"), "dst", "left").withColumn("_whole", F.coalesce(F.col("_src") & F.col("_dst"), F.lit(False)))
    return marked.where("_whole").select(edges.columns), marked.where("not _whole").select(edges.columns)


def traverse(edges: DataFrame, roots: DataFrame, depth: int = 10) -> DataFrame:
    """(root, key, depth) of everything within `depth` edges below each root, each key at its least depth.

    Semi-naive rounds: the keys that the round before found first are joined with the edges, and what is seen already
    goes by an anti-join. Each round is written to the shared folder and read back, so no round is derived again, and the
    work is a scan of the edges and of what is seen for each level. Cycles end, as nothing new is found; so do the rounds.
    """
    spark, path = edges.sparkSession, fresh_folder(edges.sparkSession, "traversal")
    step = edges.select(F.col("src").alias("key"), "dst").distinct()
    shape = roots.select(F.col("key").alias("root"), "key").distinct()
    front, rounds = written(shape, f"{path}/0"), [f"{path}/0"]
    for k in range(1, depth + 1):
        seen = spark.read.schema(front.schema).parquet(*rounds)
        front = front.join(step, "key").select("root", F.col("dst").alias("key")).distinct().join(seen, ["root", "key"], "left_anti")
        front = written(front, f"{path}/{k}")
        if front.isEmpty():
            break
        rounds.append(f"{path}/{k}")
    levels = [spark.read.schema(front.schema).parquet(r).withColumn("depth", F.lit(k)) for k, r in enumerate(rounds)]
    return reduce(DataFrame.unionByName, levels)


def latest(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row written for each key."""
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def valid_id(collection: Column, key: Column) -> Column:
    """Why an id can't be used, or null: it must be collection/key, of at most 254 characters of the allowed set."""
    return (
        F.when(F.coalesce(key, F.lit("")) == "", "empty key").when(F.length(key) > 254, "key too long").when(~key.rlike(r"^[A-Za-z0-9_:.@()+,=;$!*'%-]+$"), "character not allowed")
        .when(~F.coalesce(collection, F.lit("")).rlike(r"^[A-Za-z][A-Za-z0-9_-]*$"), "bad collection")
    )
