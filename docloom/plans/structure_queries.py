"""Registered queries of lines, lists, table checks, graphs and searches over frames that the test tables are laid out as."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.stems import stems_sql, with_stems
from ..functions.storage import fresh_folder
from ..operators import batches, graph, json_forms, lines, markdown, table_checks, table_merge, text_index, vector_index
from ..sources import hub
from .queries import query, read

_SHARE = "greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0))"

# Lines: twelve to a block, three side by side to a row of text, some of them far too high.
_LINES = """select p_partkey // 12 as block, (p_partkey % 12)::int as line_ord, p_name as text, (p_partkey % 3 * 60 + p_partkey * 7 % 30)::double as x0, (p_partkey % 3 * 60 + p_partkey * 7 % 30 + 30 + p_size)::double as x1,
 (p_partkey % 12 // 3 * 9 + p_size % 3)::double as y0, (p_partkey % 12 // 3 * 9 + p_size % 3 + case when p_partkey % 50 = 0 then 900 else 10 end)::double as y1 from part"""


def text_lines(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    left, top = k % 3 * 60 + k * 7 % 30, F.floor(k % 12 / 3) * 9 + size % 3
    box = g.box(left, top, left + 30 + size, top + F.when(k % 50 == 0, 900).otherwise(10))
    return read(spark, sf_dir, "part").select(F.floor(k / 12).alias("block"), (k % 12).cast("int").alias("line_ord"), F.col("p_name").alias("text"), box.alias("box"))


_BOXED = "round(min(x0), 6) as x0, round(min(y0), 6) as y0, round(max(x1), 6) as x1, round(max(y1), 6) as y1, count(*) as n_lines"


def _lines_out(df):
    return df.select("*", *[F.round(f"box.{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")]).drop("box")


@query(f"""with recursive l as ({_LINES}), f as (select *, row_number() over (partition by block order by line_ord) as i from l where y1 - y0 < 5 * (x1 - x0)),
w as (select block, i, x0 - (x1 - x0) * 0.05 as x0, x1 + (x1 - x0) * 0.05 as x1, y0, y1 from f),
s as (select a.block, a.i, list(case when b.i = a.i or b.i = a.i + 1 then 0 else {_SHARE.format(a="a", b="b")} end order by b.i) as s from w a join w b using (block) group by all),
k as (select f.block, f.i, f.line_ord, f.x0, f.x1, f.y0, f.y1, s.s from f join s using (block, i)),
r as (select block, i, [i] as m, y0, y1, line_ord as head from k where i = 1
 union all select n.block, n.i, case when len(r.m) = 0 then [n.i] when n.joins then list_append(r.m, n.i) else [] end, case when len(r.m) = 0 then n.y0 else r.y0 end, case when len(r.m) = 0 then n.y1 else r.y1 end,
  case when len(r.m) > 0 and n.joins then r.head else n.line_ord end
 from r join lateral (select k.*, list_sum(list_transform(r.m, lambda j: k.s[j])) / greatest(1, (k.x1 - k.x0) * (k.y1 - k.y0)) >= 0.015 and greatest(0, least(r.y1, k.y1) - greatest(r.y0, k.y0)) / greatest(1, k.y1 - k.y0) > 0.8
   and list_sum(list_transform(r.m, lambda j: k.s[j])) / greatest(1, list_sum(k.s)) > 0.5 as joins from k where k.block = r.block and k.i = r.i + 1) n on true),
h as (select l.*, coalesce(r.head, l.line_ord) as head from l left join k using (block, line_ord) left join r on r.block = l.block and r.i = k.i)
select block, head as line_ord, string_agg(text, '' order by line_ord) as text, {_BOXED}, count(*) > 1 as math from h group by block, head""")
def broken_lines_merged(spark, sf_dir):
    """Pieces of one text line, merged in order."""
    return _lines_out(lines.merge_broken_lines(text_lines(spark, sf_dir), ["block"]))


# Detected lines: one for each row of text of a block, and one over two rows; every third is a formula.
_FOUND = """select block, (rank * 3 + kind)::int as found_id, case when kind = 0 then 0 else 40 end::double as x0, case when kind = 0 then 150 else 200 end::double as x1, (rank * 9 + case when kind = 2 then 0 else 1 end)::double as y0,
 (rank * 9 + case when kind = 2 then 20 else 9 end)::double as y1, (block + rank) % 3 = 0 as math from (select distinct p_partkey // 12 as block from part) b, (select unnest([0, 1, 2, 3]) as rank) r, (select unnest([0, 2]) as kind) k where (block + rank + kind) % 4 <> 1"""


def found_lines(spark, sf_dir):
    spots = F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(k).alias("kind")) for r in range(4) for k in (0, 2)])
    f = read(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 12).alias("block")).distinct().select("block", F.explode(spots).alias("s")).select("block", "s.*").where("(block + rank + kind) % 4 <> 1")
    wide, rank = F.col("kind") == 2, F.col("rank")
    box = g.box(F.when(wide, 40).otherwise(0), rank * 9 + F.when(wide, 0).otherwise(1), F.when(wide, 200).otherwise(150), rank * 9 + F.when(wide, 20).otherwise(9))
    return f.select("block", (rank * 3 + F.col("kind")).alias("found_id"), box.alias("box"), ((F.col("block") + rank) % 3 == 0).alias("math"))


@query(f"""with l as ({_LINES}), f as ({_FOUND}), p as (select l.block, l.line_ord, f.found_id, f.math, l.x0, l.y0, l.x1, l.y1, {_SHARE.format(a="l", b="f")} as s from l join f using (block) where l.y1 - l.y0 < 5 * (l.x1 - l.x0)),
b as (select * from p where s > 0 qualify row_number() over (partition by block, line_ord order by s desc, found_id) = 1), o as (select *, lag(y0) over w as py0, lag(y1) over w as py1 from b where s / greatest(1, (x1 - x0) * (y1 - y0)) > 0.3 window w as (partition by block, found_id order by line_ord)),
i as (select *, sum(coalesce(abs(y0 - py0) >= 8 and abs(y1 - py1) >= 8, false)::int) over (partition by block, found_id order by line_ord) as part from o),
h as (select block, line_ord, min(line_ord) over (partition by block, found_id, part) as head, math from i), j as (select l.*, coalesce(head, l.line_ord) as head, coalesce(math, false) as math from l left join h using (block, line_ord))
select block, head as line_ord, string_agg(text, '' order by line_ord) as text, {_BOXED}, count(*) > 1 or bool_or(math) as math from j group by block, head""")
def formula_lines_merged(spark, sf_dir):
    """Pieces of formula lines that a detector found, merged row by row."""
    return _lines_out(lines.merge_formula_lines(text_lines(spark, sf_dir), found_lines(spark, sf_dir), ["block"]))


# Lists: two to a page, in a left and a right column; a document has twenty, and some pages have a header or text between.
_GROUPS = """select o_orderkey // 20 as doc, o_orderkey as block_ord, case when o_orderkey % 7 = 3 then 'PageHeader' when o_orderkey % 11 = 5 then 'Text' else 'ListGroup' end as block_type, o_orderkey // 2 as page_id,
 (o_orderkey % 2 * 300 + 20)::double as x0, (o_custkey * 7 % 9 * 70)::double as y0, (o_custkey * 7 % 9 * 70 + 100)::double as y1 from orders"""


def list_groups(spark, sf_dir):
    k, y = F.col("o_orderkey"), F.col("o_custkey") * 7 % 9 * 70
    kind = F.when(k % 7 == 3, "PageHeader").when(k % 11 == 5, "Text").otherwise("ListGroup")
    return read(spark, sf_dir, "orders").select(F.floor(k / 20).alias("doc"), k.alias("block_ord"), kind.alias("block_type"), F.floor(k / 2).alias("page_id"), g.box(k % 2 * 300 + 20, y, k % 2 * 300 + 290, y + 100).alias("box"), F.lit(600.0).alias("page_width"), F.lit(700.0).alias("page_height"))


_LISTS = f"""with g as ({_GROUPS}), n as (select *, coalesce(lag(block_type) over w = 'ListGroup' and case when lag(page_id) over w = page_id then y0 <= lag(y1) over w else x0 < 300 and y0 < 350 end, false) as goes_on
 from g where block_type <> 'PageHeader' window w as (partition by doc order by block_ord)), c as (select *, last_value(case when not goes_on then block_ord end ignore nulls) over (partition by doc order by block_ord) as list_id from n)"""


@query(f"{_LISTS} select doc, block_ord, list_id from c where block_type = 'ListGroup'")
def lists_over_breaks(spark, sf_dir):
    """Lists that go on in the next column or page."""
    return lines.continued_lists(list_groups(spark, sf_dir), ["doc"]).select("doc", "block_ord", "list_id")


_ITEMS = f"""{_LISTS}, i as (select doc, list_id, block_ord * 10 + k as item, (o_custkey * (k + 3) % 5 * 12)::double as x from orders join c on o_orderkey = block_ord and block_type = 'ListGroup', (select unnest([0, 1, 2, 3]) as k) u)"""


@query(f"""{_ITEMS.replace("with g", "with recursive g", 1)}, k as (select *, row_number() over (partition by doc, list_id order by item) as i from i),
r as (select doc, list_id, i, item, [x] as open, 0 as level from k where i = 1 union all select k.doc, k.list_id, k.i, k.item, list_append(list_filter(r.open, lambda o: o + 6 < k.x), k.x), len(list_filter(r.open, lambda o: o + 6 < k.x))::int
 from r join k on k.doc = r.doc and k.list_id = r.list_id and k.i = r.i + 1) select doc, list_id, item, level from r""")
def list_levels_over_breaks(spark, sf_dir):
    """Nesting of the items of lists that go on over columns and pages."""
    lists = lines.continued_lists(list_groups(spark, sf_dir), ["doc"])
    i = read(spark, sf_dir, "orders").join(lists, F.col("o_orderkey") == F.col("block_ord")).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    i = i.select("doc", "list_id", (F.col("block_ord") * 10 + F.col("k")).alias("item"), (F.col("box.x0") + F.col("o_custkey") * (F.col("k") + 3) % 5 * 12).alias("x0"), F.col("box.x0").alias("column_x0"), "page_width")
    return lines.nested_levels(i, ["doc", "list_id"], "item")


# HTML tables: twelve parts each, in four rows; some cells span rows or columns, some rows lack a cell, every ninth text has no table.
_SPANNED = """select p_partkey // 12 as t, (p_partkey % 12 // 3)::int as r, (p_partkey % 3)::int as o, case when p_size % 4 = 0 then 2 else 1 end as d, case when p_partkey * 7 % 11 < 2 then 2 else 1 end as a, p_partkey % 12 < 3 and p_partkey % 24 < 12 as h
 from part where p_partkey % 31 <> 5 and (p_partkey // 12) % 9 <> 4"""


def html_tables(spark, sf_dir):
    k = F.col("p_partkey")
    tag = F.when((k % 12 < 3) & (k % 24 < 12), "th").otherwise("td")
    span = F.concat(F.when(F.col("p_size") % 4 == 0, ' rowspan="2"').otherwise(""), F.when(k * 7 % 11 < 2, " colspan=2").otherwise(""))
    cell = F.concat(F.lit("<"), tag, span, F.lit(">"), F.lit("<b>"), "p_name", F.lit("</b></"), tag, F.lit(">"))
    p = read(spark, sf_dir, "part").select(F.floor(k / 12).alias("t"), F.floor(k % 12 / 3).alias("r"), F.struct(k.alias("k"), F.when(k % 31 != 5, cell).otherwise("").alias("c")).alias("c"))
    joined = lambda col, f: F.array_join(F.transform(F.array_sort(F.collect_list(col)), f), "")
    rows = p.groupBy("t", "r").agg(joined("c", lambda c: c["c"]).alias("h")).withColumn("row", F.struct("r", "h"))
    body = rows.groupBy("t").agg(joined("row", lambda r: F.when(r["h"] != "", F.concat(F.lit("<tr>"), r["h"], F.lit("</tr>\n"))).otherwise("")).alias("h"))
    return body.select("t", F.when(F.col("t") % 9 == 4, "<p>no grid</p>").otherwise(F.concat(F.lit("<div><TABLE class='x'>"), "h", F.lit("</TABLE></div>"))).alias("html"))


@query(f"""with recursive c0 as ({_SPANNED}), c as (select t, (dense_rank() over (partition by t order by r) - 1)::int as r, o, d, a, h from c0), n as (select *, max(r) over (partition by t) as last, row_number() over (partition by t order by r, o) as i from c), m as (select *, least(d, last - r + 1) as dd from n),
p as (select t, i, r, 0 as c, a, dd, a as nxt, list_transform(range(case when dd > 1 then a else 0 end), lambda k: {{'c': k::int, 'u': r + dd - 1}}) as open from m where i = 1
 union all select q.t, q.i, q.r, q.at, q.a, q.dd, q.at + q.a, list_concat(list_filter(q.open, lambda x: x.u >= q.r), list_transform(range(case when q.dd > 1 then q.a else 0 end), lambda k: {{'c': (q.at + k)::int, 'u': q.r + q.dd - 1}}))
 from (select m.t, m.i, m.r, m.a, m.dd, p.open, list_min(list_filter(range(case when p.r = m.r then p.nxt else 0 end, 40), lambda k: not list_contains(list_transform(list_filter(p.open, lambda x: x.u >= m.r), lambda x: x.c), k::int)))::int as at from p join m on m.t = p.t and m.i = p.i + 1) q),
s as (select t, y, x, count(*) as n from (select t, unnest(range(r, r + dd)) as y, c, a from p) v, lateral (select unnest(range(c, c + a)) as x) u group by all),
f as (select t, (max(x) + 1)::int as width, count(*) filter (n > 1) as n_overlaps, (max(x) + 1) * (max(y) + 1) - count(*) as n_holes from s group by 1),
w as (select t, r, count(*) as n, bool_or(h) as h from c group by all), z as (select t, count(*) as n_rows, arg_min(n, r) as n_cols, bool_or(h) as has_header, min(n) <> max(n) as uneven from w group by 1),
e as (select distinct p_partkey // 12 as t from part), j as (select e.t, n_rows, n_cols, has_header, width, n_overlaps, n_holes, list_filter([case when n_rows is null then 'no table' end, case when n_rows < 4 then 'too few rows' end, case when n_cols > 3 then 'too many columns' end,
 case when not has_header then 'no header' end, case when uneven then 'rows of unequal length' end, case when n_overlaps > 0 then 'cells overlap' end, case when n_holes > 0 then 'places without a cell' end], lambda x: x is not null) as ps from e left join z using (t) left join f using (t))
select t, n_rows, n_cols, has_header, width, n_overlaps, n_holes::bigint as n_holes, array_to_string(ps, '; ') as problems, len(ps) = 0 as valid from j""")
def html_table_checks(spark, sf_dir):
    """What is wrong with tables given as HTML: counts, header, row lengths, and the grid that spans make."""
    t = html_tables(spark, sf_dir)
    checked = table_checks.check_tables(t, table_checks.html_cells(t, ["t"]), ["t"], min_rows=4, max_cols=3, need_header=True)
    return checked.select("t", "n_rows", "n_cols", "has_header", "width", "n_overlaps", F.col("n_holes").cast("bigint").alias("n_holes"), F.array_join("problems", "; ").alias("problems"), "valid")


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z]+')"
_WORD_LIST = f"select distinct unnest({_WORDS}) as word from documents"


@query(f"with s as ({stems_sql(_WORD_LIST)}) select stem, count(*) as n_words, min(word) as first, max(word) as last from s group by 1")
def english_stems(spark, sf_dir):
    """The words of each stem."""
    words = text_index.tokens(read(spark, sf_dir, "documents"), "doc_id").select("word").distinct()
    return with_stems(words).groupBy("stem").agg(F.count("*").alias("n_words"), F.min("word").alias("first"), F.max("word").alias("last"))


@query(f"""with d as (select doc_id, unnest(range(len(w))) as pos, unnest(w) as word from (select doc_id, {_WORDS} as w from documents)), i as (select item_id, unnest(range(len(w))) as pos, unnest(w) as word from (select item_id, ({_WORDS})[1:3] as w from benchmark)),
s as ({stems_sql("select distinct word from (select word from d union all select word from i)")}), dp as (select doc_id, pos, stem from d join s using (word)), ip as (select item_id, pos, stem from i join s using (word)),
n as (select item_id, count(distinct stem) as n_stems, count(*) as length from ip group by 1), j as (select item_id, doc_id, ip.pos as ipos, dp.pos as dpos, stem from ip join dp using (stem)),
a as (select item_id, doc_id, count(distinct stem) as found, count(distinct (stem, dpos)) as n_hits from j group by all), p as (select item_id, doc_id, max(k) as most from (select item_id, doc_id, dpos - ipos as start, count(*) as k from j group by all) group by all)
select item_id, doc_id, n_hits, most = length as phrase from a join n using (item_id) join p using (item_id, doc_id) where found = n_stems""")
def stemmed_search(spark, sf_dir):
    """Documents that have all of the first three words of a benchmark item, as stems, from a written index."""
    docs, path = read(spark, sf_dir, "documents"), fresh_folder(spark, "stems")
    text_index.write_index(docs, path)
    items = read(spark, sf_dir, "benchmark")
    first = F.array_join(F.slice(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z]+"), 0), 1, 3), " ")
    return text_index.search(text_index.read_index(spark, path), items.select("item_id", first.alias("text")), query="item_id")


@query("""with s as (select q.vec_id as q_id, v.vec_id, list_cosine_similarity(q.embedding::double[], v.embedding::double[]) as c from embeddings q, embeddings v where q.vec_id % 50 = 0 and v.vec_id <> q.vec_id)
select q_id, vec_id, (row_number() over (partition by q_id order by round(c, 9) desc, vec_id))::int as rank, round(c, 6) as cosine from s qualify rank <= 8""")
def vector_index_topk(spark, sf_dir):
    """The nearest vectors of every fiftieth, from a written index of lists."""
    v, path = vector_index.usable(read(spark, sf_dir, "embeddings")).select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), fresh_folder(spark, "vectors")
    vector_index.write_index(v, path, lists=16)
    found, _ = vector_index.search(spark, path, v.where("id % 50 = 0").select(F.col("id").alias("q_id"), "v"), 8)
    return found.select("q_id", F.col("id").alias("vec_id"), "rank", F.round("c", 6).alias("cosine"))


# Blocks with something to point at: captions and headers with labels, texts that name labels, people, places, addresses and dates.
_POINTING = """select p_partkey // 100 as doc, p_partkey // 20 as page_id, p_partkey as block_ord, case p_partkey % 5 when 0 then 'Caption' when 1 then 'Table' when 2 then 'SectionHeader' else 'Text' end as block_type,
 case p_partkey % 5 when 0 then case when p_partkey % 2 = 0 then 'Table ' else 'Figure ' end || (p_partkey // 10 % 4) || ': ' || p_name when 1 then p_name when 2 then (p_partkey // 10 % 3) || '.' || (p_partkey % 4) || ' ' || p_name
 when 3 then 'See Table ' || (p_size % 5) || ', Section ' || (p_size % 3) || '.' || (p_partkey % 4) || ' and Figure ' || (p_partkey * 7 % 4) || ' by Ann Lee of Paris'
 else 'Write to x' || (p_size % 7) || '@example.com or Bob Ray, Salt City, before 1/' || (p_size % 9 + 1) || '/2020' end as text from part"""


def pointing_blocks(spark, sf_dir):
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey div 100 as doc", "p_partkey div 20 as page_id", "p_partkey as block_ord", "case p_partkey % 5 when 0 then 'Caption' when 1 then 'Table' when 2 then 'SectionHeader' else 'Text' end as block_type",
        "case p_partkey % 5 when 0 then concat(if(p_partkey % 2 = 0, 'Table ', 'Figure '), p_partkey div 10 % 4, ': ', p_name) when 1 then p_name when 2 then concat(p_partkey div 10 % 3, '.', p_partkey % 4, ' ', p_name) "
        "when 3 then concat('See Table ', p_size % 5, ', Section ', p_size % 3, '.', p_partkey % 4, ' and Figure ', p_partkey * 7 % 4, ' by Ann Lee of Paris') "
        "else concat('Write to x', p_size % 7, '@example.com or Bob Ray, Salt City, before 1/', p_size % 9 + 1, '/2020') end as text",
    )


def _found(pattern, rows, group=0):
    """SQL for the matches of a pattern in t, with the characters before each."""
    return f"""select * exclude (m, s), unnest(m) as value, unnest(list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)))::int as position
 from (select *, regexp_extract_all(text, '{pattern}') as m, regexp_split_to_array(text, '{pattern}') as s from ({rows}))"""


_KEYED = f"select *, case block_type when 'SectionHeader' then 'section_header' else lower(block_type) end || '_' || doc || '_' || page_id || '_' || block_ord as block from ({_POINTING})"
_MENTIONS = " union all ".join(f"select '{kind}' as entity_type, * from ({_found(pattern.removeprefix('(?U)'), _KEYED)})" for kind, pattern in graph.PATTERNS.items())


@query(f"select 'REFERENCES' as type, block as src, 'entity_' || substr(sha256(entity_type || '_' || value), 1, 16) as dst, position from ({_MENTIONS})")
def reference_edges(spark, sf_dir):
    """From blocks to the entities that they mention, with the place of each mention."""
    return graph.reference_edges(graph.entity_mentions(pointing_blocks(spark, sf_dir), "doc"))


@query(f"""with m as (select distinct block, entity_type, 'entity_' || substr(sha256(entity_type || '_' || value), 1, 16) as entity from ({_MENTIONS}))
select 'RELATES_TO' as type, a.entity as src, b.entity as dst, count(*) as weight from m a join m b on a.block = b.block and a.entity < b.entity and a.entity_type <> b.entity_type group by all""")
def related_entity_edges(spark, sf_dir):
    """Between entities of different types that stand in one block."""
    return graph.related_entities(graph.entity_mentions(pointing_blocks(spark, sf_dir), "doc"))


@query(f"""with k as ({_KEYED}), t as (select block, block_ord, doc from k where block_type = 'Table'), c as (select p_partkey // 5 * 5 + 1 as o, p_partkey % 5 as r, p_name, p_brand from part where p_partkey % 5 <> 1)
select 'CONTAINS' as type, block as src, 'table_' || substr(sha256(block), 1, 16) as dst, count(distinct r) as n_rows, case when count(r) > 0 then 2 else 0 end::bigint as n_columns, coalesce(string_agg(p_name || '|' || p_brand) filter (r = 0), '') as headers from t left join c on o = block_ord group by block""")
def table_edges(spark, sf_dir):
    """From blocks to the tables in them."""
    k = F.col("p_partkey")
    cells = read(spark, sf_dir, "part").where(k % 5 != 1).select(F.floor(k / 100).alias("doc"), (F.floor(k / 5) * 5 + 1).alias("block_ord"), (k % 5).alias("row_id"), (k % 5 == 0).alias("is_header"), F.posexplode(F.array("p_name", "p_brand")).alias("col_id", "text"))
    t = graph.table_records(cells, pointing_blocks(spark, sf_dir), "doc")
    return t.select(F.lit("CONTAINS").alias("type"), F.col("block").alias("src"), F.col("key").alias("dst"), "n_rows", "n_columns", F.array_join("headers", "|").alias("headers"))


_LABEL_SQL = r"\b(Table|Figure|Section|Equation) ([0-9]+(?:\.[0-9]+)*)"


@query(f"""with b as (select *, case when block_type = 'Caption' then nullif(regexp_extract(text, '^{_LABEL_SQL}', 0), '') when block_type = 'SectionHeader' then 'Section ' || nullif(regexp_extract(text, '^([0-9]+([.][0-9]+)*)', 1), '') end as own from ({_KEYED})),
n as (select doc, block_ord, block, own, value as label, position from ({_found(_LABEL_SQL, "select * from b")}) where not (position = 0 and value is not distinct from own))
select 'REFERS_TO' as type, n.block as src, arg_max(b.block, b.block_ord) as dst, label, position from n join b on b.doc = n.doc and b.own = n.label and b.block_ord < n.block_ord group by n.block, label, position""")
def label_edges(spark, sf_dir):
    """From blocks to the nearest earlier table, figure or section that they name."""
    return graph.label_edges(pointing_blocks(spark, sf_dir), "doc")


# Tables: every third part, forty parts to a document, ten to a page; two or three columns; first columns count on or not.
_TABLES = """select p_partkey // 40 as doc, p_partkey as table_ord, p_partkey // 10 as page_id, 2 + (p_size % 2) as n_columns, (p_partkey * 3)::varchar as first_cell, case when p_size % 3 = 0 then 'total' else (p_partkey * 3 + 8)::varchar end as last_cell,
 40.0 as x0, (p_partkey % 10 * 70)::double as y0, 560.0 as x1, (p_partkey % 10 * 70 + 60 + p_size * 3)::double as y1 from part where p_partkey % 3 = 0"""


def document_tables(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    last = F.when(s % 3 == 0, "total").otherwise((k * 3 + 8).cast("string"))
    return read(spark, sf_dir, "part").where(k % 3 == 0).select(F.floor(k / 40).alias("doc"), k.alias("table_ord"), F.floor(k / 10).alias("page_id"), F.lit(700.0).alias("page_height"), (2 + s % 2).alias("n_columns"), (k * 3).cast("string").alias("first_cell"), last.alias("last_cell"), g.box(F.lit(40), k % 10 * 70, F.lit(560), k % 10 * 70 + 60 + s * 3).alias("box"))


_NEIGHBOURS = f"""with t as ({_TABLES}), n as (select doc, table_ord as a, lead(table_ord) over w as b, lead(page_id) over w = page_id as same_page, lead(page_id) over w = page_id + 1 as over, lead(n_columns) over w = n_columns as columns_match,
 greatest(0, lead(y0) over w - y1, y0 - lead(y1) over w) < 35 as near, coalesce(try_cast(lead(first_cell) over w as bigint) = try_cast(last_cell as bigint) + 1, false) as continues from t window w as (partition by doc order by table_ord)),
p as (select *, not same_page or near as adjacent from n where b is not null and (same_page or over)), s as (select *, 5 + 3 * columns_match::int + adjacent::int + continues::int as k from p),
c as (select doc, a, b, same_page, columns_match, adjacent, continues, k / 10 as confidence, case when same_page then k > 7 else k > 8 end as candidate from s)"""


@query(f"{_NEIGHBOURS} select *, candidate and columns_match as merge from c")
def table_neighbours(spark, sf_dir):
    """Neighbouring tables, how sure it is that they are one, and whether they merge."""
    return table_merge.neighbour_pairs(document_tables(spark, sf_dir), ["doc"])


@query(f"{_NEIGHBOURS}, x as (select t.doc, t.table_ord, c.b is null as first from t left join (select * from c where candidate and columns_match) c on c.doc = t.doc and c.b = t.table_ord) select doc, table_ord, last_value(case when first then table_ord end ignore nulls) over (partition by doc order by table_ord) as chain from x")
def table_merge_chains(spark, sf_dir):
    """Tables that merge one into the next, by the first of them."""
    t = document_tables(spark, sf_dir)
    return table_merge.merge_chains(t, table_merge.neighbour_pairs(t, ["doc"]), ["doc"]).select("doc", "table_ord", "chain")


# Blocks around tables: headers, texts that tell of data or don't, captions before or after, and tables side by side.
_AROUND = """select p_partkey // 60 as doc, p_partkey as block_ord, case when p_partkey % 6 in (2, 3) then 'Table' when p_partkey % 12 = 0 then 'SectionHeader' when p_partkey % 6 = 4 and p_size % 2 = 0 then 'Caption' else 'Text' end as block_type,
 case when p_partkey % 6 in (2, 3) then '' when p_partkey % 12 = 0 then case when p_size % 5 = 0 then 'Exhibit of ' || p_name else p_name end when p_partkey % 6 = 4 and p_size % 2 = 0 then case when p_size % 4 = 0 then 'Table of ' else 'On ' end || p_name
 when p_size % 3 = 0 then 'First words. The Results of ' || p_name || ' and of some others that go on for quite a while, to fill the line. More' else ' ' || p_name || ' stands alone. ' end as text from part"""


@query(f"""with b as ({_AROUND}), n as (select *, coalesce(last_value(case when block_type <> 'Table' then text end ignore nulls) over before, '') as above, coalesce(first_value(case when block_type <> 'Table' then text end ignore nulls) over after, '') as below,
 trim(coalesce(last_value(case when block_type = 'SectionHeader' then text end ignore nulls) over before, '')) as head, coalesce(last_value(case when block_type = 'Text' then text end ignore nulls) over before, '') as para
 from b window before as (partition by doc order by block_ord rows between unbounded preceding and 1 preceding), after as (partition by doc order by block_ord rows between 1 following and unbounded following)),
m as (select *, regexp_matches(lower(above), 'table|exhibit|figure') and length(trim(above)) < 200 as a, regexp_matches(lower(below), 'table|exhibit|figure') and length(trim(below)) < 200 as z, regexp_matches(lower(head), 'table|exhibit|figure') and length(head) < 200 as h,
 trim(coalesce(list_filter(string_split(para, '.'), lambda s: regexp_matches(lower(s), 'data|results|statistics|analysis|comparison|summary|breakdown|distribution|metrics|performance'))[1], '')) as s from n where block_type = 'Table')
select doc, block_ord, case when a then trim(above) when z then trim(below) when h then head when s <> '' then 'Inferred: ' || case when length(s) > 80 then s[1:77] || '...' else s end when head <> '' and length(head) < 100 then 'Inferred: ' || case when length(head) > 80 then head[1:77] || '...' else head end end as title,
 case when a then 'caption_above' when z then 'caption_below' when h then 'section_header' when s <> '' then 'inferred_from_preceding_paragraph' when head <> '' and length(head) < 100 then 'inferred_from_section_header' else 'none' end as source,
 not coalesce(a or z or h, false) and (s <> '' or (head <> '' and length(head) < 100)) as inferred from m""")
def table_titles(spark, sf_dir):
    """The title of every table, from what stands around it."""
    b = read(spark, sf_dir, "part").selectExpr(
        "p_partkey div 60 as doc", "p_partkey as block_ord", "case when p_partkey % 6 in (2, 3) then 'Table' when p_partkey % 12 = 0 then 'SectionHeader' when p_partkey % 6 = 4 and p_size % 2 = 0 then 'Caption' else 'Text' end as block_type",
        "case when p_partkey % 6 in (2, 3) then '' when p_partkey % 12 = 0 then if(p_size % 5 = 0, concat('Exhibit of ', p_name), p_name) when p_partkey % 6 = 4 and p_size % 2 = 0 then concat(if(p_size % 4 = 0, 'Table of ', 'On '), p_name) "
        "when p_size % 3 = 0 then concat('First words. The Results of ', p_name, ' and of some others that go on for quite a while, to fill the line. More') else concat(' ', p_name, ' stands alone. ') end as text",
    )
    return table_merge.table_titles(b, ["doc"])


@query(f"""with l as ({_LINES}), p as (select *, (row_number() over (partition by block order by line_ord) - 1) // 4 as batch from l where line_ord % 6 <> 2), b as (select block, batch, bool_or(text like '%green%') as bad, min(line_ord) as first from p group by all)
select l.block, l.line_ord, case when b.bad = false then upper(l.text) else l.text end as text, coalesce(b.bad and b.first = l.line_ord, false) as failed from l left join p on p.block = l.block and p.line_ord = l.line_ord left join b on b.block = p.block and b.batch = p.batch""")
def line_batches_rewritten(spark, sf_dir):
    """Lines that a model rewrites four at a time, all or none of a batch; here it loses a line of some batches."""
    model = lambda t: F.when(F.exists(t, lambda x: x.contains("green")), F.slice(t, 2, 9)).otherwise(F.transform(t, F.upper))
    out = batches.rewrite_line_batches(text_lines(spark, sf_dir).select("block", "line_ord", "text"), ["block"], F.col("line_ord") % 6 != 2, model, size=4)
    return out.select("block", "line_ord", "text", "failed")


@query("""with recursive c as (select p_partkey // 40 as t, p_partkey % 40 as r, p_name as text, case when p_size % 9 = 0 then 1 + p_size % 4 else 1 end as d from part), m as (select *, coalesce(max(r + d) over (partition by t order by r rows between unbounded preceding and 1 preceding) <= r, true) as clean from c),
g as (select t, r, sum(clean::int) over (partition by t order by r) as part from m), n as (select t, part, count(*) as n from g group by all),
b as (select t, part, n as held, 0 as batch from n where part = 1 union all select n.t, n.part, case when b.held + n.n > 10 then n.n else b.held + n.n end, b.batch + (b.held + n.n > 10)::int from b join n on n.t = b.t and n.part = b.part + 1),
x as (select c.t, c.r, c.text, b.batch from c join g using (t, r) join b using (t, part)), j as (select t, bool_and(texts not like '%tiny%tiny%tiny%' and texts not like '%blue%') as ok from (select t, batch, string_agg(text, '' order by r) as texts from x group by all) group by t)
select t, r as row_id, 0::bigint as col_id, case when ok then upper(text) else text end as text, ok as rewritten from x join j using (t)""")
def table_batches_rewritten(spark, sf_dir):
    """Tables that a model rewrites ten rows at a time, without cutting a span; here it cuts some answers short."""
    k = F.col("p_partkey")
    cells = read(spark, sf_dir, "part").select(F.floor(k / 40).alias("t"), (k % 40).alias("row_id"), F.lit(0).alias("col_id"), F.col("p_name").alias("text"), F.when(F.col("p_size") % 9 == 0, 1 + F.col("p_size") % 4).otherwise(1).alias("rowspan"), F.lit(1).alias("colspan"), F.lit(False).alias("is_header"))
    upper = lambda h: F.replace(F.replace(F.replace(F.replace(F.upper(h), F.lit("TABLE"), F.lit("table")), F.lit("TR>"), F.lit("tr>")), F.lit("TD"), F.lit("td")), F.lit("ROWSPAN"), F.lit("rowspan"))
    model = lambda h: F.when(h.rlike("tiny.*tiny.*tiny|blue"), F.concat(F.lit("```html"), F.replace(upper(h), F.lit("</table>"), F.lit("")))).otherwise(F.concat(F.lit("```html"), upper(h), F.lit("```")))
    return batches.rewrite_table_batches(cells, ["t"], model, most=10)


def _sectioned(spark, sf_dir):
    level = F.expr("case when p_partkey % 7 = 0 then 1 + p_size % 5 end")
    return text_lines(spark, sf_dir).join(read(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 12).alias("block"), (F.col("p_partkey") % 12).cast("int").alias("line_ord"), level.alias("level")), ["block", "line_ord"]).select(
        F.floor(F.col("block") / 5).alias("doc"), (F.col("block") * 12 + F.col("line_ord")).alias("block_ord"), F.col("block").alias("page_id"), F.when(F.col("level").isNotNull(), "SectionHeader").when(F.col("line_ord") % 5 == 4, "Table").otherwise("Text").alias("block_type"), "text", "level", "box",
    )


@query()
def hierarchical_json(spark, sf_dir):
    """Documents as sections inside sections."""
    return json_forms.hierarchical_json(_sectioned(spark, sf_dir), ["doc"])


@query()
def merged_json(spark, sf_dir):
    """Documents as pages of merged blocks."""
    return json_forms.merged_json(_sectioned(spark, sf_dir), ["doc"])


@query("""select (p_partkey // 100)::varchar as doc_id, (p_partkey % 100 // 10)::int as page_num, (p_partkey % 100 // 10) * 1000000 + p_partkey % 10 as block_ord, case when p_partkey % 9 = 0 then 'SectionHeader' else 'Text' end as block_type,
 case when p_partkey % 13 = 0 then null else p_name || chr(10) || '"' || p_brand || '"' end as text, case when p_partkey % 9 = 0 then 1 + p_size % 3 end::int as level, null::varchar as language from part""")
def interchange_round_trip(spark, sf_dir):
    """Blocks written as interchange JSON and read back."""
    k, path = F.col("p_partkey"), fresh_folder(spark, "interchange")
    b = read(spark, sf_dir, "part").select(
        F.floor(k / 100).cast("string").alias("doc_id"), F.floor(k % 100 / 10).cast("int").alias("page_num"), k.alias("block_ord"), F.when(k % 9 == 0, "SectionHeader").otherwise("Text").alias("block_type"),
        F.when(k % 13 != 0, F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('"'))).alias("text"), F.when(k % 9 == 0, 1 + F.col("p_size") % 3).cast("int").alias("level"), F.lit(None).cast("string").alias("language"),
    )
    hub.to_hub(b).write.json(path)
    return hub.hub_blocks(hub.read_hub(spark, path, lines=True))


@query("""with l as (select p_partkey // 30 as doc_id, p_partkey % 30 as n, case when p_partkey % 17 = 0 then '' when p_partkey % 6 = 0 then repeat('#', 1 + p_size % 3) || ' ' || p_name when p_partkey % 10 = 1 then '**' || p_name || '**' else p_name || ' ' || p_brand end as line,
 case when p_partkey % 17 = 0 then null when p_partkey % 6 = 0 then 1 + p_size % 3 when p_partkey % 10 = 1 then 2 end as level, p_name from part),
s as (select *, last_value(case when level is not null then n end ignore nulls) over (partition by doc_id order by n) as head from l where line <> ''),
h as (select doc_id, n as head, level, p_name as title from s where level is not null), c as (select doc_id, head, string_agg(line, chr(10) || chr(10) order by n) as content, sum(len(string_split(line, ' ')))::int as n_words from s where level is null and head is not null group by all)
select doc_id, level::int as level, title, coalesce(content, '') as content, coalesce(n_words, 0) as n_words, substr(sha256(title || coalesce(content, '')), 1, 16) as section_hash from h left join c using (doc_id, head)""")
def markdown_sections(spark, sf_dir):
    """Sections of Markdown texts with what stands right below their headings."""
    line = F.expr("case when p_partkey % 17 = 0 then '' when p_partkey % 6 = 0 then concat(repeat('#', 1 + p_size % 3), ' ', p_name) when p_partkey % 10 = 1 then concat('**', p_name, '**') else concat(p_name, ' ', p_brand) end")
    one = read(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 30).alias("doc_id"), F.struct("p_partkey", line.alias("line")).alias("r"))
    texts = one.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "\n").alias("text"))
    return markdown.sections(texts).select("doc_id", "level", "title", "content", "n_words", "section_hash")


@query("""with f as (select 'in/' || p_brand || '/' || p_name || '.' || p_partkey || '.pdf' as path from part), d as (select distinct regexp_extract(path, '([^/]+?)([.][^./]+)?$', 1) as base from (select 'out/' || p_name || '.' || p_partkey || '.json' as path from part where p_size % 3 = 0))
select path from f where regexp_extract(path, '([^/]+?)([.][^./]+)?$', 1) not in (select base from d)""")
def files_not_yet_written(spark, sf_dir):
    """Files without an output of their name."""
    p = read(spark, sf_dir, "part")
    key = F.concat("p_name", F.lit("."), F.col("p_partkey").cast("string"))
    files = p.select(F.concat(F.lit("in/"), "p_brand", F.lit("/"), key, F.lit(".pdf")).alias("path"))
    return hub.not_yet_written(files, p.where("p_size % 3 = 0").select(F.concat(F.lit("out/"), key, F.lit(".json")).alias("path")))


@query(f"""with t as ({_TABLES}), p as (select table_ord, x0 as ax0, x1 as ax1, y0 as ay0, y1 as ay1, page_id as pa, lead(table_ord) over w as b, lead(x0) over w + lead(table_ord) over w % 7 * 90 as bx0, lead(x1) over w + lead(table_ord) over w % 7 * 90 as bx1, lead(y0) over w as by0, lead(y1) over w as by1, lead(page_id) over w as pb
 from t window w as (partition by doc order by table_ord))
select table_ord, round(case when pa = pb then greatest(0, 1 - case when ay1 <= by0 then by0 - ay1 else ay0 - by1 end / 700) when pa + 1 = pb then (2 - ay1 / 700 - by0 / 700) / 2 else 0 end, 6) as near,
 round(case when least(ax1, bx1) >= greatest(ax0, bx0) then (least(ax1, bx1) - greatest(ax0, bx0)) / (greatest(ax1, bx1) - least(ax0, bx0)) else 0 end, 6) as overlap from p where b is not null""")
def table_positions(spark, sf_dir):
    """How near neighbouring tables lie, and how much of their width they share."""
    w = Window.partitionBy("doc").orderBy("table_ord")
    t, nxt = document_tables(spark, sf_dir), lambda c: F.lead(c).over(w)
    shift = nxt("table_ord") % 7 * 90
    box = nxt("box")
    p = t.select("table_ord", "box", "page_id", "page_height", nxt("table_ord").alias("b"), nxt("page_id").alias("pb"), g.box(box["x0"] + shift, box["y0"], box["x1"] + shift, box["y1"]).alias("other")).where("b is not null")
    near = table_merge.vertical_proximity(F.col("box"), F.col("other"), F.col("page_id"), F.col("pb"), F.col("page_height"))
    return p.select("table_ord", F.round(near, 6).alias("near"), F.round(table_merge.horizontal_overlap(F.col("box"), F.col("other")), 6).alias("overlap"))
