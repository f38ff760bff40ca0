"""Registered queries of the block, table, section, rule and scoring operators over frames that the test tables are laid out as.

Pages of forty blocks, tables of cells and texts are made from whole tables by arithmetic on their keys, in Spark and in
SQL alike; every row takes part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import text as tx
from ..operators import entities, hierarchy, layout, processors, qa, rules, scoring, search, spatial, tables, validators
from .queries import query, read

# Blocks: forty to a page of 600 by 700, one below the other, of nine types in turn.
_KINDS = ["PageHeader", "Text", "Text", "Text", "ListItem", "ListItem", "Table", "Caption", "Footnote"]
_BLOCKS = f"""select p_partkey // 40 as page_id, p_partkey as id, {_KINDS}[(p_partkey % 9) + 1] as block_type, p_name as text, p_size,
  (50 + (p_partkey * 37 % 5) * 20)::double as x0, (p_partkey % 40 * 17)::double as y0, (350 + (p_partkey * 37 % 5) * 20 + p_size)::double as x1, (p_partkey % 40 * 17 + 10 + p_partkey % 5)::double as y1 from part"""
_GAP = "sqrt(pow(greatest(0, {b}.x0 - {a}.x1, {a}.x0 - {b}.x1), 2) + pow(greatest(0, {b}.y0 - {a}.y1, {a}.y0 - {b}.y1), 2))"


def blocks(spark, sf_dir):
    k = F.col("p_partkey")
    left = 50 + k * 37 % 5 * 20
    box = g.box(left, k % 40 * 17, left + 300 + F.col("p_size"), k % 40 * 17 + 10 + k % 5)
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (k % 9).cast("int") + 1)
    return read(spark, sf_dir, "part").select(F.floor(k / 40).alias("page_id"), k.alias("id"), kind.alias("block_type"), F.col("p_name").alias("text"), "p_size", box.alias("box"), F.lit(600.0).alias("page_width"), F.lit(700.0).alias("page_height"))


@query(f"with b as ({_BLOCKS}) select page_id, id, row_number() over (partition by page_id order by case block_type when 'PageHeader' then 0 when 'Footnote' then 2 else 1 end, id) - 1 as read_ord from b")
def block_reading_order(spark, sf_dir):
    """Page headers first, footnotes last."""
    return processors.reading_order(blocks(spark, sf_dir), ["page_id"], order="id").select("page_id", "id", "read_ord")


@query(f"""with b as ({_BLOCKS}), n as (select *, lag(block_type) over w as bt, lag(x0) over w as bx, lag(y1) over w as by1 from b window w as (partition by page_id order by id)),
f as (select *, coalesce(block_type = 'Text' and bt = 'Text' and y0 >= by1, false) as pair, (x0 - bx) / 600.0 as shift from n),
i as (select *, pair and shift >= 0.10 as opens, pair and abs(shift) <= 0.01 as same from f),
p as (select *, sum((not opens and not same)::int) over (partition by page_id order by id) as part from i)
select page_id, id, sum(opens::int) over (partition by page_id, part order by id)::bigint as quote_level from p""")
def blockquote_levels(spark, sf_dir):
    """Indented and aligned text blocks, as levels of quotes."""
    return processors.blockquotes(blocks(spark, sf_dir), ["page_id"], order="id").select("page_id", "id", "quote_level")


@query(f"""with b as ({_BLOCKS}), p as (select c.page_id, c.id, a.id as before, d.id as after, a.block_type in ('Table', 'Figure', 'Picture') and {_GAP.format(a='a', b='c')} < 35 as up,
 d.block_type in ('Table', 'Figure', 'Picture') and {_GAP.format(a='d', b='c')} < 35 as down, c.block_type from b c left join b a on a.page_id = c.page_id and a.id = c.id - 1 left join b d on d.page_id = c.page_id and d.id = c.id + 1)
select page_id, id, case when block_type in ('Caption', 'Footnote') then case when up then before when down then after end end as group_of from p""")
def caption_groups(spark, sf_dir):
    """Captions and footnotes with the table beside them."""
    return spatial.group_captions(blocks(spark, sf_dir), ["page_id"], order="id").select("page_id", "id", "group_of")


@query(f"""with b as ({_BLOCKS}), n as (select b.*, coalesce(b.block_type = 'ListItem' and a.block_type = 'ListItem' and {_GAP.format(a='a', b='b')} < 70, false) as goes_on from b left join b a on a.page_id = b.page_id and a.id = b.id - 1),
r as (select *, sum((not goes_on)::int) over (partition by page_id order by id) as run from n), s as (select *, count(*) over (partition by page_id, run) as n from r)
select page_id, id, case when block_type = 'ListItem' and n > 1 then run end as list_group, case when block_type = 'ListItem' and n = 1 then 'Text' else block_type end as block_type from s""")
def list_item_groups(spark, sf_dir):
    """Runs of close list items; lone ones become text."""
    return spatial.group_lists(blocks(spark, sf_dir), ["page_id"], order="id").select("page_id", "id", "list_group", "block_type")


@query(f"""with b as (select page_id as doc, id, p_size::double as height from ({_BLOCKS})), n as (select *, count(*) over (partition by doc) as n, avg(height) over (partition by doc) as mean,
 coalesce(lag(height) over (partition by doc order by height desc, id desc) - height, 0) as gap from b), r as (select *, row_number() over (partition by doc order by gap desc, height desc, id desc) as rank from n)
select doc, id, case when n <= 4 then 2 else 1 + sum((rank < 4 and gap > 0.25 * mean)::int) over (partition by doc order by height desc, id desc) end::int as level from r""")
def header_level_bands(spark, sf_dir):
    """Header levels from the largest gaps of line heights."""
    h = blocks(spark, sf_dir).select(F.col("page_id").alias("doc"), F.col("id").alias("block_ord"), F.col("p_size").cast("double").alias("height"))
    return hierarchy.header_levels(h, ["doc"]).select("doc", F.col("block_ord").alias("id"), "level")


_SPANS = "select l_suppkey as page_id, l_orderkey as line_id, l_linenumber::double as x0, case when l_linenumber = 1 and l_orderkey % 5 <> 0 then l_orderkey::varchar else l_returnflag || l_linenumber end as text from lineitem"


@query(f"""with s as (select *, row_number() over (partition by page_id, line_id order by x0, text) = 1 as first from ({_SPANS})), n as (select *, first and regexp_matches(trim(text), '^[0-9]+$') as num from s),
m as (select *, sum(num::int) over (partition by page_id) > 0.6 * sum(first::int) over (partition by page_id) as most from n) select page_id, line_id, text, count(*) as n, count(*) filter (num and most) as ignored from m group by all""")
def line_number_marks(spark, sf_dir):
    """Leftmost numbers of lines, on pages whose lines mostly begin with one."""
    n = F.col("l_linenumber")
    text = F.when((n == 1) & (F.col("l_orderkey") % 5 != 0), F.col("l_orderkey").cast("string")).otherwise(F.concat("l_returnflag", n.cast("string")))
    s = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("page_id"), F.col("l_orderkey").alias("line_id"), n.cast("double").alias("x0"), text.alias("text"))
    return processors.line_number_spans(s, ["page_id"]).groupBy("page_id", "line_id", "text").agg(F.count("*").alias("n"), F.count_if("ignore").alias("ignored"))


@query(f"""with l as (select page_id as block, id, text || '  ' as text, (id * 7 % 6) * 10.0 as x0, (id * 7 % 6) * 10.0 + length(text || '  ') * 5 as x1 from ({_BLOCKS})),
w as (select *, sum(x1 - x0) over (partition by block) / greatest(sum(length(text)) over (partition by block), 1) as wide, min(x0) over (partition by block) as low from l)
select block, md5(string_agg(repeat(' ', floor((x0 - low) / case when wide > 0 then wide else 1 end)::int) || rtrim(text), chr(10) order by id)) as code from w group by block""")
def indented_code(spark, sf_dir):
    """Code lines with the spaces that their left edges stand for."""
    x = F.col("id") * 7 % 6 * 10.0
    text = F.concat("text", F.lit("  "))
    lines = blocks(spark, sf_dir).select(F.col("page_id").alias("block"), F.col("id").alias("line_no"), text.alias("text"), x.alias("x0"), (x + F.length(text) * 5).alias("x1"))
    return processors.indent_code(lines, ["block"]).select("block", F.md5("code").alias("code"))


@query(f"""select page_id as doc, string_agg(trim(text) || ':' || (id % 3 + 1) || ':' || page_id, '|' order by id) as toc from ({_BLOCKS}) group by page_id""")
def contents_tables(spark, sf_dir):
    """A document's headers in order, with levels and pages."""
    h = blocks(spark, sf_dir).select(F.col("page_id").alias("doc"), F.col("id").alias("block_ord"), "text", (F.col("id") % 3 + 1).alias("level"), "page_id")
    return processors.table_of_contents(h, ["doc"]).select("doc", F.array_join(F.transform("toc", lambda e: F.concat_ws(":", e["title"], e["level"], e["page_id"])), "|").alias("toc"))


@query(f"""with t as (select id // 400 as doc, * exclude (text) from ({_BLOCKS})), n as (select *, lag(page_id) over w as p, lag(x0) over w as ax0, lag(y0) over w as ay0, lag(x1) over w as ax1, lag(y1) over w as ay1 from t window w as (partition by doc order by id)),
k as (select *, abs((ax1 - ax0) - (x1 - x0)) < 60 as alike from n), c as (select *, coalesce((p + 1 = page_id and alike) or (p = page_id and abs(ay0 - y0) < 35 and abs(x0 - ax1) < 30) or (p = page_id and alike and abs(y0 - ay1) < 35) or (p = page_id and alike and x0 > ax1 and y0 < ay0), false) as linked from k)
select doc, id, sum((not linked)::int) over (partition by doc order by id)::bigint as run from c""")
def table_runs(spark, sf_dir):
    """Tables that go on over a page break, or stand beside or below each other."""
    t = blocks(spark, sf_dir).withColumn("doc", F.floor(F.col("id") / 400))
    return tables.runs(t, ["doc"], order="id").select("doc", "id", "run")


# Cells: tables of ten rows and three columns; in two of three tables most rows are stacks of two lines.
_GRID = """select p_partkey // 10 as t, p_partkey % 10 as r, unnest([0, 1, 2]) as c, unnest(case when (p_partkey // 10) % 3 > 0 and p_partkey % 4 > 0 then [p_partkey || chr(10) || p_size, p_name || chr(10) || p_brand, '$' || chr(10) || '']
 else [p_partkey::varchar, p_name, case when p_partkey % 7 = 0 then null else 'x <&> "y", z' end] end) as text from part"""


def grid(spark, sf_dir):
    k, s, text = F.col("p_partkey"), F.col("p_size").cast("string"), lambda c: c.cast("string")
    stack = F.array(F.concat(text(k), F.lit("\n"), s), F.concat("p_name", F.lit("\n"), "p_brand"), F.lit("$\n"))
    plain = F.array(text(k), F.col("p_name"), F.when(k % 7 != 0, F.lit('x <&> "y", z')))
    cells = F.when((F.floor(k / 10) % 3 > 0) & (k % 4 > 0), stack).otherwise(plain)
    return read(spark, sf_dir, "part").select(F.floor(k / 10).alias("t"), (k % 10).alias("row_id"), F.posexplode(cells).alias("col_id", "text"))


@query(f"""with g as (select *, string_split(coalesce(text, ''), chr(10)) as l from ({_GRID})), r as (select t, r, count(*) > 1 and min(len(l)) = max(len(l)) and max(len(l)) > 1 as stack, max(len(l)) as most from g group by all),
s as (select *, stack and avg(stack::int) over (partition by t) >= 0.5 as split from r), p as (select *, coalesce(sum(case when split then most else 1 end) over (partition by t order by r rows between unbounded preceding and 1 preceding), 0) as first from s),
o as (select t, first, c, unnest(case when split then l else [text] end) as text, unnest(range(case when split then len(l) else 1 end)) as k from g join p using (t, r)) select t, (first + k)::bigint as row_id, c as col_id, text from o""")
def stacked_rows(spark, sf_dir):
    """Rows that are stacks of lines become rows of their own."""
    return tables.split_stacked_rows(grid(spark, sf_dir), ["t"]).select("t", F.col("row_id").cast("long").alias("row_id"), "col_id", "text")


_MONEY = "select p_partkey // 10 as t, p_partkey % 10 as r, unnest([0, 1, 2]) as c, unnest([p_name, case when (p_partkey // 10) % 4 = 0 then p_brand when p_partkey % 3 = 0 then '' else '$' end, p_size::varchar]) as text from part"


@query(f"""with g as ({_MONEY}), k as (select t, c, count(*) > 1 and bool_and(trim(coalesce(text, '')) in ('', '$')) and bool_or(trim(coalesce(text, '')) = '$') as signs, list_sort(list_distinct(list(r))) as rows from g group by all),
n as (select *, lead(c) over w as nxt, coalesce(signs and lead(rows) over w = rows, false) as gone from k window w as (partition by t order by c)), m as (select g.*, nxt, gone from g join n using (t, c)),
s as (select t, r, nxt as c, trim(text) as sign from m where gone) select m.t, m.r as row_id, m.c as col_id, coalesce(sign, '') || coalesce(text, '') as text from m left join s using (t, r, c) where not gone""")
def dollar_columns(spark, sf_dir):
    """Columns of dollar signs go into the next one."""
    k = F.col("p_partkey")
    sign = F.when(F.floor(k / 10) % 4 == 0, F.col("p_brand")).when(k % 3 == 0, "").otherwise("$")
    cells = read(spark, sf_dir, "part").select(F.floor(k / 10).alias("t"), (k % 10).alias("row_id"), F.posexplode(F.array("p_name", sign, F.col("p_size").cast("string"))).alias("col_id", "text"))
    return tables.merge_dollar_columns(cells, ["t"]).select("t", "row_id", "col_id", "text")


@query(f"""with g as (select t, trim(text) as x from ({_GRID}) where trim(text) <> ''), k as (select t, case when x = upper(x) then 'upper' when x = lower(x) then 'lower'
 when x = list_aggregate(list_transform(string_split(x, ' '), lambda w: upper(w[1:1]) || lower(w[2:])), 'string_agg', ' ') then 'title' else 'mixed' end as kind from g), n as (select t, kind, count(*) as n from k group by all)
select t, count(*) as kinds, arg_min(kind, (-n, kind)) as dominant, count(*) <= 2 as consistent from n group by t""")
def table_case_patterns(spark, sf_dir):
    """Kinds of letter case in a table's cells."""
    return tables.case_patterns(grid(spark, sf_dir).withColumn("text", F.col("text")), ["t"])


@query("select l_orderkey, l_linenumber, round(greatest(0.0, least(100.0, 100 * (0.4 * l_discount * 10 + 0.3 * l_quantity / 50 + 0.1 * l_tax * 12 + 0.2 * (l_linenumber % 3) / 2.0))), 6) as confidence, l_quantity < 4 or l_discount * 10 < 0.6 or l_returnflag = 'R' as fallback from lineitem")
def table_confidence(spark, sf_dir):
    """Weighted confidence of an extracted table, and whether another method is tried."""
    n, d = F.col("l_linenumber"), F.col("l_discount") * 10
    failed = F.when(F.col("l_returnflag") == "R", "failed").otherwise("lattice")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(tables.confidence(d, F.col("l_quantity") / 50, F.col("l_tax") * 12, n % 3 / 2.0), 6).alias("confidence"), tables.needs_fallback(F.col("l_quantity"), d, failed).alias("fallback"))


@query(f"select t, r as row_id, string_agg(coalesce(text, '~'), '|' order by c) as cells from ({_GRID}) group by all")
def table_rows(spark, sf_dir):
    """Cells to rows."""
    return tables.rows_of(grid(spark, sf_dir), ["t"]).select("t", "row_id", F.array_join("cells", "|", "~").alias("cells"))


@query(f"""with r as (select t, r, string_agg('<td>' || replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</td>', '' order by c) as h from ({_GRID}) group by all)
select t, md5('<table>' || chr(10) || string_agg('<tr>' || h || '</tr>', chr(10) order by r) || chr(10) || '</table>') as html from r group by t""")
def table_html(spark, sf_dir):
    return tables.to_html(grid(spark, sf_dir), ["t"]).select("t", F.md5("html").alias("html"))


@query(r"""with d as (select p_partkey, case p_partkey % 4 when 0 then p_name || ' . . . . ' || p_size when 1 then p_name || '......' || p_size when 2 then ' . ' else p_name || '   ' || p_brand end as t from part),
c as (select p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(t, '(\s\.){2,}', '', 'g'), '\.{2,}', '', 'g'), '\s{2,}', ' ', 'g')) as t from d) select p_partkey, case when t = '.' then '' else t end as text from c""")
def cell_text_cleanup(spark, sf_dir):
    """Cell texts without dot leaders and doubled spaces."""
    k, s = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    t = F.when(k == 0, F.concat("p_name", F.lit(" . . . . "), s)).when(k == 1, F.concat("p_name", F.lit("......"), s)).when(k == 2, " . ").otherwise(F.concat("p_name", F.lit("   "), "p_brand"))
    return read(spark, sf_dir, "part").select("p_partkey", tables.clean_text(t).alias("text"))


@query("select coalesce(r_name, '') as name, '' as nation from region union all select '' as name, n_name as nation from nation")
def appended_tables(spark, sf_dir):
    """Rows of two tables with unlike columns."""
    return tables.append([read(spark, sf_dir, "region").select(F.col("r_name").alias("name")), read(spark, sf_dir, "nation").select(F.col("n_name").alias("nation"))])


@query(f"""with b as ({_BLOCKS}), f as (select *, concat_ws('; ', case when contains(lower(text), 'widget') then 'text contains widget' end, case when block_type = 'Table' then 'type is Table' end, case when regexp_matches(text, '^cold') then 'text matches ^cold' end, case when page_id = 2 then 'on page 2' end) as reasons from b)
select id, reasons from f where reasons <> '' order by id limit 100""")
def block_search(spark, sf_dir):
    """The first hundred blocks that meet any criterion, with reasons."""
    return search.find(blocks(spark, sf_dir), text="widget", block_type="Table", pattern="^cold", page_id=2, order=("id",)).select("id", "reasons")


@query("select doc_id, n_chars from documents where lang = 'fr' and source = 'src0'")
def documents_by_fields(spark, sf_dir):
    return search.by_fields(read(spark, sf_dir, "documents"), {"lang": "fr", "source": "src0"}).select("doc_id", "n_chars")


@query(f"""with b as (select page_id, block_type, id % 4 + 1 as deep from ({_BLOCKS})), k as (select page_id, block_type, count(*) as n, max(deep) as deep from b group by all)
select page_id, sum(n)::bigint as n_blocks, max(deep)::int as max_depth, sum(case when block_type = 'Table' then n else 0 end)::bigint as n_tables, string_agg(block_type || '=' || n, ',' order by block_type) as types from k group by 1""")
def tree_shapes(spark, sf_dir):
    """Blocks, depth and types of each tree."""
    nodes = blocks(spark, sf_dir).select("page_id", "block_type", F.sequence(F.lit(0), (F.col("id") % 4).cast("int")).alias("path"))
    types = F.array_join(F.transform(F.array_sort(F.map_entries("types")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return search.shape(nodes, ["page_id"]).select("page_id", "n_blocks", "max_depth", "n_tables", types.alias("types"))


@query("""with v as (select c_custkey as key from customer order by 1 limit 100), e as (select o_custkey as src, o_orderkey % 200 as dst from orders)
select src, dst from e where src in (select key from v) and dst in (select key from v) order by src, dst limit 100""")
def graph_sample(spark, sf_dir):
    """The first vertices and as many edges among them."""
    v = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    e = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") % 200).alias("dst"))
    return search.sample_graph(v, e, 100)[1]


@query("select l_orderkey as doc, round(0.8 * sum(l_quantity * l_discount * 1000) / greatest(sum(l_quantity), 1) + 0.2 * max(l_tax * 1000), 6) as score from lineitem group by 1")
def document_scores(spark, sf_dir):
    """Part scores weighted by length, and the order score."""
    parts = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_quantity").alias("length"), (F.col("l_discount") * 1000).alias("score"), (F.col("l_tax") * 1000).alias("order_score"))
    return scoring.document_score(parts, ["doc"]).select("doc", F.round("score", 6).alias("score"))


_METHODS = ["alpha", "beta", "gamma"]


@query(f"""with v as (select {_METHODS}[(event_id % 3) + 1] as a, {_METHODS}[((event_id + 1 + user_id % 2) % 3) + 1] as b, value > 60 as w from events), o as (select least(a, b) as method_a, greatest(a, b) as method_b, case when w then a else b end as winner from v)
select method_a, method_b, count(*) as n, count(*) filter (winner = method_a) as a_wins, round(100.0 * count(*) filter (winner = method_a) / count(*), 6) as a_percent from o group by all""")
def method_win_rates(spark, sf_dir):
    """How often each of two methods wins."""
    names, e = F.array(*map(F.lit, _METHODS)), F.col("event_id")
    at = lambda k: F.element_at(names, (k % 3).cast("int") + 1)
    v = read(spark, sf_dir, "events").select(at(e).alias("method_a"), at(e + 1 + F.col("user_id") % 2).alias("method_b"), "value")
    v = v.withColumn("winner", F.when(F.col("value") > 60, F.col("method_a")).otherwise(F.col("method_b")))
    return scoring.win_rates(v).withColumn("a_percent", F.round("a_percent", 6))


@query("""with s as (select event_type as "check", (case when (event_id % 10) / 10.0 >= 0.6 then 0.4 * ((event_id % 10) / 10.0) else 0.0 end) + 0.3 * (user_id % 5) / 4.0 + 0.3 * (event_id % 7) / 6.0 as score from events), p as (select "check", score, score >= 0.7 as passed from s)
select "check", count(*) as n, count(*) filter (round(score, 9) >= 0.7) as n_passed, round(avg(score), 4) as mean_score from p group by grouping sets (("check"), ())""")
def relevance_report(spark, sf_dir):
    """Relevance of question sets by kind, and in all."""
    e, u = F.col("event_id"), F.col("user_id")
    r = qa.relevance(e % 10 / 10.0, u % 5 / 4.0, e % 7 / 6.0)
    s = read(spark, sf_dir, "events").select(F.col("event_type").alias("check"), r["score"].alias("score")).withColumn("passed", F.round("score", 9) >= 0.7)
    return qa.report(s).select("check", "n", "n_passed", F.round("mean_score", 4).alias("mean_score"))


@query(f"""with t as (select page_id, id, text, id % 5 as parent_ord from ({_BLOCKS}) where block_type = 'Text' and length(trim(text)) >= 10), n as (select *, sum(length(text)) over w + 2 * (count(*) over w - 1) as n from t window w as (partition by page_id, parent_ord order by id rows unbounded preceding)),
f as (select page_id, parent_ord, min(id) as last from n where n >= 20 group by all) select f.page_id, f.parent_ord, string_agg(text, chr(10) || chr(10) order by id) as context from f join t on t.page_id = f.page_id and t.parent_ord = f.parent_ord and t.id <= f.last group by all""")
def section_contexts(spark, sf_dir):
    """Texts of a section up to the block with which they are long enough."""
    b = blocks(spark, sf_dir).withColumn("parent_ord", F.col("id") % 5)
    return qa.contexts(b, ["page_id"], order="id", least=20)


@query("""select p_partkey, case p_partkey % 3 when 0 then 'What does the section on ' || p_name || ' say?' when 1 then 'Explain the main idea of ' || p_name || '.' else 'How does ' || p_name || ' relate to the document?' end as question, substr(repeat(p_brand || ' ', 20), 1, 100) as answer from part""")
def question_templates(spark, sf_dir):
    k = F.col("p_partkey") % 3
    kind = F.when(k == 0, "factual").when(k == 1, "conceptual").otherwise("relation")
    q = qa.question(kind, F.col("p_name"), F.repeat(F.concat("p_brand", F.lit(" ")), F.lit(20)))
    return read(spark, sf_dir, "part").select("p_partkey", q["question"].alias("question"), q["answer"].alias("answer"))


@query(f"""with b as ({_BLOCKS}) select id, round(x0 - (x1 - x0) * 0.1, 6) as ex0, round(y1 + (y1 - y0) * 0.2, 6) as ey1, round(x0 * 2, 6) as rx0, round(y1 * 0.5, 6) as ry1, least(greatest(x0, 100.0), 400.0) as fx0, least(greatest(y1, 100.0), 500.0) as fy1, (x0 + x1) / 2 as cx, (x1 - x0) * (y1 - y0) as area from b""")
def box_transforms(spark, sf_dir):
    """Boxes expanded, rescaled, fitted, and their centres and areas."""
    b = F.col("box")
    e, r, f = g.expand(b, 0.1, 0.2), g.rescale(b, (F.lit(600.0), F.lit(700.0)), (F.lit(1200.0), F.lit(350.0))), g.fit_to(b, g.box(F.lit(100), F.lit(100), F.lit(400), F.lit(500)))
    return blocks(spark, sf_dir).select("id", F.round(e["x0"], 6).alias("ex0"), F.round(e["y1"], 6).alias("ey1"), F.round(r["x0"], 6).alias("rx0"), F.round(r["y1"], 6).alias("ry1"), f["x0"].alias("fx0"), f["y1"].alias("fy1"), g.center(b)["x"].alias("cx"), g.area(b).alias("area"))


@query(f"select page_id, block_type, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from ({_BLOCKS}) group by all")
def merged_boxes(spark, sf_dir):
    return blocks(spark, sf_dir).groupBy("page_id", "block_type").agg(g.merged(F.col("box")).alias("b")).select("page_id", "block_type", "b.*")


@query(f"select page_id, id, row_number() over (partition by page_id order by round_even(y0 / 40, 0) * 40, x0, id) as place from ({_BLOCKS})")
def line_sorting(spark, sf_dir):
    """Lines of nearly one height beside each other, left to right."""
    from pyspark.sql import Window

    w = Window.partitionBy("page_id").orderBy(*g.line_order(F.col("box"), 40.0), "id")
    return blocks(spark, sf_dir).select("page_id", "id", F.row_number().over(w).alias("place"))


_TEX = r"""select p_partkey, p_size, case p_partkey % 6 when 0 then '\begin{array} x \end{array}' when 1 then '\int x' || chr(10) || '\sum y' when 2 then '\newcommand a $x$' when 3 then '{x' when 4 then '$x' else p_name end as t from part"""


def _tex(spark, sf_dir):
    k = F.col("p_partkey") % 6
    t = F.when(k == 0, r"\begin{array} x \end{array}").when(k == 1, "\\int x\n\\sum y").when(k == 2, r"\newcommand a $x$").when(k == 3, "{x").when(k == 4, "$x").otherwise(F.col("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", "p_size", t.alias("t"))


@query(rf"""select p_partkey, round(least(1.0, (contains(t, chr(10)))::int * 0.3::double + (contains(t, '\begin{{') or contains(t, '\matrix') or contains(t, '\array'))::int * 0.4 + (contains(t, '\int') or contains(t, '\sum') or contains(t, '\prod'))::int * 0.3
 + (contains(t, '\newcommand') or contains(t, '\def'))::int * 0.5 + (p_size < 20)::int * 0.3), 6) as complexity from ({_TEX})""")
def math_complexity(spark, sf_dir):
    """Complexity points of LaTeX."""
    return _tex(spark, sf_dir).select("p_partkey", F.round(rules.math_complexity(F.col("t"), F.when(F.col("p_size") < 20, 0.5).otherwise(0.9)), 6).alias("complexity"))


@query(rf"""select p_partkey, length(replace(t, '{{', '')) = length(replace(t, '}}', '')) and (length(t) - length(replace(t, '\begin', ''))) / 6 = (length(t) - length(replace(t, '\end', ''))) / 4 and (length(t) - length(replace(t, '$', ''))) % 2 = 0 as valid from ({_TEX})""")
def latex_balance(spark, sf_dir):
    """Braces, environments and dollar signs in pairs."""
    return _tex(spark, sf_dir).select("p_partkey", validators.balanced_latex(F.col("t"))["valid"].alias("valid"))


@query("""select event_id, case when kind = 'Equation' and c >= 0.7 then 'model' when kind = 'Table' and c >= 0.6 then 'model' when kind = 'Code' and c >= 0.5 then 'model_iterative' else 'default' end as route
from (select event_id, ['Equation', 'Table', 'Code', 'Text'][(event_id % 4) + 1] as kind, (user_id % 11) / 10.0 as c from events)""")
def processor_routes(spark, sf_dir):
    """Which processor takes a block."""
    kind = F.element_at(F.array(*map(F.lit, ["Equation", "Table", "Code", "Text"])), (F.col("event_id") % 4).cast("int") + 1)
    return read(spark, sf_dir, "events").select("event_id", rules.route(kind, F.col("user_id") % 11 / 10.0).alias("route"))


@query("""with m as (select event_id, event_id % 13 > 0 as a, event_id % 17 > 0 as r, event_id % 21 as mem, user_id % 12 as cores, event_id % 100 as cpu, case when event_id % 19 = 0 then 'high' else 'low' end as load, event_id % 23 as disk from events)
select event_id, case when not a or not r or mem < 4 then 'disabled' when mem < 8 or cores < 4 then 'minimal' when cpu > 80 or load = 'high' then 'tables_only' when disk < 2 then 'minimal' when mem >= 16 and cores >= 8 and cpu < 50 then 'accuracy' when mem >= 12 and cores >= 6 then 'tables_only' else 'minimal' end as config from m""")
def machine_configs(spark, sf_dir):
    """Which model features a machine should run."""
    e, u = F.col("event_id"), F.col("user_id")
    config = rules.recommended_config(e % 13 > 0, e % 17 > 0, e % 21, u % 12, e % 100, F.when(e % 19 == 0, "high").otherwise("low"), e % 23)
    return read(spark, sf_dir, "events").select("event_id", config.alias("config"))


@query("""select event_id, case when (event_id % 2 = 0)::int + (event_id % 3 = 0)::int + (event_id % 5 = 0)::int >= 2 then 'code' when (user_id % 2 = 0)::int + (user_id % 3 = 0)::int >= 2 then 'math' else event_type end as region from events""")
def region_types(spark, sf_dir):
    """code or math where enough flags are set."""
    e, u = F.col("event_id"), F.col("user_id")
    return read(spark, sf_dir, "events").select("event_id", rules.region_type(F.col("event_type"), [e % k == 0 for k in (2, 3, 5)], [u % k == 0 for k in (2, 3)]).alias("region"))


@query(r"""select p_partkey, length(t) between 10 and 125 and not regexp_matches(lower(t), '^(an? )?(image|picture|photo) of') as alt_ok, regexp_matches(t, '\[\d+(,\s*\d+)*\]|\([A-Z][A-Za-z]+( et al\.)?,? \d{4}\)') as cited
from (select p_partkey, case p_partkey % 5 when 0 then 'An image of ' || p_name when 1 then p_name || ' [1, 2]' when 2 then p_name || ' (Miller et al., 1999)' when 3 then 'short' else p_name || ' (1999)' end as t from part)""")
def alt_text_and_citations(spark, sf_dir):
    """Alternative texts of good length and phrasing, and texts with a citation."""
    k, n = F.col("p_partkey") % 5, F.col("p_name")
    t = F.when(k == 0, F.concat(F.lit("An image of "), n)).when(k == 1, F.concat(n, F.lit(" [1, 2]"))).when(k == 2, F.concat(n, F.lit(" (Miller et al., 1999)"))).when(k == 3, "short").otherwise(F.concat(n, F.lit(" (1999)")))
    return read(spark, sf_dir, "part").select("p_partkey", validators.alt_text(t)["valid"].alias("alt_ok"), validators.citation(t)["valid"].alias("cited"))


@query("""select p_partkey, len(list_filter(list_distinct(string_split(lower(p_name), ' ')), lambda w: w <> '' and not list_contains(['cold', 'small', 'widget', 'gear'], w))) = 0 as valid from part""")
def words_of_a_list(spark, sf_dir):
    """Names made of listed words only."""
    return read(spark, sf_dir, "part").select("p_partkey", validators.words_in(F.col("p_name"), ["Cold", "small", "widget", "gear"])["valid"].alias("valid"))


@query(r"""with t as (select conv_id, turn, text, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') as w from conversations)
select conv_id, turn, coalesce(len(w) >= 10 and len(regexp_extract_all(text, '[.!?]')) >= 1 and len(list_distinct(w)) >= 0.5 * len(w) * 0.5, false) as valid from t""")
def content_quality(spark, sf_dir):
    """Turns with enough words and sentences that aren't repetitive."""
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", validators.content_quality(F.col("text"))["valid"].alias("valid"))


# A stand-in for a model: it cuts, keeps or refuses by the key. Each kind's acceptance rule decides.
_ANSWER = "case id % 4 when 0 then substr(old, 1, length(old) // 4) when 1 then old || '</table>' when 2 then 'No corrections needed' else '<math>' || old end"
_TESTS = {
    "complex_region": "not contains(lower(new), 'no corrections') and length(new) >= 0.5 * length(old)",
    "equation": "length(new) > 0.3 * length(old) and len(regexp_extract_all(new, '<math')) = len(regexp_extract_all(new, '</math>'))",
    "form": "not contains(lower(new), 'no corrections') and length(new) >= 0.33 * length(old)",
    "handwriting": "length(new) >= 0.5 * length(old)",
    "math_block": "not contains(lower(new), 'no corrections needed') and length(new) >= 0.6 * length(old)",
    "table": "ends_with(new, '</table>') and length(regexp_replace(new, '<[^>]*>', '', 'g')) >= 0.5 * length(regexp_replace(old, '<[^>]*>', '', 'g'))",
    "image": "length(new) >= 10",
}


def _rewrites(kind: str):
    def run(spark, sf_dir):
        b = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat("p_name", F.lit(" of "), "p_brand").alias("text"))

        def model(old):
            k = F.col("id") % 4
            return F.when(k == 0, F.expr("substr(text, 1, length(text) div 4)")).when(k == 1, F.concat(old, F.lit("</table>"))).when(k == 2, "No corrections needed").otherwise(F.concat(F.lit("<math>"), old))

        return validators.rewrite(b, kind, F.col("id") % 5 > 0, model).select("id", "text", "rejected")

    run.__name__, run.__doc__ = f"rewrite_{kind}", f"Rewrites of kind {kind} that its rule accepts."
    return run


for _kind, _test in _TESTS.items():
    query(f"""with b as (select p_partkey as id, p_name || ' of ' || p_brand as old from part), n as (select *, {_ANSWER} as new from b), j as (select *, id % 5 > 0 as picked, {_test} as ok from n)
select id, case when picked and ok then new else old end as text, picked and not ok as rejected from j""")(_rewrites(_kind))


@query(r"""with s as (select l_orderkey as block, l_linenumber as n, case l_linenumber % 3 when 0 then '* note' when 1 then l_suppkey || ' note' else 'note' end as text, row_number() over (partition by l_orderkey order by l_linenumber, l_suppkey % 2) = 1 as first from lineitem)
select block, count(*) as n, count(*) filter (first and regexp_matches(text, '^[0-9\W]+')) as marked from s group by block""")
def footnote_marks(spark, sf_dir):
    """Footnotes whose first span is a mark."""
    n = F.col("l_linenumber")
    text = F.when(n % 3 == 0, "* note").when(n % 3 == 1, F.concat(F.col("l_suppkey").cast("string"), F.lit(" note"))).otherwise("note")
    s = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("block"), (n * 2 + F.col("l_suppkey") % 2).alias("span_ord"), text.alias("text"))
    return layout.footnote_marks(s, ["block"]).groupBy("block").agg(F.count("*").alias("n"), F.count_if("superscript").alias("marked"))


@query(f"""with o as (select page_id, case when id % 3 = 0 then 'image' else 'text' end as kind, id % 31 = 0 as hidden, id % 4 = 1 as embedded, case when page_id % 2 = 0 then 'GlyphLessFont' else 'Serif' end as font, (x1 - x0) * (y1 - y0) / 7000.0 as share from ({_BLOCKS}))
select page_id, count(*) filter (kind = 'text') > 0 and count(*) filter (kind = 'text' and hidden) = 0 and count(*) filter (kind = 'text' and embedded) > 0 and count(*) filter (kind = 'text' and not contains(lower(font), 'glyphless')) > 0 as strict,
 count(*) filter (kind = 'text') > 0 as plain from o group by page_id""")
def usable_pages(spark, sf_dir):
    """Pages whose text layer can be read, with and without the test for hidden text."""
    k = F.col("id")
    o = blocks(spark, sf_dir).select("page_id", F.when(k % 3 == 0, "image").otherwise("text").alias("kind"), "box", g.box(F.lit(0), F.lit(0), F.lit(6000), F.lit(7000)).alias("page_box"), (k % 31 == 0).alias("hidden"), (k % 4 == 1).alias("embedded"), F.when(F.col("page_id") % 2 == 0, "GlyphLessFont").otherwise("Serif").alias("font"))
    strict = layout.usable_pages(o, ["page_id"], strip_hidden=True).withColumnRenamed("usable", "strict")
    return strict.join(layout.usable_pages(o, ["page_id"]).withColumnRenamed("usable", "plain"), "page_id")


@query(r"""with l as (select p_partkey, case p_partkey % 3 when 0 then p_name || '- ' when 1 then p_name || '—' else p_name end as a, case when p_size % 2 = 0 then lower(p_brand) else p_brand end as b from part)
select p_partkey, case when regexp_matches(a, '[-—¬]\s*$') and regexp_matches(b, '^\s*\p{Ll}') then regexp_replace(a, '[-—¬]\s*$', '') else a || chr(10) end as text from l""")
def hyphen_joins(spark, sf_dir):
    """Lines without the hyphen where the word goes on."""
    k = F.col("p_partkey") % 3
    a = F.when(k == 0, F.concat("p_name", F.lit("- "))).when(k == 1, F.concat("p_name", F.lit("—"))).otherwise(F.col("p_name"))
    b = F.when(F.col("p_size") % 2 == 0, F.lower("p_brand")).otherwise(F.col("p_brand"))
    return read(spark, sf_dir, "part").select("p_partkey", tx.join_hyphenated(a, b).alias("text"))


@query(f"""with b as ({_BLOCKS}), c as (select * from b where block_type = 'Table'), l as (select page_id, id, 'line ' || id as text, x0, y0 - 9 as y0, x1, y1 - 4 as y1 from b where block_type <> 'Table'),
s as (select l.page_id, l.id as line, c.id as cell, l.text, l.y0, l.x0, greatest(0, least(l.x1, c.x1) - greatest(l.x0, c.x0)) * greatest(0, least(l.y1, c.y1) - greatest(l.y0, c.y0)) as shared from l join c using (page_id)),
m as (select page_id, line, arg_min(cell, (-shared, cell)) as cell, any_value(text) as text, any_value(y0) as y0, any_value(x0) as x0 from s where shared > 0 group by all)
select c.page_id, c.id as cell_id, string_agg(m.text, ' ' order by m.y0, m.x0, m.line) as text from c left join m on m.page_id = c.page_id and m.cell = c.id group by all""")
def cell_texts(spark, sf_dir):
    """Text lines to the table cell they share most area with."""
    b = blocks(spark, sf_dir)
    x = F.col("box")
    lines = b.where("block_type <> 'Table'").select("page_id", F.col("id").alias("line_id"), F.concat(F.lit("line "), F.col("id").cast("string")).alias("text"), g.box(x["x0"], x["y0"] - 9, x["x1"], x["y1"] - 4).alias("box"))
    return tables.text_to_cells(lines, b.where("block_type = 'Table'").select("page_id", F.col("id").alias("cell_id"), "box"), ["page_id"])


@query(r"""with t as (select s_suppkey as doc_id, 'Mary Smith of ' || case s_suppkey % 3 when 0 then 'London' when 1 then 'Miller City' else 'Stanford University' end || ' wrote to a' || s_suppkey % 7 || '@x.org on 12-31-' || 2000 + s_suppkey % 4 as text from supplier),
e as (select doc_id, 'person' as k, unnest(regexp_extract_all(text, '\b[A-Z][a-z]+ [A-Z][a-z]+\b')) as v from t union all select doc_id, 'organization', unnest(regexp_extract_all(text, '\b(?:Inc\.|LLC|Corp\.|Company|University|Institute)\b')) from t
union all select doc_id, 'location', unnest(regexp_extract_all(text, '\b(?:New York|London|Paris|Tokyo|[A-Z][a-z]+ City)\b')) from t union all select doc_id, 'email', unnest(regexp_extract_all(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b')) from t
union all select doc_id, 'date', unnest(regexp_extract_all(text, '\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b')) from t), d as (select distinct * from e)
select a.k as type_a, a.v as entity_a, b.k as type_b, b.v as entity_b, count(*) as n_docs from d a join d b using (doc_id) where a.k <> b.k and (a.k, a.v) < (b.k, b.v) group by all""")
def letter_cooccurrence(spark, sf_dir):
    """Entities of letters that every supplier sent, in pairs."""
    k = F.col("s_suppkey")
    place = F.when(k % 3 == 0, "London").when(k % 3 == 1, "Miller City").otherwise("Stanford University")
    text = F.concat(F.lit("Mary Smith of "), place, F.lit(" wrote to a"), (k % 7).cast("string"), F.lit("@x.org on 12-31-"), (2000 + k % 4).cast("string"))
    return entities.cooccurrences(entities.mentions(read(spark, sf_dir, "supplier").select(k.alias("doc_id"), text.alias("text"))))


@query("""with m as (select p_partkey, p_size * 20 as width, p_partkey * 7 % 900 as height, p_size as n_cells, p_partkey % 4 = 0 as spans, p_partkey % 6 = 0 as nested from part),
s as (select p_partkey, round((case when height > 500 or width > 800 then 0.2 else 0 end + case when n_cells > 30 then 0.2 else 0 end + case when spans then 0.3 else 0 end + case when nested then 0.3 else 0 end)::double, 6) as score,
  concat_ws(',', case when height > 500 or width > 800 then 'large_size' end, case when n_cells > 30 then 'high_cell_count' end, case when spans then 'merged_cells' end, case when nested then 'nested_structure' end) as factors from m)
select p_partkey, least(score, 1.0) as score, factors, score > 0.3 as needs_model from s""")
def table_image_scores(spark, sf_dir):
    """How complex a table's picture is, and whether a model should read it."""
    k, size = F.col("p_partkey"), F.col("p_size")
    found = rules.table_image_complexity(size * 20, k * 7 % 900, size, k % 4 == 0, k % 6 == 0)
    return read(spark, sf_dir, "part").select("p_partkey", found.alias("f")).select("p_partkey", "f.score", F.array_join("f.factors", ",").alias("factors"), "f.needs_model")


_BODY = "case when p_partkey % {k} = 0 then '<table><tr><td>' || p_name || '</td></tr></table>' else '<table><tbody><tr><td>' || p_{f} || '</td></tr></tbody></table>' end"


@query(f"""with t as (select p_partkey, {_BODY.format(k=5, f="name")} as a, {_BODY.format(k=7, f="brand")} as b from part)
select p_partkey, case when a like '%</tbody>%' and b like '%<tbody>%' then regexp_replace(a, '</tbody></table>$', '') || regexp_extract(b, '<tbody>(.*)</tbody>', 1) || '</tbody></table>' else a || chr(10) || b end as html from t""")
def html_bodies_joined(spark, sf_dir):
    """HTML tables that go on in another one."""
    html = lambda k, f: F.expr(_BODY.format(k=k, f=f))
    return read(spark, sf_dir, "part").select("p_partkey", tables.append_html_body(html(5, "name"), html(7, "brand")).alias("html"))


@query("select user_id, event_type as feature, round(sum((event_id % 120) / 8.0), 1) as seconds from events group by all")
def feature_timings(spark, sf_dir):
    """Seconds of each feature in each run."""
    return scoring.feature_times(read(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("feature"), (F.col("event_id") % 120 / 8.0).alias("seconds")), ["user_id"])


@query("""with s as (select user_id, (event_id % 120) / 8.0 as seconds, event_id % 3 > 0 as a, event_id % 5 > 0 as g, event_id % 11 = 0 as f from events)
select user_id, round(sum(seconds), 1) as total_seconds, count(*) filter (a) as n_analyses, count(*) filter (a and g) as n_successful, count(*) filter (f) as n_fallbacks,
  round(case when count(*) filter (a) > 0 then sum(seconds) / count(*) filter (a) else 0.0 end, 1) as average_seconds from s group by user_id""")
def run_performances(spark, sf_dir):
    """Analyses, fallbacks and mean time of each run."""
    e = F.col("event_id")
    steps = read(spark, sf_dir, "events").select("user_id", (e % 120 / 8.0).alias("seconds"), (e % 3 > 0).alias("is_analysis"), (e % 5 > 0).alias("is_successful"), (e % 11 == 0).alias("is_fallback"))
    return scoring.run_performance(steps, ["user_id"])


@query(f"""with b as ({_BLOCKS}), o as (select *, lag(id) over w as pid, lag((x0 + x1) / 2) over w as px, lag((y0 + y1) / 2) over w as py from b where block_type in ('Text', 'ListItem') window w as (partition by page_id order by id)),
n as (select *, sum(case when pid + 1 = id and sqrt(pow(px - (x0 + x1) / 2, 2) + pow(py - (y0 + y1) / 2, 2)) < 60 then 0 else 1 end) over (partition by page_id order by id) as k from o),
m as (select page_id, k, min(id) as first_line, count(*) as n_lines, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, arg_min((x0 + x1) / 2, id) as cx, arg_min((y0 + y1) / 2, id) as cy from n group by all)
select m.page_id, first_line, n_lines, m.x0, m.y0, m.x1, m.y1, arg_min(b.id, (5 * abs(cx - (b.x0 + b.x1) / 2) + abs(cy - (b.y0 + b.y1) / 2), b.id)) as after
from m left join b on b.page_id = m.page_id and b.block_type in ('Table', 'Caption', 'Footnote') group by all""")
def blocks_of_orphan_lines(spark, sf_dir):
    """Blocks made of lines that no block took, and where they go."""
    b = blocks(spark, sf_dir)
    lines = b.where("block_type in ('Text', 'ListItem')").select("page_id", F.col("id").alias("line_ord"), "box")
    others = b.where("block_type in ('Table', 'Caption', 'Footnote')").select("page_id", F.col("id").alias("block_id"), "box")
    return spatial.new_blocks(lines, others, ["page_id"], within=60.0).select("page_id", "first_line", "n_lines", "box.*", "after")


@query("""with r as (select p_partkey // 10 as t, p_partkey % 10 as r, p_partkey::varchar as a, p_name as b, p_size::varchar as c from part),
h as (select t, case when t % 4 = 0 then 'key' else 'size' end as last from r where r = 0 and t % 2 = 0),
o as (select t, r, last, case when last is null then '["' || a || '","' || b || '","' || c || '"]' when last = 'key' then '{"key":"' || c || '","name":"' || b || '"}' else '{"key":"' || a || '","name":"' || b || '","size":"' || c || '"}' end as j from r left join h using (t))
select t, md5('{"headers":[' || coalesce('"key","name","' || max(last) || '"', '') || '],"rows":[' || coalesce(string_agg(j, ',' order by r) filter (last is null or r > 0), '') || ']}') as json from o group by t""")
def table_json(spark, sf_dir):
    """Tables as JSON, with and without a row of names, also of one name twice."""
    k, t = F.col("p_partkey"), F.floor(F.col("p_partkey") / 10)
    head = (k % 10 == 0) & (t % 2 == 0)
    names = F.array(F.lit("key"), F.lit("name"), F.when(t % 4 == 0, "key").otherwise("size"))
    texts = F.when(head, names).otherwise(F.array(k.cast("string"), "p_name", F.col("p_size").cast("string")))
    cells = read(spark, sf_dir, "part").select(t.alias("t"), (k % 10).alias("row_id"), head.alias("is_header"), F.posexplode(texts).alias("col_id", "text"))
    return tables.to_json(cells, ["t"]).select("t", F.md5("json").alias("json"))
