"""Registered queries over the test tables, each with the DuckDB SQL that gives the same rows where SQL has a form for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import similarity as sim
from ..functions import text as tx
from ..operators import chunking, entities, graph, hierarchy, layout, processors, qa, render, rollout, rules, scoring, search, spatial, tables, validators, vector_index
from ..sources import html

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(r"""
with s as (select doc_id, coalesce(text, '') as t from documents),
m as (select doc_id, t, len(regexp_extract_all(t, '[\s\x{00a0}]+')) as sp, length(regexp_replace(t, '[\s\x{00a0}]+', '', 'g')) as ns, len(regexp_extract_all(t, '\n+')) as nl,
  length(regexp_replace(t, '\n+', '', 'g')) as nn, regexp_replace(t, '[ \n]', '', 'g') as r from s)
select doc_id, round(case when ns + sp > 0 then sp / (ns + sp) else 0 end, 6) as space_share, round(case when nl + nn > 0 then nl / (nl + nn) else 0 end, 6) as newline_share,
  round(case when length(r) = 0 then 1 else (length(r) - length(regexp_replace(r, '[\p{L}\p{N}]', '', 'g'))) / length(r) end, 6) as alnum_share,
  length(t) = 0 or coalesce(sp / (ns + sp) > 0.7, false) or coalesce(nl / (nl + nn) > 0.6, false) or (length(r) > 0 and (length(r) - length(regexp_replace(r, '[\p{L}\p{N}]', '', 'g'))) / length(r) < 0.3)
   or length(t) - length(translate(t, chr(65533) || chr(9633), '')) > greatest(6.0, length(t) * 0.03) as garbled
from m""")
def garbled_text_flags(spark, sf_dir):
    """Share of spaces, newlines and letters, and whether the text layer looks unusable."""
    t = F.coalesce("text", F.lit(""))
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.round(tx.space_ratio(t), 6).alias("space_share"), F.round(tx.newline_ratio(t), 6).alias("newline_share"), F.round(tx.alphanumeric_ratio(t), 6).alias("alnum_share"), tx.looks_garbled(t).alias("garbled"))


@query("select doc_id, md5(translate(text, chr(8195) || chr(8194) || chr(160) || chr(8203) || chr(12288), '     ')) as digest, length(text)::int as n from documents")
def normalized_spaces(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(tx.normalize_spaces(F.col("text"))).alias("digest"), F.length("text").alias("n"))


@query("""select lang, count(*) as n_docs, sum(length(text) // 4)::bigint as tokens, round(avg(length(text) // 4), 4) as mean_tokens, max(length(text) // 4)::int as most, min(length(text) // 4)::int as least
from documents group by lang""")
def token_estimate_stats(spark, sf_dir):
    n = tx.estimated_tokens(F.col("text"))
    return read(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum(n).alias("tokens"), F.round(F.avg(n), 4).alias("mean_tokens"), F.max(n).alias("most"), F.min(n).alias("least"))


@query(r"""with p as (select doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '') as s from documents)
select doc_id, len(s)::int as n_sentences, coalesce(list_max(list_transform(s, lambda x: length(x))), 0)::int as longest from p""")
def sentence_counts(spark, sf_dir):
    s = tx.sentences(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", F.size(s).alias("n_sentences"), F.coalesce(F.array_max(F.transform(s, lambda x: F.length(x))), F.lit(0)).alias("longest"))


@query(r"""with plain as (select doc_id, regexp_replace(text, '[^\x00-\x7F]', '_', 'g') as text from documents),
e as (select doc_id, 'person' as entity_type, unnest(regexp_extract_all(text, '\b[A-Z][a-z]+ [A-Z][a-z]+\b')) as entity from plain
union all select doc_id, 'organization', unnest(regexp_extract_all(text, '\b(?:Inc\.|LLC|Corp\.|Company|University|Institute)\b')) from plain
union all select doc_id, 'location', unnest(regexp_extract_all(text, '\b(?:New York|London|Paris|Tokyo|[A-Z][a-z]+ City)\b')) from plain
union all select doc_id, 'email', unnest(regexp_extract_all(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b')) from documents
union all select doc_id, 'url', unnest(regexp_extract_all(text, 'https?://[^\s]+')) from documents
union all select doc_id, 'date', unnest(regexp_extract_all(text, '\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b')) from documents)
select doc_id, entity_type, entity, count(*) as n from e group by all""")
def entity_mentions(spark, sf_dir):
    return entities.mentions(read(spark, sf_dir, "documents"))


@query(ORACLE_SQL["entity_mentions"].replace("select doc_id, entity_type, entity, count(*) as n from e group by all", ", d as (select distinct doc_id, entity_type, entity from e)").replace("from documents)\n,", "from documents),")
       + """select a.entity_type as type_a, a.entity as entity_a, b.entity_type as type_b, b.entity as entity_b, count(*) as n_docs from d a join d b on a.doc_id = b.doc_id
where a.entity_type <> b.entity_type and (a.entity_type, a.entity) < (b.entity_type, b.entity) group by all""")
def entity_cooccurrence(spark, sf_dir):
    return entities.cooccurrences(entities.mentions(read(spark, sf_dir, "documents")))


@query(r"""with l as (select doc_id, trim(unnest(string_split(text, chr(10)))) as line from documents), k as (select *, regexp_replace(regexp_replace(line, '^[0-9]+\s*', ''), '\s*[0-9]+$', '') as key from l where line <> '')
select key as line_text, count(*) as n_lines, count(distinct doc_id) as n_docs from k group by key having count(distinct doc_id) > 3""")
def repeated_lines(spark, sf_dir):
    """Lines that recur across documents once edge digits are gone, as headers and footers do."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", F.trim("line")).where("line <> ''")
    keyed = lines.select("doc_id", tx.strip_edge_digits(F.col("line")).alias("line_text"))
    per_doc = keyed.groupBy("line_text", "doc_id").agg(F.count("*").alias("n"))
    return per_doc.groupBy("line_text").agg(F.sum("n").alias("n_lines"), F.count("*").alias("n_docs")).where("n_docs > 3")


@query(r"""with w as (select doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') as t from documents)
select doc_id, len(t)::int as n_tokens, len(list_filter(t, lambda x: regexp_matches(x, '^[0-9]+$')))::int as n_digits, len(t) >= 4 and len(list_filter(t, lambda x: regexp_matches(x, '^[0-9]+$'))) > 0.6 * len(t) as line_numbers from w""")
def line_number_blocks(spark, sf_dir):
    """Blocks that are mostly numbers are line numbers."""
    t = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    digits = F.size(F.filter("t", lambda x: x.rlike("^[0-9]+$")))
    d = read(spark, sf_dir, "documents").select("doc_id", t.alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), digits.alias("n_digits"), ((F.size("t") >= 4) & (digits > 0.6 * F.size("t"))).alias("line_numbers"))


@query("""select doc_id, substr(text, 1, 200) as preview from documents where contains(lower(text), 'that') order by n_chars desc, doc_id limit 25""")
def substring_search_top(spark, sf_dir):
    """Case-insensitive search, longest documents first."""
    d = read(spark, sf_dir, "documents").where(F.contains(F.lower("text"), F.lit("that")))
    return d.orderBy(F.desc("n_chars"), "doc_id").limit(25).select("doc_id", F.substring("text", 1, 200).alias("preview"))


@query("select lang, source, count(*) as n, sum(n_chars)::bigint as chars from documents group by grouping sets ((lang, source), (lang), ())")
def lang_source_histogram(spark, sf_dir):
    read(spark, sf_dir, "documents").createOrReplaceTempView("docloom_documents")
    return spark.sql("select lang, source, count(*) as n, sum(n_chars) as chars from docloom_documents group by grouping sets ((lang, source), (lang), ())")


@query(r"""with i as (select item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))) as w from benchmark), n as (select item_id, count(*) as n from i group by 1),
d as (select doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))) as w from documents),
o as (select doc_id, item_id, count(*) as shared from d join i using (w) group by all)
select doc_id, item_id, shared, round(shared / n, 6) as overlap from o join n using (item_id) where shared / n >= 0.8""")
def benchmark_overlap(spark, sf_dir):
    """Documents that have most of an item's distinct words: only an item's rarest words, of which such a document has one, bring the two together."""
    return search.word_overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), 0.8).withColumn("overlap", F.round("overlap", 6))


@query("""select lang, source, count(*) as n, round(avg(quality), 6) as mean_quality, count(*) filter (toxic = 1) as n_toxic from documents join labels using (doc_id) group by grouping sets ((lang), (source), (lang, source))""")
def label_quality_rollup(spark, sf_dir):
    j = read(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(read(spark, sf_dir, "labels"), "doc_id")
    return j.groupingSets([["lang"], ["source"], ["lang", "source"]], "lang", "source").agg(F.count("*").alias("n"), F.round(F.avg("quality"), 6).alias("mean_quality"), F.count_if(F.col("toxic") == 1).alias("n_toxic"))


_PAIRS = """with t as (select conv_id, turn, role, text, lead(role) over w as next_role, lead(text) over w as answer from conversations window w as (partition by conv_id order by turn)),
p as (select conv_id, turn, text as question, answer from t where role = 'user' and next_role = 'assistant')"""


@query(_PAIRS + r""", n as (select *, len(list_filter(string_split_regex(question, '\s+'), lambda w: w <> '')) as qw, len(list_filter(string_split_regex(answer, '\s+'), lambda w: w <> '')) as aw from p)
select conv_id, turn, ((suffix(question, '?'))::int * 1 + (qw between 3 and 25)::int * 2 + (aw between 10 and 200)::int * 2
 + regexp_matches(lower(question), '^(what|who|where|when|why|how|which|whose|whom|can|could|would|should|is|are|do|does|did|explain|describe)\b')::int
 + (contains(answer, chr(10)) or len(regexp_extract_all(answer, '[.!?]')) > 1)::int + (regexp_matches(answer, '^\p{Lu}') and regexp_matches(answer, '[.!?]$'))::int
 + (not regexp_matches(lower(answer), 'placeholder|generating'))::int * 2) / 10.0 >= 0.5 as passed,
 ((suffix(question, '?'))::int * 1 + (qw between 3 and 25)::int * 2 + (aw between 10 and 200)::int * 2
 + regexp_matches(lower(question), '^(what|who|where|when|why|how|which|whose|whom|can|could|would|should|is|are|do|does|did|explain|describe)\b')::int
 + (contains(answer, chr(10)) or len(regexp_extract_all(answer, '[.!?]')) > 1)::int + (regexp_matches(answer, '^\p{Lu}') and regexp_matches(answer, '[.!?]$'))::int
 + (not regexp_matches(lower(answer), 'placeholder|generating'))::int * 2)::double / 10 as score from n""")
def qa_quality_score(spark, sf_dir):
    p = qa.pairs(read(spark, sf_dir, "conversations"))
    return p.select("conv_id", "turn", tx.qa_quality(F.col("question"), F.col("answer")).alias("score")).withColumn("passed", F.col("score") >= 0.5).select("conv_id", "turn", "passed", "score")


@query(_PAIRS + r""", q as (select conv_id, turn, list_distinct(regexp_extract_all(lower(question), '[\p{L}\p{N}_]+')) as a, list_distinct(regexp_extract_all(lower(answer), '[\p{L}\p{N}_]+')) as b from p)
select conv_id, turn, round(len(list_intersect(a, b)) / greatest(len(a), 1), 6) as question_overlap, round(len(list_intersect(b, a)) / greatest(len(b), 1), 6) as answer_overlap from q""")
def qa_term_overlap(spark, sf_dir):
    p = qa.pairs(read(spark, sf_dir, "conversations"))
    a, b = F.col("question"), F.col("answer")
    return p.select("conv_id", "turn", F.round(tx.term_overlap(a, b), 6).alias("question_overlap"), F.round(tx.term_overlap(b, a), 6).alias("answer_overlap"))


@query()
def qa_diversity(spark, sf_dir):
    """Greatest similarity of each question to another of its conversation."""
    return qa.diversity(qa.pairs(read(spark, sf_dir, "conversations")), ["conv_id"], "turn")


@query("""select conv_id, lag(turn) over w as src_turn, turn as dst_turn, lag(role) over w || '>' || role as step from conversations window w as (partition by conv_id order by turn) qualify lag(turn) over w is not null""")
def turn_follows_edges(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = read(spark, sf_dir, "conversations")
    return c.select("conv_id", F.lag("turn").over(w).alias("src_turn"), F.col("turn").alias("dst_turn"), F.concat(F.lag("role").over(w), F.lit(">"), "role").alias("step")).where("src_turn is not null")


@query("""with q as (select vec_id as q_id, embedding::double[] as e from embeddings where vec_id % 50 = 0), s as (select q_id, vec_id, list_cosine_similarity(q.e, v.embedding::double[]) as c from q, embeddings v where vec_id <> q_id)
select q_id, vec_id, rank, round(c, 6) as cosine from (select *, row_number() over (partition by q_id order by round(c, 9) desc, vec_id) as rank from s) where rank <= 5""")
def cosine_topk(spark, sf_dir):
    """The five nearest vectors of each query vector; the queries, one in fifty, go to every task in blocks."""
    v = _vectors(spark, sf_dir)
    n = v.count()
    found = vector_index.nearest(v.where("id % 50 = 0").select(F.col("id").alias("q_id"), "v"), v, 5, n, -(-n // 50))
    return found.select("q_id", F.col("id").alias("vec_id"), "rank", F.round("c", 6).alias("cosine"))


def _vectors(spark, sf_dir):
    return vector_index.usable(read(spark, sf_dir, "embeddings")).select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("v"))


@query("""with q as (select vec_id as q_id, label as own, embedding::double[] as e from embeddings), s as (select q_id, own, vec_id, label, list_cosine_similarity(q.e, v.embedding::double[]) as c from q, embeddings v where vec_id <> q_id),
t as (select *, row_number() over (partition by q_id order by round(c, 9) desc, vec_id) as rank from s), v as (select q_id, own, label, count(*) as votes from t where rank <= 15 group by all)
select q_id, own, label as vote, votes from v qualify row_number() over (partition by q_id order by votes desc, label) = 1""")
def nearest_label_vote(spark, sf_dir):
    """For every vector, the label that most of its fifteen nearest have."""
    own = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("q_id"), F.col("label").alias("own"))
    v = _vectors(spark, sf_dir)
    votes = vector_index.nearest_of_all(v, 15, v.count()).join(v.select("id", "label"), "id").groupBy("q_id", "label").agg(F.count("*").alias("votes"))
    best = votes.groupBy("q_id").agg(F.min(F.struct((-F.col("votes")).alias("k"), F.col("label").isNull().alias("none"), "label", "votes")).alias("m"))
    return best.join(own, "q_id").select("q_id", "own", F.col("m.label").alias("vote"), "m.votes")


@query("select len(embedding)::int as dimension, count(*) as n, count(*) filter (embedding is not null) as usable from embeddings group by 1")
def embedding_dimension_check(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").groupBy(F.size("embedding").alias("dimension")).agg(F.count("*").alias("n"), F.count("embedding").alias("usable"))


_EDGES = """select 'region/' || r_regionkey as src, 'nation/' || n_nationkey as dst from region join nation on n_regionkey = r_regionkey
union all select 'nation/' || c_nationkey, 'customer/' || c_custkey from customer union all select 'customer/' || o_custkey, 'order/' || o_orderkey from orders"""


def _graph(spark, sf_dir):
    r, n, c, o = (read(spark, sf_dir, t) for t in ("region", "nation", "customer", "orders"))
    key = lambda kind, col: F.concat(F.lit(f"{kind}/"), F.col(col).cast("string"))
    edge = lambda df, s, d: df.select(s.alias("src"), d.alias("dst"))
    first = edge(r.join(n, F.col("n_regionkey") == F.col("r_regionkey")), key("region", "r_regionkey"), key("nation", "n_nationkey"))
    return first.unionByName(edge(c, key("nation", "c_nationkey"), key("customer", "c_custkey"))).unionByName(edge(o, key("customer", "o_custkey"), key("order", "o_orderkey")))


@query(f"""with recursive e as ({_EDGES}), t as (select 'region/' || r_regionkey as root, 'region/' || r_regionkey as key, 0 as depth from region union all select t.root, e.dst, t.depth + 1 from t join e on e.src = t.key where t.depth < 10)
select root, depth::int as depth, count(distinct key) as n from t group by all""")
def graph_traversal_depth(spark, sf_dir):
    """What lies below each region, by depth."""
    roots = read(spark, sf_dir, "region").select(F.concat(F.lit("region/"), F.col("r_regionkey").cast("string")).alias("key"))
    return hierarchy.traverse(_graph(spark, sf_dir), roots, depth=4).groupBy("root", "depth").agg(F.count("*").alias("n"))


@query(f"""with e as ({_EDGES}), v as (select 'region/' || r_regionkey as key from region union all select 'nation/' || n_nationkey from nation union all select 'customer/' || c_custkey from customer where c_custkey % 7 <> 0 union all select 'order/' || o_orderkey from orders)
select split_part(src, '/', 1) as src_kind, split_part(dst, '/', 1) as dst_kind, src in (select key from v) and dst in (select key from v) as whole, count(*) as n from e group by all""")
def graph_edge_integrity(spark, sf_dir):
    """Edges whose ends both exist, and the others; one customer in seven is missing from the vertices."""
    r, n, c, o = (read(spark, sf_dir, t) for t in ("region", "nation", "customer", "orders"))
    key = lambda df, kind, col: df.select(F.concat(F.lit(f"{kind}/"), F.col(col).cast("string")).alias("key"))
    v = key(r, "region", "r_regionkey").union(key(n, "nation", "n_nationkey")).union(key(c.where("c_custkey % 7 <> 0"), "customer", "c_custkey")).union(key(o, "order", "o_orderkey"))
    good, bad = hierarchy.keep_whole_edges(_graph(spark, sf_dir), v)
    kinds = [F.split_part("src", F.lit("/"), F.lit(1)).alias("src_kind"), F.split_part("dst", F.lit("/"), F.lit(1)).alias("dst_kind")]
    return good.withColumn("whole", F.lit(True)).unionByName(bad.withColumn("whole", F.lit(False))).groupBy(*kinds, "whole").agg(F.count("*").alias("n"))


@query("""select n_name, c_mktsegment, o_orderpriority, count(*) as n, sum(round(o_totalprice * 100)::bigint)::bigint as cents from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by grouping sets ((n_name), (c_mktsegment), (n_name, o_orderpriority))""")
def category_rollup(spark, sf_dir):
    j = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupingSets([["n_name"], ["c_mktsegment"], ["n_name", "o_orderpriority"]], "n_name", "c_mktsegment", "o_orderpriority").agg(F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))


@query("""select event_type, count(*) as n, round(avg(value), 6) as mean_value, round(count(*) filter (value > 50) / count(*), 6) as done_share from events where ts >= (select max(ts) - interval 7 day from events) group by event_type""")
def task_latency_rollup(spark, sf_dir):
    """Mean latency and completed share by task type over the last seven days."""
    e = read(spark, sf_dir, "events")
    last = e.agg((F.max("ts") - F.expr("interval 7 days")).alias("since"))
    recent = e.join(F.broadcast(last), F.col("ts") >= F.col("since"))  # one row
    return recent.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_value"), F.round(F.count_if(F.col("value") > 50) / F.count("*"), 6).alias("done_share"))


_REWARD = "0.35 * acc + 0.25 * (1 - least(1.0, sec / 10.0)) + 0.25 * (acc >= 0.5)::int::double + 0.10 * (1 - res) + 0.05 * 0.8"


@query(f"""with s as (select event_id, user_id, ts, least(1.0, value / 100.0) as acc, (event_id % 120) / 10.0 as sec, (event_id % 4) / 4.0 as res from events),
r as (select event_id, user_id, ts, ({_REWARD}) * (case when acc >= 0.5 then 1.0 else 0.5 end) as reward from s),
w as (select event_id, round(reward, 12) as reward, avg(reward) over (partition by user_id order by ts, event_id rows between 19 preceding and current row) as mean20 from r)
select event_id, reward, round(mean20, 12) as mean20, round(mean20, 9) < 0.4 as roll_back from w""")
def strategy_reward(spark, sf_dir):
    """Weighted reward of a strategy's outcome, and the roll-back test on the mean of the last twenty."""
    e = read(spark, sf_dir, "events")
    s = e.select("event_id", "user_id", "ts", F.least(F.lit(1.0), F.col("value") / 100).alias("acc"), (F.col("event_id") % 120 / 10).alias("sec"), (F.col("event_id") % 4 / 4).alias("res"))
    met = (F.col("acc") >= 0.5).cast("double")
    reward = (0.35 * F.col("acc") + 0.25 * (1 - F.least(F.lit(1.0), F.col("sec") / 10)) + 0.25 * met + 0.10 * (1 - F.col("res")) + 0.05 * 0.8) * F.when(met == 1, 1.0).otherwise(0.5)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-19, 0)
    out = s.withColumn("reward", reward).withColumn("mean20", F.avg("reward").over(w))
    return out.select("event_id", F.round("reward", 12).alias("reward"), F.round("mean20", 12).alias("mean20"), (F.round("mean20", 9) < 0.4).alias("roll_back"))


@query("""select event_type, count(*) as n, count(*) filter (json_valid(props)) as parsed, count(*) filter (json_extract_string(props, '$.k') is not null) as has_k, sum(json_extract_string(props, '$.k')::bigint)::bigint as sum_k from events group by 1""")
def json_field_validate(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", F.get_json_object("props", "$.k").alias("k"), F.try_parse_json("props").alias("v"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count("v").alias("parsed"), F.count("k").alias("has_k"), F.sum(F.col("k").cast("bigint")).alias("sum_k"))


# Forty pages, whose boxes grow with the table.
_BOXES = "select p_partkey % 40 as page_id, p_partkey as id, ((p_partkey * 37) % 500)::double as x0, ((p_partkey * 91) % 700)::double as y0, ((p_partkey * 37) % 500 + 20 + p_size * 3)::double as x1, ((p_partkey * 91) % 700 + 10 + p_size)::double as y1 from part"
# Pages of forty boxes at most, forty pages to every 1600 parts.
_SHORT_PAGES = _BOXES.replace("p_partkey % 40 as page_id", "p_partkey // 1600 * 40 + p_partkey % 40 as page_id")
_SHARED = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"


def _boxes(spark, sf_dir, short_pages=False):
    k, s = F.col("p_partkey"), F.col("p_size")
    return read(spark, sf_dir, "part").select((F.floor(k / 1600) * 40 + k % 40 if short_pages else k % 40).alias("page_id"), k.alias("id"), g.box(k * 37 % 500, k * 91 % 700, k * 37 % 500 + 20 + s * 3, k * 91 % 700 + 10 + s).alias("box"))


@query(f"""with bx as ({_BOXES}), l as (select * from bx where id % 3 <> 0), k as (select * from bx where id % 3 = 0),
p as (select a.page_id, a.id as line_id, b.id as block_id, {_SHARED} as shared, sqrt(pow((a.x0 + a.x1 - b.x0 - b.x1) / 2 * 5, 2) + pow((a.y0 + a.y1 - b.y0 - b.y1) / 2, 2)) as apart from l a left join k b on a.page_id = b.page_id),
r as (select page_id, line_id, arg_min(block_id, (-shared, block_id)) filter (shared > 0) as ba, arg_min(block_id, (apart, block_id)) filter (apart < 20) as bd from p group by all)
select page_id, line_id, coalesce(ba, bd) as block_id, case when ba is not null then 'area' when bd is not null then 'distance' end as how from r""")
def line_block_assignment(spark, sf_dir):
    """Lines to the block they share most area with, else to the nearest within a limit."""
    b = _boxes(spark, sf_dir)
    lines = b.where("id % 3 <> 0").select("page_id", F.col("id").alias("line_id"), "box")
    return spatial.assign_lines(lines, b.where("id % 3 = 0").select("page_id", F.col("id").alias("block_id"), "box"), ["page_id"])


@query(f"""with bx as ({_BOXES}), p as (select a.page_id, a.id as a_id, b.id as b_id, {_SHARED} as s, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) as areas from bx a join bx b on a.page_id = b.page_id and a.id % 3 = 1 and b.id % 3 <> 1)
select page_id, a_id, b_id, round(s / (areas - s), 6) as iou from p where s / (areas - s) > 0.2""")
def iou_pairs(spark, sf_dir):
    b = _boxes(spark, sf_dir)
    return spatial.overlapping_pairs(b.where("id % 3 = 1"), b.where("id % 3 <> 1"), ["page_id"], 0.2).withColumn("iou", F.round("iou", 6))


@query(f"""with bx as ({_BOXES}) select a.page_id, a.id from bx a where not exists (select 1 from bx b where b.page_id = a.page_id and b.id <> a.id and b.id % 5 = 0 and a.id % 5 <> 0 and {_SHARED} / ((a.x1 - a.x0) * (a.y1 - a.y0)) > 0.5) and a.id % 5 <> 0""")
def uncovered_blocks(spark, sf_dir):
    """Blocks that no table covers by more than half."""
    b = _boxes(spark, sf_dir)
    return spatial.covered(b.where("id % 5 <> 0"), b.where("id % 5 = 0"), ["page_id"], 0.5).select("page_id", "id")


_CELLS = """select t, r, c, text from (select 'supplier' as t, s_suppkey as r, unnest([s_suppkey::varchar, s_name, s_acctbal::varchar]) as text, unnest([0, 1, 2]) as c from supplier
union all select 'customer', c_custkey, unnest([c_custkey::varchar, c_name, case when c_custkey % 9 = 0 then '' else c_mktsegment end]), unnest([0, 1, 2]) from customer)"""


def _cells(spark, sf_dir):
    s = tables.melt(read(spark, sf_dir, "supplier"), F.lit("supplier"), F.col("s_suppkey"), ["s_suppkey", "s_name", "s_acctbal"])
    c = read(spark, sf_dir, "customer").withColumn("seg", F.when(F.col("c_custkey") % 9 == 0, "").otherwise(F.col("c_mktsegment")))
    return s.unionByName(tables.melt(c, F.lit("customer"), F.col("c_custkey"), ["c_custkey", "c_name", "seg"]))


@query(f"select t as table_id, round(count(*) filter (text is not null and text not in ('', ' ')) / count(*), 6) as completeness from ({_CELLS}) group by 1")
def table_completeness(spark, sf_dir):
    return tables.completeness(_cells(spark, sf_dir), ["table_id"]).withColumn("completeness", F.round("completeness", 6))


@query(rf"""with k as (select t, c, case when trim(text) = '' then 'empty' when regexp_matches(regexp_replace(trim(text), '^([^.]*)\.', '\1'), '^\d+$') then 'numeric' when regexp_matches(trim(text), '^(\d{{1,2}}[/-]\d{{1,2}}[/-]\d{{2,4}}|\d{{4}}[/-]\d{{1,2}}[/-]\d{{1,2}})$') then 'date' else 'text' end as kind from ({_CELLS})),
n as (select t, c, count(*) filter (kind <> 'empty') as n, count(*) filter (kind = 'numeric') as num, count(*) filter (kind = 'date') as dat from k group by all)
select t as table_id, c as col_id, case when n = 0 then 'empty' when num > 0.7 * n then 'numeric' when dat > 0.7 * n then 'date' else 'text' end as column_type from n""")
def table_column_types(spark, sf_dir):
    return tables.column_types(_cells(spark, sf_dir), ["table_id"])


@query(f"""with r as (select t, r, count(*) as wide, count(*) filter (trim(text) <> '') as filled from ({_CELLS}) group by all)
select t as table_id, round((1 / (1 + var_pop(wide)) + sum(filled) / sum(wide)) / 2, 6) as structure from r group by 1""")
def table_structure_score(spark, sf_dir):
    return tables.structure_score(_cells(spark, sf_dir), ["table_id"]).withColumn("structure", F.round("structure", 6))


@query(f"""with r as (select t, r, string_agg(coalesce(text, ''), ',' order by c) as line from ({_CELLS}) group by all) select t as table_id, md5(string_agg(line, chr(10) order by r)) as digest from r group by 1""")
def table_csv(spark, sf_dir):
    return tables.to_csv(_cells(spark, sf_dir), ["table_id"]).select("table_id", F.md5("csv").alias("digest"))


@query(r"""select page_id, trim(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)) as heading, (length(html) - length(replace(html, '<p>', ''))) // 3 as paragraphs, length(html)::int as size from pages""")
def html_headings(spark, sf_dir):
    """First headings and paragraph tags by pattern; html_blocks parses whole pages."""
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", F.trim(F.regexp_extract("html", "<h1[^>]*>([^<]*)</h1>", 1)).alias("heading"), F.floor((F.length("html") - F.length(F.replace("html", F.lit("<p>"), F.lit("")))) / 3).alias("paragraphs"), F.length("html").alias("size"))


@query()
def html_blocks(spark, sf_dir):
    """Blocks of each page by type, from the tokenizer."""
    return html.html_blocks(read(spark, sf_dir, "pages")).groupBy("page_id", "block_type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query()
def html_sections(spark, sf_dir):
    """Sections of each page: title, level, words and hash of the content below."""
    b = html.html_blocks(read(spark, sf_dir, "pages")).where("block_type <> 'TableCell'")
    return hierarchy.section_contents(b, ["page_id"]).select("page_id", "block_ord", "level", "title", "n_words", "reading_minutes", "section_hash")


@query()
def html_markdown(spark, sf_dir):
    b = html.html_blocks(read(spark, sf_dir, "pages"))
    return html.markdown(b, ["page_id"]).select("page_id", F.length("markdown").alias("n_chars"), F.md5("markdown").alias("digest"))


@query(r"""select page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) as lang, regexp_extract(html, '<meta charset="([^"]*)"', 1) as charset from pages""")
def html_page_metadata(spark, sf_dir):
    m = html.html_metadata(read(spark, sf_dir, "pages"))
    return m.select("page_id", F.coalesce(F.col("meta")["lang"], F.lit("")).alias("lang"), F.coalesce(F.col("meta")["charset"], F.lit("")).alias("charset"))


@query()
def html_containment_edges(spark, sf_dir):
    """contains and follows edges among each page's blocks."""
    b = html.html_blocks(read(spark, sf_dir, "pages")).where("block_type <> 'TableCell'")
    return hierarchy.containment_edges(b, ["page_id"])


@query()
def chunk_packing(spark, sf_dir):
    """Chunks of every document, at most 500 estimated tokens each."""
    return chunking.chunk(read(spark, sf_dir, "documents")).select("doc_id", "chunk_no", "n_tokens", F.length("text").alias("n_chars"), "chunk_hash")


_TYPES = " ".join(f"when {' or '.join(f'''contains(lower(text), '{w}')''' for w in words)} then '{name}'" for name, words in rules.DOCUMENT_TYPES.items())


@query(f"select doc_type, lang, count(*) as n from (select case {_TYPES} else 'general_document' end as doc_type, lang from documents) group by all")
def doc_type_inference(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(rules.document_type(F.col("text")).alias("doc_type"), "lang").groupBy("doc_type", "lang").agg(F.count("*").alias("n"))


@query(r"""with d as (select trim(text) <> '' as present, length(text) between 200 and 5000 as length_ok, regexp_matches(text, '^(?:\p{Lu})') as capital, lang in ('en', 'fr', 'de') as lang_ok, n_chars between 1 and 100000 as range_ok from documents)
select rule, count(*) as n, count(*) filter (ok) as n_valid from (select unnest(['present', 'length_ok', 'capital', 'lang_ok', 'range_ok']) as rule, unnest([present, length_ok, capital, lang_ok, range_ok]) as ok from d) group by rule""")
def validation_report(spark, sf_dir):
    """How many documents meet each of a set of field rules."""
    v = validators.RULES
    t = F.col("text")
    checks = {"present": v["present"](t), "length_ok": v["length_between"](t, 200, 5000), "capital": v["matches"](t, r"\p{Lu}"), "lang_ok": v["one_of"](F.col("lang"), ["en", "fr", "de"]), "range_ok": v["in_range"](F.col("n_chars"), 1, 100_000)}
    return validators.report(validators.apply_rules(read(spark, sf_dir, "documents"), checks), list(checks))


@query("""with r as (select o_custkey, row_number() over w1 as truth, row_number() over (partition by o_custkey order by o_totalprice, o_orderkey) as found from orders window w1 as (partition by o_custkey order by o_orderkey)),
n as (select o_custkey, count(*) as n from r group by 1), p as (select a.o_custkey, sum(sign(b.found - a.found)) as s from r a join r b on a.o_custkey = b.o_custkey and a.truth < b.truth group by 1)
select o_custkey, round(case when n <= 1 then 100.0 else (coalesce(s, 0) / (n * (n - 1) / 2) + 1) / 2 * 100 end, 6) as order_score from n left join p using (o_custkey)""")
def reading_order_score(spark, sf_dir):
    """How far each customer's orders by price agree with their order by key."""
    w = lambda *c: Window.partitionBy("o_custkey").orderBy(*c)
    ranks = read(spark, sf_dir, "orders").select("o_custkey", F.row_number().over(w("o_orderkey")).alias("truth"), F.row_number().over(w("o_totalprice", "o_orderkey")).alias("found"))
    return scoring.order_score(ranks, ["o_custkey"]).withColumn("order_score", F.round("order_score", 6))


@query()
def html_page_stats(spark, sf_dir):
    """Block counts by type for each page, as a sorted text."""
    b = html.html_blocks(read(spark, sf_dir, "pages")).withColumn("page_no", F.col("page_id"))
    s = render.page_stats(b.select(F.lit("site").alias("site"), F.col("page_no").alias("page_id"), "block_type"), ["site"])
    return s.select("page_id", F.to_json("counts").alias("counts"))


@query()
def html_toc(spark, sf_dir):
    b = html.html_blocks(read(spark, sf_dir, "pages")).where("block_type = 'SectionHeader'").withColumn("doc", F.col("page_id"))
    return processors.table_of_contents(b, ["doc"]).select(F.col("doc").alias("page_id"), F.size("toc").alias("n_headers"), F.col("toc")[0]["title"].alias("first_title"))


@query("""with f as (select conv_id, count(*) as n, count(*) filter (role = 'user') as users, max(length(text)) as longest from conversations group by 1)
select users, count(*) as n_convs, sum(n)::bigint as turns, max(longest)::int as longest from f group by users""")
def conversation_shape(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.count_if(F.col("role") == "user").alias("users"), F.max(F.length("text")).alias("longest"))
    return c.groupBy("users").agg(F.count("*").alias("n_convs"), F.sum("n").alias("turns"), F.max("longest").alias("longest"))


@query(f"""with bx as ({_BOXES}), p as (select a.id as a_id, b.id as b_id, a.x0 as ax0, a.y0 as ay0, a.x1 as ax1, a.y1 as ay1, b.* from bx a join bx b on a.page_id = b.page_id and (a.id // 40) % 10 = 1 and (b.id // 40) % 10 <> 1)
select a_id, b_id, greatest(0, least(ax1, x1) - greatest(ax0, x0))::double as over_x, greatest(0, least(ay1, y1) - greatest(ay0, y0))::double as over_y,
 round(sqrt(pow(greatest(0, x0 - ax1, ax0 - x1), 2) + pow(greatest(0, y0 - ay1, ay0 - y1), 2)), 6) as gap, round(sqrt(pow((ax0 + ax1 - x0 - x1) / 2, 2) + pow((ay0 + ay1 - y0 - y1) / 2, 2)), 6) as centers, round(sqrt(pow(ax0 - x0, 2) + pow(ay0 - y0, 2)), 6) as corners from p""")
def geometry_measures(spark, sf_dir):
    """Overlaps and distances of pairs of boxes on a page."""
    b = _boxes(spark, sf_dir)
    measures = lambda x, y: [g.overlap_x(x, y).alias("over_x"), g.overlap_y(x, y).alias("over_y"), F.round(g.gap(x, y), 6).alias("gap"), F.round(g.center_distance(x, y), 6).alias("centers"), F.round(g.corner_distance(x, y), 6).alias("corners")]
    return spatial.measured_pairs(b.where("(id div 40) % 10 = 1"), b.where("(id div 40) % 10 <> 1"), ["page_id"], measures).drop("page_id")


@query(f"""with bx as ({_BOXES}) select a.page_id, a.id as ref_id, arg_min(b.id, (sqrt(pow(a.x0 - b.x0, 2) + pow(a.y0 - b.y0, 2)), b.id)) as block_id from bx a join bx b on a.page_id = b.page_id and (a.id // 40) % 4 = 1 and (b.id // 40) % 4 <> 1 group by all""")
def nearest_reference(spark, sf_dir):
    """Each reference's block with the nearest top-left corner."""
    b = _boxes(spark, sf_dir)
    refs = b.where("(id div 40) % 4 = 1").select("page_id", F.col("id").alias("ref_id"), "box")
    return spatial.nearest(refs, b.where("(id div 40) % 4 <> 1").select("page_id", F.col("id").alias("block_id"), "box"), ["page_id"])


@query(f"""with bx as ({_SHORT_PAGES}), w as (select *, lag(x0) over o as px0, lag(y0) over o as py0, lag(x1) over o as px1, lag(y1) over o as py1 from bx window o as (partition by page_id order by id)),
n as (select page_id, id, coalesce(sqrt(pow(greatest(0, x0 - px1, px0 - x1), 2) + pow(greatest(0, y0 - py1, py0 - y1), 2)) > 60, false)::int as new from w)
select page_id, id, sum(new) over (partition by page_id order by id)::bigint as island from n""")
def orphan_line_islands(spark, sf_dir):
    """Consecutive lines that lie close together."""
    return spatial.orphan_islands(_boxes(spark, sf_dir, short_pages=True), ["page_id"], "id", 60.0).select("page_id", "id", F.col("island").cast("bigint").alias("island"))


@query("select user_id, event_id, event_type, round(value, 4) as value from events qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1")
def latest_upsert(spark, sf_dir):
    """The last write for each key."""
    return hierarchy.latest(read(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id").select("user_id", "event_id", "event_type", F.round("value", 4).alias("value"))


@query(r"""with k as (select case when p_partkey % 13 = 0 then '' when p_partkey % 17 = 0 then p_name else 'P' || p_partkey end as key, case when p_partkey % 11 = 0 then '' when p_partkey % 7 = 0 then '9bad' else 'blocks' end as collection from part)
select case when coalesce(key, '') = '' then 'empty key' when length(key) > 254 then 'key too long' when not regexp_matches(key, '^[A-Za-z0-9_:.@()+,=;$!*''%-]+$') then 'character not allowed'
 when not regexp_matches(collection, '^[A-Za-z][A-Za-z0-9_-]*$') then 'bad collection' end as problem, count(*) as n from k group by 1""")
def id_validation(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.expr("case when p_partkey % 13 = 0 then '' when p_partkey % 17 = 0 then p_name else concat('P', p_partkey) end").alias("key"), F.expr("case when p_partkey % 11 = 0 then '' when p_partkey % 7 = 0 then '9bad' else 'blocks' end").alias("collection"))
    return p.select(hierarchy.valid_id(F.col("collection"), F.col("key")).alias("problem")).groupBy("problem").agg(F.count("*").alias("n"))


_NUMERIC = r"regexp_matches(regexp_replace(trim(text), '^([^.]*)\.', '\1'), '^\d+$')"


@query(rf"""with c as (select t, c, count(*) as n, count(*) filter ({_NUMERIC}) as num, count(*) filter (not {_NUMERIC} and trim(text) <> '') as others from ({_CELLS}) group by all)
select t as table_id, case when bool_or(n >= 3 and num > 0.5 * n and others > 0) then 0.8 else 1.0 end::double as purity from c group by 1""")
def table_purity(spark, sf_dir):
    return tables.purity_penalty(_cells(spark, sf_dir), ["table_id"]).select("table_id", F.col("purity").cast("double").alias("purity"))


@query(rf"""with w as (select t, count(*) as n_rows, min(wide) = max(wide) as even from (select t, r, count(*) as wide from ({_CELLS}) group by all) group by 1),
c as (select t, avg((num = 0 or num = n)::int::double) as pure from (select t, c, count(*) as n, count(*) filter ({_NUMERIC}) as num from ({_CELLS}) group by all) group by 1)
select t as table_id, round(case when even then 0.7 else 0 end + case when n_rows >= 3 then 0.3 * pure else 0.3 end, 6)::double as consistency from w join c using (t)""")
def table_consistency(spark, sf_dir):
    return tables.consistency(_cells(spark, sf_dir), ["table_id"]).select("table_id", F.round("consistency", 6).alias("consistency"))


@query(f"""with l as (select t, unnest(string_split(coalesce(text, ''), chr(10))) as line from ({_CELLS}))
select t as table_id, round(avg(length(line) - length(ltrim(line))), 6) as leading, round(avg(length(line) - length(rtrim(line))), 6) as trailing, round(avg(len(regexp_extract_all(trim(line), ' {{2,}}'))), 6) as inner_runs, count(distinct length(line) - length(ltrim(line))) <= 2 as consistent from l group by 1""")
def table_whitespace(spark, sf_dir):
    w = tables.whitespace_patterns(_cells(spark, sf_dir), ["table_id"])
    return w.select("table_id", *[F.round(c, 6).alias(c) for c in ("leading", "trailing", "inner_runs")], "consistent")


@query(r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n from documents), w as (select *, lead(line) over (partition by doc_id order by n) as nxt from l)
select doc_id, count(*) as n_lines, count(*) filter (regexp_matches(line, '[-—¬]\s*$') and regexp_matches(nxt, '^\s*\p{Ll}')) as hyphenated, count(*) filter (regexp_matches(nxt, '^\s*\p{Ll}')) as lower_starts from w group by 1""")
def line_continuations(spark, sf_dir):
    """Lines that end in a hyphen before a lower-case start, and all lower-case starts."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    w = Window.partitionBy("doc_id").orderBy("n")
    nxt = F.lead("line").over(w)
    return lines.select("doc_id", F.coalesce(tx.starts_as_continuation(F.col("line"), nxt), F.lit(False)).alias("h"), F.coalesce(nxt.rlike(r"^\s*\p{Ll}"), F.lit(False)).alias("l")).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if("h").alias("hyphenated"), F.count_if("l").alias("lower_starts"))


_FLAGS = "case when p_partkey % 9 = 0 then null when p_partkey % 5 = 0 then 68 when p_partkey % 7 = 0 then 524352 else (p_partkey * 2654435761) % 1048576 end"


@query(f"""with f as (select p_partkey as part_id, ({_FLAGS})::bigint as f, case when p_partkey % 4 = 0 then 'Times-BoldItalic' when p_partkey % 4 = 1 then 'Arial-Bold' else p_name end as n from part),
k as (select part_id, n, f & 983151 as f, f is null or (f & 983151) in (0, 524288, 36 + 32, 524288 + 68) as p from (select part_id, n, f from f)),
s as (select part_id, (not p and f & 262144 <> 0) or contains(lower(n), 'bold') as bold, (not p and f & 64 <> 0) or contains(lower(n), 'ital') as italic, p or f & 720939 <> 0 as plain from k)
select part_id, concat_ws(',', case when bold then 'bold' end, case when italic then 'italic' end, case when plain then 'plain' end) as styles from s""")
def font_styles(spark, sf_dir):
    """Styles of fonts from their flags and names."""
    p = read(spark, sf_dir, "part").select("p_partkey", F.expr(_FLAGS).cast("bigint").alias("f"), F.expr("case when p_partkey % 4 = 0 then 'Times-BoldItalic' when p_partkey % 4 = 1 then 'Arial-Bold' else p_name end").alias("n"))
    return p.select(F.col("p_partkey").alias("part_id"), F.array_join(tx.font_styles(F.col("f"), F.col("n")), ",").alias("styles"))


@query("""with p as (select p_partkey, p_size as a, p_partkey % 30 as b from part), r as (select p_partkey, a as page from p union select p_partkey, unnest(generate_series(b, b + 4)) from p)
select p_partkey as part_id, string_agg(page::varchar, ',' order by page) as pages from r group by 1""")
def page_ranges(spark, sf_dir):
    """Page lists such as "7,12-16" written out."""
    text = F.concat(F.col("p_size").cast("string"), F.lit(", "), (F.col("p_partkey") % 30).cast("string"), F.lit("-"), (F.col("p_partkey") % 30 + 4).cast("string"))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_id"), F.array_join(F.transform(tx.page_numbers(text), lambda n: n.cast("string")), ",").alias("pages"))


@query("""with p as (select p_brand as doc, p_partkey as page_id, p_partkey % 11 > 1 or p_size > 40 as good from part)
select doc, page_id, case when good or avg(good::int) over (partition by doc) > 0.85 then 'layer' else 'recognition' end as source from p""")
def text_source_choice(spark, sf_dir):
    """Which pages keep their own text, by page and by document."""
    p = read(spark, sf_dir, "part").select(F.col("p_brand").alias("doc"), F.col("p_partkey").alias("page_id"), ((F.col("p_partkey") % 11 > 1) | (F.col("p_size") > 40)).alias("good"))
    return layout.text_source(p, ["doc"]).select("doc", "page_id", "source")


@query(f"""with bx as ({_BOXES}), b as (select * from bx where (id // 40) % 4 = 0 or page_id = 3), t as (select b.page_id, b.id, count(*) filter (a.id is not null and {_SHARED} > 0) as n from b left join (select * from bx where (id // 40) % 4 <> 0 and page_id <> 3) a on a.page_id = b.page_id group by all)
select page_id, round(avg((n >= 1)::int), 6) as coverage, avg((n >= 1)::int) >= 0.25 as covered from t group by 1""")
def layout_coverage(spark, sf_dir):
    """How many layout blocks of each page any line touches."""
    b = _boxes(spark, sf_dir)
    blocks = b.where("(id div 40) % 4 = 0 or page_id = 3").select("page_id", F.col("id").alias("block_id"), "box", F.lit("Text").alias("block_type"), g.box(*[F.lit(v) for v in (0, 0, 700, 900)]).alias("page_box"))
    return layout.layout_coverage(blocks, b.where("(id div 40) % 4 <> 0 and page_id <> 3"), ["page_id"]).select("page_id", F.round("coverage", 6).alias("coverage"), F.coalesce("covered", F.lit(False)).alias("covered"))


@query(f"""with bx as ({_BOXES}), k as (select b.page_id, arg_min(a.id, (-{_SHARED}, a.id)) as id from bx a join bx b on a.page_id = b.page_id and (a.id // 40) % 3 <> 1 and (b.id // 40) % 3 = 1 where {_SHARED} > 0 group by b.page_id, b.id)
select l.page_id, l.id as line_id, l.y1 - l.y0 <= 2 * (l.x1 - l.x0) and exists (select 1 from k where k.page_id = l.page_id and k.id = l.id) as math from bx l where (l.id // 40) % 3 <> 1""")
def math_line_marks(spark, sf_dir):
    """Lines that hold the better part of a formula."""
    b = _boxes(spark, sf_dir)
    return layout.mark_math_lines(b.where("(id div 40) % 3 <> 1").select("page_id", F.col("id").alias("line_id"), "box"), b.where("(id div 40) % 3 = 1").select("page_id", F.col("id").alias("formula_id"), "box"), ["page_id"]).select("page_id", "line_id", "math")


@query(f"""with bx as ({_BOXES}) select a.page_id, a.id from bx a where (a.id // 40) % 3 <> 1 and not exists (select 1 from bx b where b.page_id = a.page_id and (b.id // 40) % 3 = 1
 and {_SHARED} / ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {_SHARED}) > 0.2)""")
def missed_tables(spark, sf_dir):
    """Boxes of a second finder that the first has no match for."""
    b = _boxes(spark, sf_dir)
    return layout.missed_boxes(b.where("(id div 40) % 3 = 1"), b.where("(id div 40) % 3 <> 1"), ["page_id"], 0.2).select("page_id", "id")


@query("""select p_partkey % 40 as page_id, p_partkey as id, row_number() over (partition by p_partkey % 40 order by p_size < 10, p_partkey) - 1 as place from part""")
def footnotes_at_end(spark, sf_dir):
    """Places of blocks on their pages once footnotes stand last."""
    b = read(spark, sf_dir, "part").select((F.col("p_partkey") % 40).alias("page_id"), F.col("p_partkey").alias("id"), F.when(F.col("p_size") < 10, "Footnote").otherwise("Text").alias("block_type"))
    return layout.footnotes_last(b, ["page_id"], "id").select("page_id", "id", F.col("place").cast("bigint").alias("place"))


@query("""with t as (select l_returnflag as table_id, l_linestatus as flavor, l_linenumber as scale, round(avg(l_discount) * 16, 9) as score from lineitem group by all)
select table_id, flavor, scale, round(score, 6) as score from t qualify row_number() over (partition by table_id order by case when score >= 0.9 then 0 end nulls last, score desc, flavor, scale) = 1""")
def best_parameter_search(spark, sf_dir):
    """Each table's best pair of parameters of all that were tried."""
    t = read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("table_id"), F.col("l_linestatus").alias("flavor"), F.col("l_linenumber").alias("scale")).agg(F.round(F.avg("l_discount") * 16, 9).alias("score"))
    return tables.best_parameters(t, ["table_id"], ["flavor", "scale"]).withColumn("score", F.round("score", 6))


@query("""with r as (select user_id, event_id, event_type <> 'click' as trial, value, event_type = 'error' or event_id % 17 = 0 as failed from events),
w as (select user_id, event_id, avg(case when trial then value end) over l as m, avg(failed::int) over (partition by user_id order by event_id) as e, count(*) filter (trial) over l as k, row_number() over (partition by user_id order by event_id) as n
 from r window l as (partition by user_id order by event_id rows between 19 preceding and current row))
select user_id, event_id, round(m, 6) as trial_mean, round(e, 6) as error_rate, coalesce(n >= 10 and k >= 5 and (m < 50 or e > 0.1), false) as roll_back from w""")
def canary_rollback_window(spark, sf_dir):
    """Whether a rollout would go back after each request."""
    r = read(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_type") != "click").alias("trial"), F.col("value").alias("performance"), ((F.col("event_type") == "error") | (F.col("event_id") % 17 == 0)).alias("failed"))
    return rollout.rollbacks(r, ["user_id"], "event_id", performance=50.0).select("user_id", "event_id", F.round("trial_mean", 6).alias("trial_mean"), F.round("error_rate", 6).alias("error_rate"), "roll_back")


@query("""select 't' as table_id, row_id, col_id, text from (select n_nationkey as row_id, unnest([0, 1]) as col_id, unnest([n_nationkey::varchar, n_name]) as text from nation
union all select 25 + r_regionkey, unnest([0, 1]), unnest([r_regionkey::varchar, r_name]) from region)""")
def joined_tables(spark, sf_dir):
    """Two tables as one, the second below the first."""
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    first = tables.melt(n, F.lit("t"), F.col("n_nationkey").cast("int"), ["n_nationkey", "n_name"])
    return tables.join_cells(first, tables.melt(r, F.lit("t"), F.col("r_regionkey").cast("int"), ["r_regionkey", "r_name"]), ["table_id"])


@query(r"""select event_id, case when event_id % 5 = 0 then null else props end as answer from events""")
def json_answers(spark, sf_dir):
    """The JSON inside answers that surround it with words, fence it, or break it off."""
    props = F.col("props").cast("string")
    said = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("no "), F.substring(props, 1, 3))).when(F.col("event_id") % 5 == 1, F.concat(F.lit("Here it is: "), props, F.lit(" - done")))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit("```json\n"), props, F.lit("\n```"))).when(F.col("event_id") % 5 == 3, F.regexp_replace(F.concat(F.lit("x"), props), r"\}$", ", }")).otherwise(props)
    )
    return read(spark, sf_dir, "events").select("event_id", tx.json_slice(said).alias("answer"))


@query()
def section_trees(spark, sf_dir):
    """Headers of pages with what they stand below."""
    return graph.section_tree(html.html_blocks(read(spark, sf_dir, "pages")), ["page_id"])


@query()
def section_subsections(spark, sf_dir):
    return graph.subsections(html.html_blocks(read(spark, sf_dir, "pages")), ["page_id"])


def _page_blocks(spark, sf_dir):
    return html.html_blocks(read(spark, sf_dir, "pages")).withColumn("doc_id", F.col("page_id"))


@query()
def graph_vertices(spark, sf_dir):
    return graph.vertices(_page_blocks(spark, sf_dir), "doc_id")


@query()
def graph_edges(spark, sf_dir):
    return graph.edges(_page_blocks(spark, sf_dir), "doc_id")


@query()
def page_structure(spark, sf_dir):
    return layout.structure_statistics(_page_blocks(spark, sf_dir), ["doc_id"]).withColumn("counts", F.to_json("counts"))


@query()
def page_content(spark, sf_dir):
    return layout.content_statistics(_page_blocks(spark, sf_dir), ["doc_id"]).withColumn("counts", F.to_json("counts"))


@query()
def qa_accuracy(spark, sf_dir):
    """How far answers keep to their questions' words."""
    p = qa.pairs(read(spark, sf_dir, "conversations"))
    score = qa.accuracy(F.col("answer"), F.col("question"), F.lit("text"), F.col("seq"))
    return p.withColumn("seq", sim.fuzzy(F.col("answer"), F.col("question"), "sequence")).select("conv_id", "turn", score.alias("a")).select("conv_id", "turn", F.round("a.score", 6).alias("score"), "a.passed")
