"""Lines, lists, table checks, graphs and searches on literal fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.functions import geometry as g
from docloom.functions.similarity import best_window, indel_ratio
from docloom.functions.stems import stem_of
from docloom.operators import graph, hierarchy, lines, table_checks, table_merge, text_index, vector_index


def rows(df, *names):
    return sorted(tuple(r[c] for c in names) for r in df.collect())


def boxed(spark, data, schema):
    return spark.createDataFrame(data, f"{schema}, x0 double, y0 double, x1 double, y1 double").withColumn("box", g.box("x0", "y0", "x1", "y1"))


def test_broken_lines(spark):
    data = [
        ("b", 0, "x", 0.0, 0.0, 50.0, 10.0), ("b", 1, "+", 48.0, 0.0, 90.0, 10.0), ("b", 2, "y", 88.0, 1.0, 140.0, 10.0),  # a chain: each overlaps the one before
        ("b", 3, "next", 0.0, 20.0, 100.0, 30.0), ("b", 4, "tall", 10.0, 0.0, 12.0, 90.0), ("b", 5, "far", 300.0, 20.0, 340.0, 30.0), ("c", 0, "one", 0.0, 0.0, 9.0, 9.0),
    ]
    got = lines.merge_broken_lines(boxed(spark, [*data, ("c", 1, "none", None, None, None, None)], "block string, line_ord int, text string"), ["block"])
    assert rows(got.where("block = 'b'"), "line_ord", "text", "n_lines", "math") == [(0, "x+y", 3, True), (3, "next", 1, False), (4, "tall", 1, False), (5, "far", 1, False)]
    assert rows(got.where("block = 'c'"), "line_ord", "n_lines") == [(0, 1), (1, 1)]


def test_order_of_merging_matters(spark):
    """A line that doesn't join ends the merge, stays alone and opens none: the next one does."""
    data = [("b", 0, "a", 0.0, 0.0, 50.0, 10.0), ("b", 1, "low", 0.0, 30.0, 50.0, 40.0), ("b", 2, "c", 45.0, 0.0, 90.0, 10.0), ("b", 3, "d", 85.0, 0.0, 130.0, 10.0)]
    got = lines.merge_broken_lines(boxed(spark, data, "block string, line_ord int, text string"), ["block"])
    assert rows(got, "line_ord", "text") == [(0, "a"), (1, "low"), (2, "cd")]


def test_formula_lines(spark):
    data = [("p", 0, "a", 0.0, 0.0, 40.0, 10.0), ("p", 1, "b", 40.0, 2.0, 80.0, 12.0), ("p", 2, "c", 0.0, 30.0, 40.0, 40.0), ("p", 3, "out", 0.0, 90.0, 40.0, 100.0), ("p", 4, "alone", 200.0, 0.0, 240.0, 10.0)]
    found = boxed(spark, [("p", 7, False, 0.0, 0.0, 90.0, 40.0), ("p", 8, True, 195.0, 0.0, 250.0, 10.0)], "page string, found_id int, math boolean")
    got = lines.merge_formula_lines(boxed(spark, data, "page string, line_ord int, text string"), found, ["page"])
    assert rows(got, "line_ord", "text", "n_lines", "math") == [(0, "ab", 2, True), (2, "c", 1, False), (3, "out", 1, False), (4, "alone", 1, True)]


def test_one_list_over_two_pages(spark):
    data = [("d", 0, "ListGroup", 0, 20.0, 500.0, 290.0, 690.0), ("d", 1, "PageFooter", 0, 0.0, 690.0, 600.0, 700.0), ("d", 2, "ListGroup", 1, 20.0, 10.0, 290.0, 200.0), ("d", 3, "Text", 1, 20.0, 200.0, 290.0, 300.0), ("d", 4, "ListGroup", 1, 20.0, 300.0, 290.0, 400.0), ("d", 5, "ListGroup", 1, 320.0, 10.0, 590.0, 100.0)]
    groups = boxed(spark, data, "doc string, block_ord int, block_type string, page_id int").withColumns({"page_width": F.lit(600.0), "page_height": F.lit(700.0)})
    assert rows(lines.continued_lists(groups, ["doc"]), "block_ord", "list_id") == [(0, 0), (2, 0), (4, 4), (5, 4)]
    items = spark.createDataFrame([(0, 0, 20.0, 20.0), (0, 1, 40.0, 20.0), (0, 2, 340.0, 320.0), (0, 3, 360.0, 320.0), (0, 4, 320.0, 320.0), (0, 5, 323.0, 320.0)], "list_id int, item int, x0 double, column_x0 double").withColumn("page_width", F.lit(600.0))
    assert rows(lines.nested_levels(items, ["list_id"], "item"), "item", "level") == [(0, 0), (1, 1), (2, 1), (3, 2), (4, 0), (5, 0)]


TABLES = {
    "plain": ("<p><TABLE><thead><tr><th>a<th>b</tr></thead><tr><td>1</td><td>2</td></tr></table>", []),
    "collide": ("<table><tr><td>a</td><td rowspan=2>b</td></tr><tr><td colspan='2'>c</td></tr></table>", ["no header", "rows of unequal length", "cells overlap"]),
    "holes": ("<table><tr><th colspan=3>a</th></tr><tr><td>b</td></tr></table>", ["places without a cell"]),
    "down": ("<table><tr><td rowspan=9>a</td><td>b</td></tr><tr><td>c</td></tr></table>", ["no header", "rows of unequal length"]),
    "zero": ("<table><tr><td rowspan='0'>a</td><th>b</th></tr><tr><td>c</td></tr><tr><td>d</td></tr></table>", ["rows of unequal length"]),
    "none": ("<p>no grid</p>", ["no table"]),
    "empty": ("<table></table>", ["no table"]),
    "null": (None, ["no table"]),
}


def test_table_checks(spark):
    t = spark.createDataFrame([(k, h) for k, (h, _) in TABLES.items()], "t string, html string")
    got = {r.t: r for r in table_checks.check_tables(t, table_checks.html_cells(t, ["t"]), ["t"], need_header=True).collect()}
    assert {k: got[k].problems for k in TABLES} == {k: want for k, (_, want) in TABLES.items()}
    assert (got["collide"].width, got["collide"].n_overlaps, got["holes"].n_holes, got["down"].n_holes, got["plain"].valid) == (2, 1, 2, 0, True)
    cells = table_checks.html_cells(t, ["t"]).where("t = 'plain'")
    assert rows(cells, "row_id", "ord", "is_header", "text") == [(0, 0, True, "a"), (0, 1, True, "b"), (1, 0, False, "1"), (1, 1, False, "2")]
    bounds = table_checks.check_tables(t, table_checks.html_cells(t, ["t"]), ["t"], min_rows=3, max_rows=2, min_cols=3, max_cols=1).where("t = 'plain'").first()
    assert bounds.problems == ["too few rows", "too few columns", "too many columns"]


# Words and stems that the algorithm's author gives.
STEMS = (
    "caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss "
    "fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic differentli differ vileli vile "
    "analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic "
    "formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit "
    "replacement replac adjustment adjust dependent depend adoption adopt communism commun activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll"
).split()


def test_stems(spark):
    pairs = list(zip(STEMS[::2], STEMS[1::2], strict=True)) + [("it", "it"), ("naïve", "naïve"), ("", "")]
    got = spark.createDataFrame(pairs, "word string, want string").withColumn("got", F.expr(stem_of("word")))
    assert got.where("got <> want").collect() == []


def test_stemmed_search(spark, tmp_path):
    docs = spark.createDataFrame([(1, "The cats were running. Cats run!"), (2, "A running cat"), (3, "running dogs"), (4, None), (5, "cat 5 dog run")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "cat run"), (2, "Cats"), (3, "unicorn cat"), (4, "!!"), (5, "run run")], "query_id long, text string")
    text_index.write_index(docs, f"{tmp_path}/i", parts=4)
    got = text_index.search(text_index.read_index(spark, f"{tmp_path}/i"), asked)
    assert rows(got, "query_id", "doc_id", "n_hits", "phrase") == [(1, 1, 4, True), (1, 2, 2, False), (1, 5, 2, False), (2, 1, 2, True), (2, 2, 1, True), (2, 5, 1, True), (5, 1, 2, False), (5, 2, 1, False), (5, 3, 1, False), (5, 5, 1, False)]


def brute(x, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = u @ u.T
    np.fill_diagonal(c, -2)
    return {(q, v, rank + 1) for q in range(0, len(x), 20) for rank, v in enumerate(sorted(range(len(x)), key=lambda j: (-round(c[q, j], 9), j))[:k])}


@pytest.mark.parametrize("tight", [True, False])
def test_vector_index(spark, tmp_path, tight):
    """All nearest vectors are found; where vectors lie in groups, under a fifth of the lists is read for it."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((24, 16))[rng.integers(0, 24, 700)] + 0.05 * rng.standard_normal((700, 16)) if tight else rng.standard_normal((700, 16))
    x[5] = x[6]
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16)], "id long, v array<double>")
    v = vector_index.usable(v, "v")
    q = v.where("id % 20 = 0").select(F.col("id").alias("q_id"), "v")
    assert {(r.q_id, r.id, r["rank"]) for r in vector_index.nearest(q, v, 5, 50_000, 5_000).collect()} == brute(x, 5)
    vector_index.write_index(v, f"{tmp_path}/v", lists=24)
    found, read = vector_index.search(spark, f"{tmp_path}/v", q, 5)
    assert {(r.q_id, r.id, r["rank"]) for r in found.collect()} == brute(x, 5)
    n_lists = spark.read.parquet(f"{tmp_path}/v/lists").count()
    if tight:
        assert read.count() < q.count() * n_lists / 5


def test_partial_ratio_equals_all_stretches():
    def slow(a, b):
        short, long = sorted((a, b), key=len)
        if not short or short in long:
            return 100.0 if short or not long else 0.0
        n = len(short)
        return max(indel_ratio(short, s) for s in {long[max(0, k) : k + n] for k in range(1 - n, len(long))})

    rng = random.Random(2)
    for _ in range(1500):
        a, b = "".join(rng.choices("abcd ", k=rng.randrange(14))), "".join(rng.choices("abcde ", k=rng.randrange(40)))
        assert abs(best_window(a, b) - slow(a, b)) < 1e-9


def test_traversal_of_cycles(spark):
    edges = spark.createDataFrame([(k, (k + 1) % 30) for k in range(30)] + [(0, 5), (3, 3)], "src int, dst int")
    roots = spark.createDataFrame([(0,), (100,)], "key int")
    got = {(r.root, r.key): r.depth for r in hierarchy.traverse(edges, roots, 10).collect()}
    assert got == {(100, 100): 0} | {(0, k): min(k, 1 + abs(k - 5) if k >= 5 else k) for k in range(15)}


def test_label_edges(spark):
    b = spark.createDataFrame(
        [("d", 0, 0, "Text", "see Table 1 later"), ("d", 0, 1, "Caption", "Table 1: old"), ("d", 0, 2, "SectionHeader", "2.1 Things"), ("d", 1, 3, "Caption", "Table 1 again, after Table 1"), ("d", 1, 4, "Text", "é Table 1, Section 2.1, Figure 9"), ("e", 0, 0, "Text", "Table 1")],
        "doc string, page_id int, block_ord int, block_type string, text string",
    )
    assert rows(graph.label_edges(b, "doc"), "src", "dst", "label", "position") == [
        ("caption_d_1_3", "caption_d_0_1", "Table 1", 21), ("text_d_1_4", "caption_d_1_3", "Table 1", 2), ("text_d_1_4", "section_header_d_0_2", "Section 2.1", 11),
    ]


def test_table_chains_and_titles(spark):
    t = [("d", 0, 1, 2, "1", "5", 600.0, 690.0), ("d", 1, 2, 2, "6", "9", 0.0, 100.0), ("d", 2, 2, 3, "a", "b", 110.0, 200.0), ("d", 3, 4, 3, None, None, 0.0, 50.0)]
    t = spark.createDataFrame(t, "doc string, table_ord int, page_id int, n_columns int, first_cell string, last_cell string, y0 double, y1 double").withColumns({"page_height": F.lit(700.0), "box": g.box(F.lit(0), "y0", F.lit(100), "y1")})
    pairs = table_merge.neighbour_pairs(t, ["doc"])
    assert rows(pairs, "a", "b", "confidence", "candidate", "merge") == [(0, 1, 1.0, True, True), (1, 2, 0.6, False, False)]
    assert rows(table_merge.merge_chains(t, pairs, ["doc"]), "table_ord", "chain") == [(0, 0), (1, 0), (2, 2), (3, 3)]
    b = [("d", 0, "Table", ""), ("d", 1, "SectionHeader", "Head"), ("d", 2, "Text", "Some words. We give data here. End"), ("d", 3, "Table", ""), ("d", 4, "Table", None), ("d", 5, "Text", "x"), ("d", 6, "Caption", " Table 2 "), ("d", 7, "Table", "")]
    got = table_merge.table_titles(spark.createDataFrame(b, "doc string, block_ord int, block_type string, text string"), ["doc"])
    assert [(r.block_ord, r.title, r.source) for r in got.orderBy("block_ord").collect()] == [
        (0, None, "none"), (3, "Inferred: We give data here", "inferred_from_preceding_paragraph"), (4, "Inferred: We give data here", "inferred_from_preceding_paragraph"), (7, "Table 2", "caption_above"),
    ]


def test_blocks_of_vectors_meet(spark, monkeypatch):
    """With several blocks of vectors and of queries each query still meets every vector."""
    monkeypatch.setattr(vector_index, "VECTORS", 20)
    monkeypatch.setattr(vector_index, "QUERIES", 5)
    x = np.random.default_rng(4).normal(size=(90, 6))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    got = vector_index.nearest(v.where("id % 5 = 0").select(F.col("id").alias("q_id"), "v"), v, 4, 90, 18).collect()
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = units @ units.T
    np.fill_diagonal(c, -2)
    assert {(r.q_id, r["rank"], r.id) for r in got} == {(i, k + 1, int(j)) for i in range(0, 90, 5) for k, j in enumerate(np.argsort(-c[i])[:4])}


def test_shares_at_the_limit(spark):
    """A line's overlaps add up in the order of lines, whatever order they come in: 0.1 + 0.2 + 0.3 isn't 0.3 + 0.2 + 0.1."""
    plans = lines.merge_broken_lines(spark.createDataFrame([(1, 0, "a", (0.0, 0.0, 10.0, 1.0))], "block int, line_ord int, text string, box struct<x0:double,y0:double,x1:double,y1:double>"), ["block"])
    plan = plans._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(_s" not in plan


def test_postings_are_dealt_by_text(spark):
    """Whole texts are dealt, not each of their words: one exchange by document and one by stem."""
    docs = spark.createDataFrame([(1, "Runs run running"), (2, "a run"), (3, None)], "doc_id long, text string")
    out = text_index.postings(docs)
    assert rows(out, "stem", "doc_id", "positions") == rows(spark.createDataFrame([("run", 1, [0, 1, 2]), ("a", 2, [0]), ("run", 2, [1])], "stem string, doc_id long, positions array<int>"), "stem", "doc_id", "positions")
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert [line.count("word") for line in plan.splitlines() if "Exchange" in line] == [0, 0]


@pytest.mark.parametrize("size", [20, 1000])
def test_every_vector_is_asked(spark, monkeypatch, size):
    """Blocks meet once and look both ways; of many equal vectors the smallest ids come first, and itself is left out."""
    monkeypatch.setattr(vector_index, "VECTORS", size)
    x = np.random.default_rng(6).normal(size=(90, 6))
    x[40:60] = x[40]
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = np.round(units @ units.T, 9)
    want = {(q, rank + 1, i) for q in range(90) for rank, i in enumerate(sorted((i for i in range(90) if i != q), key=lambda i: (-c[q, i], i))[:4])}
    assert {(r.q_id, r["rank"], r.id) for r in vector_index.nearest_of_all(v, 4, 90).collect()} == want


def test_every_vector_has_a_vote(spark, tmp_path):
    """nearest_label_vote asks every vector of the table, not one in fifty; votes that tie go to the smaller label, none last."""
    import duckdb

    from docloom.plans.queries import ORACLE_SQL, QUERIES

    data = [(i, [float(a) for a in r], None if i % 4 == 0 else i % 4) for i, r in enumerate(np.random.default_rng(8).normal(size=(120, 5)))]
    spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = sorted((tuple(r) for r in QUERIES["nearest_label_vote"](spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(duck.execute(ORACLE_SQL["nearest_label_vote"]).fetchall(), key=str)
    assert [r[0] for r in sorted(got)] == list(range(120))


def test_stem_of_one_word_equals_the_steps(spark):
    """porter() gives what the SQL steps give: the author's words, and made ones with each ending."""
    from docloom.functions import stems as st

    r, ends = random.Random(3), [*st.ENDINGS_2, *st.ENDINGS_3, *st.ENDINGS_4, "ion", "sion", "tion", "ed", "ing", "eed", "s", "ies", "sses", "y", "e", "ll", ""]
    words = sorted({"".join(r.choice("aeiouybcdlrstzx") for _ in range(r.randint(0, 5))) + e + r.choice(["", "", *ends]) for e in ends for _ in range(40)} | {"Ab", "naïve", "it", "ab c"} | set(STEMS))
    got = spark.createDataFrame([(w, st.porter(w)) for w in words], "word string, got string").withColumn("want", F.expr(stem_of("word")))
    assert got.where("got <> want").collect() == []


@pytest.mark.parametrize("at_once", [1, 500_000])
def test_a_text_is_folded_to_postings(spark, tmp_path, monkeypatch, at_once):
    """The index gets a row for each stem of a document, whatever the batches: no row for each of its words leaves the fold."""
    monkeypatch.setattr(text_index, "_WORDS", at_once, raising=False)
    data = [(2, "Runs run; running \u0130 K\u212aing"), (1, "a run"), (3, None), (4, "!"), (2, "cat run"), (None, "cats cat"), (5, "ABLE able")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    want = [(1, "a", [0]), (1, "run", [1]), (2, "cat", [0]), (2, "ing", [4]), (2, "k", [3]), (2, "run", [0, 1, 1, 2]), (5, "abl", [0, 1]), (None, "cat", [0, 1])]
    assert sorted((tuple(r) for r in text_index.postings(docs).select("doc_id", "stem", "positions").collect()), key=str) == sorted(want, key=str)
    text_index.write_index(docs, f"{tmp_path}/i", parts=3)
    assert sorted((tuple(r) for r in text_index.read_index(spark, f"{tmp_path}/i").select("doc_id", "stem", "positions").collect()), key=str) == sorted(want, key=str)
    assert "posexplode" not in text_index.postings(docs)._jdf.queryExecution().toString()


def test_search_looks_up_asked_stems_only(spark, tmp_path):
    """Only rows of the index with an asked stem go into the join; phrases are found where stems repeat, at a text's start and end."""
    docs = spark.createDataFrame([(1, "run cat run cat dog"), (2, "dog cat run"), (3, "cat dog run cat"), (4, "bird")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "cat run cat"), (2, "cats dogs"), (3, "run"), (4, "")], "query_id long, text string")
    text_index.write_index(docs, f"{tmp_path}/i", parts=4)
    got = text_index.search(text_index.read_index(spark, f"{tmp_path}/i"), asked)
    want = [(1, 1, 4, True), (1, 2, 2, False), (1, 3, 3, False), (2, 1, 3, True), (2, 2, 2, False), (2, 3, 3, True), (3, 1, 2, True), (3, 2, 1, True), (3, 3, 1, True)]
    assert rows(got, "query_id", "doc_id", "n_hits", "phrase") == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 3
