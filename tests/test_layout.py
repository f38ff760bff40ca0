"""Layout, graph, table, text, program and rollout operators on small literal fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from docloom.functions import geometry as g
from docloom.functions import similarity as sim
from docloom.functions import text as tx
from docloom.operators import graph, layout, programs, qa, rollout, spatial, tables
from docloom.sources import files

BOX = "box struct<x0:double,y0:double,x1:double,y1:double>"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_measures_of_missing_boxes(spark):
    a, none = g.box(*map(F.lit, (0, 0, 10, 10))), F.lit(None).cast("struct<x0:double,y0:double,x1:double,y1:double>")
    assert one(spark, g.intersection_area(a, none)) is None
    assert one(spark, g.gap(none, a)) is None
    lines = spark.createDataFrame([(1, 1, (0.0, 0.0, 1.0, 1.0))], f"page int, line_id int, {BOX}")
    assert rows(spatial.assign_lines(lines, spark.createDataFrame([], f"page int, block_id int, {BOX}"), ["page"]), "block_id", "how") == [(None, None)]


def test_usable_pages(spark):
    whole, small = (0.0, 0.0, 100.0, 100.0), (0.0, 0.0, 10.0, 10.0)
    objects = spark.createDataFrame(
        [(1, "text", small, whole, None, True, "Arial"), (2, "image", small, whole, None, None, None), (3, "text", small, whole, True, True, "Arial"), (4, "text", small, whole, False, False, "Arial"),
         (5, "text", small, whole, False, True, "GlyphLessFont"), (6, "text", small, whole, False, True, "Arial"), (6, "image", (0.0, 0.0, 100.0, 70.0), whole, None, None, None)],
        f"page int, kind string, {BOX}, page_{BOX}, hidden boolean, embedded boolean, font string",
    )
    assert rows(layout.usable_pages(objects, ["page"]), "page", "usable") == [(1, True), (2, False), (3, True), (4, True), (5, True), (6, True)]
    assert [p for p, ok in rows(layout.usable_pages(objects, ["page"], strip_hidden=True), "page", "usable") if ok] == [1]


def test_layout_coverage_of_blank_pages(spark):
    whole = (0.0, 0.0, 100.0, 100.0)
    blocks = spark.createDataFrame([(1, 1, whole, "Text", whole), (2, 1, (0.0, 0.0, 10.0, 10.0), "Text", whole)], f"page int, block_id int, {BOX}, block_type string, page_{BOX}")
    lines = spark.createDataFrame([], f"page int, {BOX}")
    assert rows(layout.layout_coverage(blocks, lines, ["page"]), "page", "coverage", "covered") == [(1, 0.0, True), (2, 0.0, False)]


def test_list_levels(spark):
    items = [(1, 0, (10.0, 0.0, 90.0, 5.0)), (1, 1, (20.0, 10.0, 90.0, 15.0)), (1, 2, (30.0, 20.0, 90.0, 25.0)), (1, 3, (20.5, 30.0, 90.0, 35.0)), (1, 4, (10.0, 40.0, 90.0, 45.0)),
             (1, 5, (110.0, 0.0, 190.0, 5.0)), (1, 6, (120.0, 10.0, 190.0, 15.0)), (2, 0, (10.0, 0.0, 90.0, 5.0))]
    found = layout.list_levels(spark.createDataFrame(items, f"list int, block_ord int, {BOX}").withColumn("page_width", F.lit(200.0)), ["list"])
    assert rows(found, "list", "block_ord", "level") == [(1, 0, 0), (1, 1, 1), (1, 2, 2), (1, 3, 1), (1, 4, 0), (1, 5, 0), (1, 6, 1), (2, 0, 0)]


def test_footnote_marks(spark):
    spans = spark.createDataFrame([(1, 0, "1"), (1, 1, "2 more"), (2, 0, "see"), (3, 0, None)], "block int, span_ord int, text string")
    assert rows(layout.footnote_marks(spans, ["block"]), "block", "span_ord", "superscript") == [(1, 0, True), (1, 1, False), (2, 0, False), (3, 0, False)]


BLOCKS = [("d", 0, 0, "SectionHeader", 1, "A"), ("d", 0, 1, "Text", None, "a text"), ("d", 0, 2, "SectionHeader", 2, "B"), ("d", 1, 3, "TableCell", None, None), ("d", 1, 4, "SectionHeader", 2, "C"),
          ("d", 1, 5, "SectionHeader", 3, "D"), ("d", 1, 6, "SectionHeader", 1, "E")]


@pytest.fixture(scope="module")
def blocks(spark):
    return spark.createDataFrame(BLOCKS, "doc_id string, page_id int, block_ord int, block_type string, level int, text string")


def test_section_tree(blocks):
    tree = rows(graph.section_tree(blocks, ["doc_id"]), "block_ord", "parent_ord", "depth", "n_children")
    assert tree == [(0, None, 0, 2), (2, 0, 1, 0), (4, 0, 1, 1), (5, 4, 2, 0), (6, None, 0, 0)]
    assert rows(graph.subsections(blocks, ["doc_id"]), "block_ord", "subsections") == [(0, [2, 4]), (2, []), (4, [5]), (5, []), (6, [])]


def test_graph_records(spark, blocks, tmp_path):
    v, e = graph.vertices(blocks, "doc_id"), graph.edges(blocks, "doc_id")
    assert v.count() == v.select("key").distinct().count() == 1 + 2 + 7
    assert e.count() == e.select("key").distinct().count() == 2 + 7 + 5
    keys = {r.key for r in v.collect()}
    assert all(r.src in keys and r.dst in keys for r in e.collect())
    assert {(r.src, r.dst) for r in e.where("src like 'section%'").collect()} >= {("section_header_d_0_0", "text_d_0_1"), ("section_header_d_0_2", "table_cell_d_1_3")}
    assert {r.collection for r in v.collect()} == {"documents", "pages", "sections", "content"}
    graph.write_graph(v, e, str(tmp_path))
    kept, joined = graph.read_graph(spark, str(tmp_path))
    assert rows(kept, *v.columns) == rows(v, *v.columns) and rows(joined, *e.columns) == rows(e, *e.columns)


def test_statistics(blocks):
    content = layout.content_statistics(blocks, ["doc_id"], first_sections=2, first_chars=8).first()
    assert content.counts == {"SectionHeader": 5, "TableCell": 1, "Text": 1} and content.sections == ["A", "B"] and content.head == "A\na text"
    first = layout.structure_statistics(blocks, ["doc_id"]).where("page_id = 0").first()
    assert (first.n_blocks, first.counts, first.has_toc) == (3, {"SectionHeader": 2, "Text": 1}, False)


def test_join_cells(spark):
    cells = lambda r, c: spark.createDataFrame([("t", i, j, f"{i}{j}") for i in range(r) for j in range(c)], "t string, row_id int, col_id int, text string")
    right = tables.join_cells(cells(2, 2), cells(3, 1), ["t"], "right")
    assert rows(right, "row_id", "col_id") == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 2)]
    assert tables.join_cells(cells(2, 2), cells(2, 4), ["t"]).count() == 4  # too many columns apart
    assert tables.join_cells(cells(0, 0), cells(2, 2), ["t"]).count() == 4


def test_spread_spans(spark):
    cells = spark.createDataFrame([("t", 0, 0, 2, 1, "a"), ("t", 0, 1, 1, 2, "b"), ("t", 1, 0, 1, 1, "c"), ("t", 1, 1, 9, 9, "d"), ("t", 1, 2, 1, 1, "e")], "t string, row_id int, col_id int, rowspan int, colspan int, text string")
    got = rows(tables.spread_spans(cells, ["t"]), "text", "row_id", "col_id", "rowspan", "colspan")
    assert got[:3] == [("a", 0, 0, 2, 1), ("b", 0, 1, 1, 2), ("c", 1, 1, 1, 1)]
    assert got[3][:4] == ("d", 1, 2, 1)  # cut at the table's edges


def test_best_parameters(spark):
    grid = tables.parameter_grid(spark, {"scale": [15, 40], "flavor": ["x", "y"]})
    assert grid.count() == 4
    trials = spark.createDataFrame([("t", 1, 0.5, 0), ("t", 2, 0.91, 1), ("t", 3, 0.95, 2), ("u", 1, None, 0), ("u", 2, 0.2, 1)], "t string, p int, score double, k int")
    assert rows(tables.best_parameters(trials, ["t"], ["p"]), "t", "p") == [("t", 3), ("u", 2)]
    assert rows(tables.best_parameters(trials, ["t"], ["p"], order="k"), "t", "p") == [("t", 2), ("u", 2)]


def test_text_helpers(spark):
    assert one(spark, tx.page_numbers(F.lit("0,5-7, 6 , x,9-8"))) == [0, 5, 6, 7]
    assert one(spark, tx.page_numbers(F.lit(None).cast("string"))) == []
    assert one(spark, tx.escape_latex(F.lit(r"50% of a_b \x"))) == r"50\% of a\_b \\x"
    assert one(spark, tx.font_styles(F.lit(1 << 18 | 1 << 6).cast("bigint"), F.lit(None).cast("string"))) == ["bold", "italic"]
    assert one(spark, tx.font_styles(F.lit(None).cast("bigint"), F.lit("Foo-Bold"))) == ["bold", "plain"]
    assert one(spark, tx.json_slice(F.lit('so: {"a": [1, 2, ], } there'))) == '{"a": [1, 2]}'
    assert one(spark, tx.json_slice(F.lit("nothing"))) is None
    assert one(spark, tx.json_slice(F.lit(None).cast("string"))) is None


def test_vectors_and_matches(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("",)], "t string").withColumn("v", sim.hash_embedding(F.col("t"), 16))
    v = [r.v for r in df.collect()]
    assert v[0] == v[1] != v[2] and v[3] is None and abs(sum(x * x for x in v[4]) - 1) < 1e-9
    choices = F.array(F.lit("Smith John 1999"), F.lit("Other"), F.lit(None))
    assert one(spark, sim.best_match(F.lit("John Smith 1999"), choices)).asDict() == {"choice": "Smith John 1999", "score": 100.0}
    assert one(spark, sim.best_match(F.lit("zzz"), choices)) is None
    assert one(spark, sim.best_match(F.lit(None).cast("string"), choices)) is None


def test_qa_accuracy(spark):
    score = lambda a, c, kind="text", seq=0.5, **more: one(spark, qa.accuracy(F.lit(a), F.lit(c), F.lit(kind), F.lit(seq), **more))["score"]
    assert abs(score("one two", "one three") - (0.6 * 0.5 + 0.2 + 0.1)) < 1e-9
    assert abs(score("one two", "one three", "table") - (0.6 * 0.7 + 0.3)) < 1e-9
    assert abs(score("one two three", "one", "code") - (0.6 * (1 / 3 + 0.3) + 0.3)) < 1e-9
    blocks_ = F.array(F.lit("one two"), F.lit(None), F.lit("one"))
    assert abs(score("one two", "one", corpus=F.lit("one two"), blocks=blocks_) - (0.6 * (0.6 * 0.65 + 0.4) + 0.3)) < 1e-9
    assert score("", "one") == 0 and score("one", None) == 0


def test_programs(spark):
    code = 'class A:\n    """doc"""\n    def f(self, x, *y, k=1):\n        return x\n\nasync def g(): pass\n'
    found = one(spark, programs.python_definitions(F.lit(code)))
    assert [(d.kind, d.name, d.parent, d.parameters, d.docstring) for d in found] == [("class", "A", None, [], "doc"), ("function", "f", "A", ["self", "x", "y", "k"], None), ("function", "g", None, [], None)]
    assert one(spark, programs.python_definitions(F.lit("def ("))) is None
    assert one(spark, programs.python_definitions(F.lit(None).cast("string"))) == []
    assert one(spark, programs.python_error(F.lit("x = 1"))) is None and one(spark, programs.python_error(F.lit("x ="))).startswith("line 1")
    b = spark.createDataFrame([("d", 1, "Code", "go", "b"), ("d", 0, "Code", "go", "a"), ("d", 2, "Code", "", None), ("d", 3, "Text", None, "t")], "doc string, block_ord int, block_type string, language string, text string")
    assert rows(programs.by_language(b, ["doc"]), "language", "n_blocks", "code") == [("go", 2, "a\n\nb"), ("text", 1, "")]


def test_rollout(spark):
    requests = spark.createDataFrame([("g", k, True, 0.9 if k < 8 else 0.0, None) for k in range(12)], "g string, k int, trial boolean, performance double, failed boolean")
    assert [k for k, back in rows(rollout.rollbacks(requests, ["g"], "k", performance=0.7), "k", "roll_back") if back] == [10, 11]
    plans = [("fast", 0.5, 0.2), ("good", 2.0, 0.6), ("best", 4.0, 0.9)]
    pick = lambda s, sec, res: one(spark, rollout.within_limits(F.lit(s), plans, F.lit(10), F.lit(sec).cast("double"), F.lit(res).cast("double")))
    assert [pick("best", 50, 1.0), pick("best", 20, 1.0), pick("best", None, 0.6), pick("best", None, None), pick("best", 1, None)] == ["best", "fast", "fast", "best", "best"]
    assert [one(spark, rollout.backoff_seconds(F.lit(n))) for n in (0, 3, 9)] == [1.0, 8.0, 60.0]


def test_files(spark, tmp_path):
    (tmp_path / "qa.jsonl").write_text(json.dumps({"instruction": "q", "input": "", "output": "a", "metadata": {"k": "v"}}) + "\nbroken\n")
    assert [(r.instruction, r.metadata) for r in files.read_qa_lines(spark, str(tmp_path / "qa.jsonl")).collect()] == [("q", {"k": "v"})]
    files.write_rendered(spark.createDataFrame([(2, "# B", "t2"), (1, "# A", "t1")], "doc_id int, markdown string, title string"), str(tmp_path / "out"))
    assert rows(spark.read.parquet(str(tmp_path / "out/markdown")), "doc_id", "text") == [(1, "# A"), (2, "# B")]
    assert rows(spark.read.parquet(str(tmp_path / "out/meta")), "doc_id", "title") == [(1, "t1"), (2, "t2")]
    assert not (tmp_path / "out/html").exists()


def test_question_words_end_at_accents_too(spark):
    """As in the SQL, only ASCII letters, digits and underscores go on a word: `Doí` begins with `do`."""
    answer = F.lit("Una de dos palabras")
    score = lambda q: one(spark, tx.qa_quality(F.lit(q), answer))
    assert score("Doí osja raez que") == score("Do osja raez que") == score("Dogs osja raez que") + 0.1


@pytest.mark.parametrize("name", ["uncovered_blocks", "nearest_reference", "iou_pairs"])
def test_pages_grow_with_the_table(spark, tmp_path, name):
    """More parts give longer pages, not more of them, and every box of a page counts."""
    import duckdb

    from docloom.plans.queries import ORACLE_SQL, QUERIES

    duck = duckdb.connect()
    duck.execute(f"copy (select i as p_partkey, (i * 7 % 50 + 1)::int as p_size from range(3400) t(i)) to '{tmp_path}/part.parquet' (format parquet)")
    duck.execute(f"create view part as select * from read_parquet('{tmp_path}/part.parquet')")
    want = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    want = sorted((tuple(r) for r in want.fetchall()), key=str)
    assert {r[names.index("page_id")] for r in want} <= set(range(40))
    assert rows(QUERIES[name](spark, str(tmp_path)), *names) == want


def test_equal_boxes_are_all_assigned(spark):
    """Lines and blocks of equal boxes: each line has the smallest block_id, and lines that meet nothing stay."""
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    same, far = (0.0, 0.0, 10.0, 10.0), (500.0, 500.0, 510.0, 510.0)
    lines = spark.createDataFrame([(1, 1, same), (1, 2, same), (1, 3, far), (1, 4, None), (2, 5, same)], f"page int, line_id int, box {box}")
    blocks = spark.createDataFrame([(1, 9, same), (1, 8, same), (1, 7, None)], f"page int, block_id int, box {box}")
    assert rows(spatial.assign_lines(lines, blocks, ["page"]), "line_id", "block_id", "how") == [(1, 8, "area"), (2, 8, "area"), (3, None, None), (4, None, None), (5, None, None)]
    pairs = spatial.overlapping_pairs(lines.withColumnRenamed("line_id", "id"), blocks.withColumnRenamed("block_id", "id"), ["page"])
    assert rows(pairs, "a_id", "b_id", "iou") == [(1, 8, 1.0), (1, 9, 1.0), (2, 8, 1.0), (2, 9, 1.0)]


def test_line_numbers_deal_more_pages_to_more_tasks(spark, monkeypatch):
    """Tasks grow with the spans, and pages are dealt once; marks are the same however many there are."""
    from docloom.operators import processors

    spans = spark.createDataFrame([(p, n, x, str(n) if x == 0 and (p < 5 or n % 2) else "w") for p in range(20) for n in range(10) for x in (0.0, 1.0)], "page int, line_id int, x0 double, text string")
    whole = rows(processors.line_number_spans(spans, ["page"]), "page", "line_id", "x0", "ignore")
    monkeypatch.setattr(processors, "_TASK_ROWS", 100)
    dealt = processors.line_number_spans(spans, ["page"])
    assert dealt.rdd.getNumPartitions() == 5
    assert rows(dealt, "page", "line_id", "x0", "ignore") == whole
    assert {r[:2] for r in whole if r[3]} == {(p, n) for p in range(5) for n in range(10)}


@pytest.mark.parametrize("name", ["geometry_measures", "layout_coverage", "math_line_marks"])
def test_forty_pages_hold_the_whole_table(spark, tmp_path, name):
    """Boxes of a page meet however far apart their keys lie, in code and SQL: forty pages at any size."""
    import duckdb

    from docloom.plans.queries import ORACLE_SQL, QUERIES

    duck = duckdb.connect()
    duck.execute(f"copy (select i as p_partkey, (i * 7 % 50 + 1)::int as p_size from range(3400) t(i)) to '{tmp_path}/part.parquet' (format parquet)")
    duck.execute(f"create view part as select * from read_parquet('{tmp_path}/part.parquet')")
    want = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    want = sorted((tuple(r) for r in want.fetchall()), key=str)
    got = rows(QUERIES[name](spark, str(tmp_path)), *names)
    assert got == want
    if name == "geometry_measures":
        pairs = {(r[names.index("a_id")], r[names.index("b_id")]) for r in got}
        assert len(pairs) == len(got) == sum(a % 40 == b % 40 for a in range(3400) if a // 40 % 10 == 1 for b in range(3400) if b // 40 % 10 != 1)
    else:
        assert {r[names.index("page_id")] for r in got} == set(range(40))


def test_pairs_of_one_page_are_dealt_to_many_tasks(spark, monkeypatch):
    """Pairs of one page are made in as many tasks as they take, each once; equal boxes keep all their rows."""
    for name, n in (("_SIDE", 16), ("_LIST", 3), ("_TASK_PAIRS", 200)):
        monkeypatch.setattr(spatial, name, n, raising=False)
    at = lambda i: (float(i % 7), float(i % 3), float(i % 7 + 4), float(i % 3 + 5))
    data = [(1, i, at(i)) for i in range(120)] + [(2, i, at(i)) for i in range(5)] + [(1, 7, at(7)), (1, 500, None), (2, None, at(1)), (None, 501, at(1))]
    b = spark.createDataFrame(data, f"page int, id int, {BOX}")
    low, high = b.where("id < 60"), b.where("id >= 60 or id is null or page = 2")
    measures = lambda x, y: [g.corner_distance(x, y).alias("far")]
    got = spatial.measured_pairs(low, high, ["page"], measures, F.col("far") < 4)
    one = [r for r in data if r[1] is not None and r[1] < 60 and r[0] and r[2]]
    other = [r for r in data if (r[1] is None or r[1] >= 60 or r[0] == 2) and r[0] and r[2]]
    far = lambda p, q: ((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** 0.5
    want = [(p, i, j, far(x, y)) for p, i, x in one for q, j, y in other if p == q and far(x, y) < 4]
    assert rows(got, "page", "a_id", "b_id", "far") == sorted(want, key=str)
    used = got.select(F.spark_partition_id().alias("k")).distinct().count()
    assert used > 10
