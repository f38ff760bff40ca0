"""Table merging, search, Markdown sections and tree similarity on literal fixtures."""

from pyspark.sql import functions as F

from docloom.functions import geometry as g
from docloom.functions.trees import tree_similarity
from docloom.operators import markdown, scoring, search, spatial, table_merge, tables


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_merge(spark):
    rows = [("d", 0, 1, 50.0, 950.0, ["a", "b"], "1 2\n3 4", "1 2", "3 4"), ("d", 1, 2, 0.0, 300.0, ["a", "b"], "5 6\n7 8", "5 6", "7 8"), ("d", 2, 5, 0.0, 300.0, ["z"], "q", "q", "q")]
    t = spark.createDataFrame(rows, "doc string, table_ord int, page_id int, y0 double, y1 double, header array<string>, body string, first_row string, last_row string")
    t = t.withColumn("box", g.box(F.lit(0), "y0", F.lit(100), "y1")).withColumn("page_height", F.lit(1000.0))
    pairs = table_merge.merge_candidates(t, ["doc"])
    assert [(r.a, r.b, r.merge) for r in pairs.collect()] == [(0, 1, True)]
    assert [(r.table_ord, r.into) for r in table_merge.merged_into(pairs, ["doc"]).collect()] == [(1, 0)]


def test_greedy(spark):
    p = spark.createDataFrame([("d", 0, 1, 0.9, True), ("d", 1, 2, 0.9, True), ("d", 0, 3, 0.9, True), ("d", 2, 4, 0.1, False)], "doc string, a int, b int, score double, merge boolean")
    assert sorted((r.table_ord, r.into) for r in table_merge.merged_into(p, ["doc"]).collect()) == [(1, 0), (3, 0)]


def test_search(spark):
    b = spark.createDataFrame([(0, 1, "Text", "Alpha"), (1, 1, "Code", "beta"), (2, 2, "Text", "gamma")], "block_ord int, page_id int, block_type string, text string")
    got = search.find(b, text="ALPHA", block_type="Code").collect()
    assert [(r.block_ord, r.reasons) for r in got] == [(0, "text contains ALPHA"), (1, "type is Code")]
    assert search.find(b).count() == 0 and search.by_fields(b, {"page_id": 2, "block_type": "Text"}).count() == 1


def test_markdown(spark):
    text = "# Top\nintro\n```\n# no heading\n```\n**Abstract of things**\nbody\n## Two words\nend"
    got = markdown.sections(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string")).orderBy("block_ord").collect()
    assert [(r.title, r.level) for r in got] == [("Top", 1), ("Abstract of things", 1), ("Two words", 2)]
    assert one(spark, markdown.cleaned(F.lit("**Bold** [link](u) <span>x</span>  $y$"))) == "bold link x y"
    assert one(spark, markdown.unfenced_json(F.lit('say ```json\n{"a": 1}\n``` end'))).strip() == '{"a": 1}'
    s = spark.createDataFrame([("d", 10, 100), ("d", 10, 300)], "doc string, n int, size int")
    assert abs(markdown.agreement(s, ["doc"], ["n", "size"]).first().agreement - 0.75) < 1e-9


def test_tree_similarity():
    t = "<table><tr><td>a</td><td>b</td></tr></table>"
    assert tree_similarity(t, t) == 1.0 and tree_similarity(None, "") == 1.0
    assert abs(tree_similarity(t, "<table><tr><td>a</td></tr></table>") - (1 - 1 / 5)) < 1e-9
    assert tree_similarity(t, t.replace(">b<", ">c<")) == 1 - 1 / 5


def test_append_html_body(spark):
    body = "<table><tbody><tr>{}</tr></tbody></table>"
    rows = [(body.format(1), body.format(2)), (body.format(1), "<tbody>2</tbody>"), ("1</tbody>2</tbody>3", body.format(2)), ("plain", body.format(2)), (body.format(1), "</tbody><tbody>"), (None, "x")]
    found = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string").select("i", tables.append_html_body(F.col("a"), F.col("b")).alias("h")).orderBy("i").collect()
    assert [r["h"] for r in found] == [
        "<table><tbody><tr>1</tr><tr>2</tr></tbody></table>", body.format(1) + "\n<tbody>2</tbody>", "1</tbody>2<tr>2</tr></tbody>3",
        "plain\n" + body.format(2), body.format(1) + "\n</tbody><tbody>", None,
    ]


def test_to_json(spark):
    cells = spark.createDataFrame([(1, 0, 0, "a", True), (1, 0, 1, "a", True), (1, 1, 0, 'x"', False), (1, 1, 1, None, False), (1, 2, 0, "only", None), (2, 0, 0, "y", None)], "t int, row_id int, col_id int, text string, is_header boolean")
    found = {r["t"]: r["json"] for r in tables.to_json(cells, ["t"]).collect()}
    assert found == {1: '{"headers":["a","a"],"rows":[{"a":""},{"a":"only"}]}', 2: '{"headers":[],"rows":[["y"]]}'}
    assert tables.to_json(cells.limit(0), ["t"]).count() == 0


def test_new_blocks(spark):
    lines = spark.createDataFrame([(1, 0, (0.0, 0.0, 10.0, 10.0)), (1, 1, (0.0, 10.0, 10.0, 20.0)), (1, 3, (0.0, 20.0, 10.0, 30.0)), (1, 4, None), (2, 0, (0.0, 0.0, 1.0, 1.0))], "page int, line_ord int, box struct<x0:double,y0:double,x1:double,y1:double>")
    others = spark.createDataFrame([(1, 7, (0.0, 90.0, 10.0, 100.0)), (1, 8, (12.0, 20.0, 22.0, 30.0))], "page int, block_id int, box struct<x0:double,y0:double,x1:double,y1:double>")
    found = spatial.new_blocks(lines, others, ["page"]).orderBy("page", "first_line").collect()
    assert [(r["page"], r["first_line"], r["n_lines"], r["after"]) for r in found] == [(1, 0, 2, 8), (1, 3, 1, 8), (1, 4, 1, None), (2, 0, 1, None)]
    assert tuple(found[0]["box"]) == (0.0, 0.0, 10.0, 20.0)
    assert spatial.new_blocks(lines.limit(0), others, ["page"]).count() == 0


def test_run_performance(spark):
    steps = spark.createDataFrame([(1, "t", 1.25, True, True, False), (1, "t", None, True, False, False), (1, "m", 0.5, False, True, True), (2, "m", None, None, None, None)], "run int, feature string, seconds double, is_analysis boolean, is_successful boolean, is_fallback boolean")
    assert sorted(map(tuple, scoring.feature_times(steps, ["run"]).collect())) == [(1, "m", 0.5), (1, "t", 1.3), (2, "m", 0.0)]
    assert sorted(map(tuple, scoring.run_performance(steps, ["run"]).collect())) == [(1, 1.8, 2, 1, 1, 0.9), (2, 0.0, 0, 0, 0, 0.0)]
