"""Rules, processors, validators, chunks, scores, rendering and the stream, on literal fixtures."""

import math

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import geometry as g
from docloom.operators import chunking, processors, render, rules, scoring, validators
from docloom.streaming import arrivals


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_types(spark):
    kinds = {"Abstract and methods": "research_paper", "Invoice no. 5": "invoice", "This AGREEMENT": "legal_contract", "quarterly report": "business_report", "installation": "technical_manual", "hello": "general_document"}
    for text, kind in kinds.items():
        assert one(spark, rules.document_type(F.lit(text))) == kind


def test_code_language(spark):
    samples = {
        '{"a": [1]}': "json", "<?xml version='1.0'?><a/>": "xml", "def f(x) -> int:\n  return x": "python", "SELECT a FROM t WHERE b": "sql", "#!/bin/bash\necho hi": "bash",
        "const f = (x) => x;": "javascript", "interface A { b: string }": "typescript", "package main\nfunc main() { fmt.Println() }": "go", "just words": "text",
    }
    for text, language in samples.items():
        assert one(spark, rules.code_language(F.lit(text)))["language"] == language, text


def test_routes(spark):
    assert one(spark, rules.math_complexity(F.lit("\\begin{x}\n\\int"), F.lit(0.5))) == 1.0
    assert one(spark, rules.route(F.lit("Table"), F.lit(0.9))) == "model" and one(spark, rules.route(F.lit("Text"), F.lit(0.9))) == "default"
    config = lambda *v: one(spark, rules.recommended_config(*map(F.lit, v)))
    assert [config(True, True, 3, 8, 10, "low", 9), config(True, True, 20, 8, 10, "low", 9), config(True, True, 13, 6, 60, "low", 9), config(False, True, 20, 8, 10, "low", 9)] == ["disabled", "accuracy", "tables_only", "disabled"]
    assert one(spark, rules.region_type(F.lit("text"), [F.lit(True), F.lit(None).cast("boolean"), F.lit(True)], [])) == "code"
    assert math.isclose(one(spark, rules.reward(F.lit(1.0), F.lit(0.0), F.lit(0.5), F.lit(0.0))), 0.99)


def test_repeated_edges(spark):
    rows = [("d", p, k, "Text", t) for p in range(6) for k, t in enumerate([f"Running Header {p}", f"body of page {p}", f"unique end {'abcdef'[p]}"])]
    got = processors.repeated_edges(spark.createDataFrame(rows, "doc string, page_id int, block_ord int, block_type string, text string"), ["doc"]).collect()
    assert all(r.ignore == (r.block_ord == 0) for r in got) and len(got) == 18


def test_line_numbers(spark):
    rows = [(1, k, 0.0, str(k)) for k in range(5)] + [(1, k, 10.0, "word") for k in range(6)] + [(2, 0, 0.0, "7"), (2, 1, 0.0, "x"), (2, 2, 0.0, "y")]
    got = processors.line_number_spans(spark.createDataFrame(rows, "page int, line_id int, x0 double, text string"), ["page"]).collect()
    assert {r.text for r in got if r.ignore} == {"0", "1", "2", "3", "4"}
    assert one(spark, processors.is_line_number_block(F.lit("1 2 3 4 a"), g.box(*map(F.lit, (0, 0, 5, 50))))) is True


def test_quotes_and_order(spark):
    rows = [(0, "Text", 0, 0, 10), (1, "Text", 20, 12, 20), (2, "Text", 20, 22, 30), (3, "Text", 0, 32, 40), (4, "Footnote", 0, 42, 50), (5, "PageHeader", 0, 0, 1)]
    b = spark.createDataFrame([(1, o, t, float(x), float(y0), float(y1)) for o, t, x, y0, y1 in rows], "page int, block_ord int, block_type string, x double, y0 double, y1 double")
    b = b.select("page", "block_ord", "block_type", g.box("x", "y0", F.lit(90), "y1").alias("box"), F.lit(100.0).alias("page_width"))
    got = {r.block_ord: (r.quote, r.quote_level) for r in processors.blockquotes(b, ["page"]).collect()}
    assert got[0] == (False, 0) and got[1] == got[2] == (True, 1) and got[3] == (False, 0)
    order = {r.block_ord: r.read_ord for r in processors.reading_order(b, ["page"]).collect()}
    assert order[5] == 0 and order[4] == 5


def test_code_and_corpus(spark):
    lines = spark.createDataFrame([(1, 0, 0.0, 40.0, "if x:"), (1, 1, 32.0, 80.0, "y = 1 ")], "b int, line_no int, x0 double, x1 double, text string")
    assert processors.indent_code(lines, ["b"]).first().code == "if x:\n    y = 1"
    b = spark.createDataFrame([("d", "this text is in the corpus"), ("d", "something else entirely, not there"), ("d", "short")], "doc string, text string")
    c = spark.createDataFrame([("d", "before this text is in the corpus after")], "doc string, full_text string")
    assert [r.text[:9] for r in processors.missing_from_corpus(b, c, ["doc"]).collect()] == ["something"]


def test_validators(spark):
    df = spark.createDataFrame([("one two", '{"a": 1, "b": 2}', "$x$ {y}"), (None, "{", "{")], "t string, j string, l string")
    r = validators.RULES
    out = validators.apply_rules(df, {"p": r["present"](F.col("t")), "n": r["length_between"](F.col("t"), 3), "w": r["words_in"](F.col("t"), ["one", "two"]), "f": r["json_fields"](F.col("j"), ["a"]), "x": r["balanced_latex"](F.col("l"))})
    assert [row.valid for row in out.collect()] == [True, False]
    assert {row.rule: row.n_valid for row in validators.report(out, ["p", "f"]).collect()} == {"p": 1, "f": 1}
    b = spark.createDataFrame([("old text", True), ("old text", False)], "text string, pick boolean")
    good = validators.rewrite(b, "form", F.col("pick"), lambda t: F.upper(t)).collect()
    assert [(x.text, x.rejected) for x in good] == [("OLD TEXT", False), ("old text", False)]
    bad = validators.rewrite(b, "form", F.col("pick"), lambda t: F.lit("x")).collect()
    assert [(x.text, x.rejected) for x in bad] == [("old text", True), ("old text", False)]


@given(st.text(alphabet="abc .!?\n", max_size=200), st.integers(1, 20))
def test_chunks_keep_all_words(text, most):
    got = list(chunking.packed(text, most))
    assert " ".join(b for b, _ in got).split() == text.split()


def test_sections_of_chunks(spark):
    text = "intro\n**1. First**\nSome text. More.\n**1.1 Second one**\nEnd."
    assert [(a, b) for a, b, _ in chunking.sections(text)] == [("1.", "First"), ("1.1", "Second one")]
    rows = chunking.chunk(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string")).collect()
    assert [(r.section, r.text) for r in rows] == [("1.", "Some text. More."), ("1.1", "End.")]


def test_scores(spark):
    v = spark.createDataFrame([("a", "b", "a"), ("b", "a", "a"), ("a", "b", "b")], "method_a string, method_b string, winner string")
    r = scoring.win_rates(v).first()
    assert (r.method_a, r.n, r.a_wins) == ("a", 3, 2)
    ranks = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1), (3, 1, 1)], "doc int, truth int, found int")
    assert {r.doc: r.order_score for r in scoring.order_score(ranks, ["doc"]).collect()} == {1: 100.0, 2: 0.0, 3: 100.0}


def test_render(spark):
    assert one(spark, render.merge_tags(F.lit("<b><i>a</i></b><b><i>b</i></b>"))) == "<b><i>ab</i></b>"
    assert one(spark, render.span_html(F.lit("a<b"), F.array(F.lit("bold")), F.lit("u"), F.lit(False))) == "<a href='u'><b>a&lt;b</b></a>"
    b = spark.createDataFrame([("d", 1, 0, "SectionHeader", 2, "T"), ("d", 1, 1, "Text", None, "x"), ("d", 2, 2, "PageFooter", None, "f")], "doc string, page_id int, block_ord int, block_type string, level int, text string")
    assert render.html(b, ["doc"]).first().html == "<h2>T</h2>\n<p>x</p>"
    assert '"pages":[{"page_id":1' in render.json_tree(b, ["doc"]).first().json
    m = spark.createDataFrame([("1.0", "5", None, None, None, None), ("2.1", None, "t", "{}", "{}", "{}")], "version string, data string, timestamp string, payload string, metadata string, routing string")
    a, z = render.migrate(m).orderBy("version", F.col("data").isNull(), "payload").collect()
    assert {a.version, z.version} == {"2.1"} and '{"data":5}' in (a.payload, z.payload)


def test_stream(spark, tmp_path):
    schema = "doc_id int, text string, lang string, arrived timestamp"
    spark.sql("select * from values (1, 'a', 'en', timestamp'2024-01-01 00:00:00'), (1, 'a', 'en', timestamp'2024-01-01 00:05:00'), (2, 'b', 'en', timestamp'2024-01-01 00:06:00') as t(doc_id, text, lang, arrived)").coalesce(1).write.parquet(str(tmp_path / "in"))
    q = arrivals.append_to(arrivals.arriving(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
