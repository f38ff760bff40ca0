"""Small literal fixtures for operators that the tables don't discriminate."""

import io
import zipfile

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import geometry as g
from docloom.functions import similarity as sim
from docloom.functions import text as tx
from docloom.operators import hierarchy, qa, spatial, tables
from docloom.sources import html, hub, office


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_geometry(spark):
    a, b = g.box(*map(F.lit, (0, 0, 10, 10))), g.box(*map(F.lit, (5, 5, 15, 25)))
    assert one(spark, g.intersection_area(a, b)) == 25
    assert one(spark, g.intersection_share(a, b)) == 0.25
    assert abs(one(spark, g.iou(a, b)) - 25 / 275) < 1e-12
    assert one(spark, g.gap(a, g.box(*map(F.lit, (13, 14, 20, 20))))) == 5
    assert one(spark, g.center_distance(a, b, x_weight=2, absolute=True)) == 20
    assert one(spark, g.fit_to(b, a)).asDict() == {"x0": 5, "y0": 5, "x1": 10, "y1": 10}


@given(st.text(alphabet="abcd", max_size=12), st.text(alphabet="abcd", max_size=12))
def test_common_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert sim.common_length(a, b) == table[-1][-1]
    assert sim.indel_ratio(a, b) == sim.indel_ratio(b, a)


def test_fuzzy():
    assert sim.best_window("abc", "xxabcxx") == 100
    assert sim.indel_ratio("", "") == 100 and sim.indel_ratio(None, "a") == 0
    assert sim.token_sort_ratio("b a", "a b") == 100


def test_text(spark):
    assert one(spark, tx.looks_garbled(F.lit(""))) is True
    assert one(spark, tx.looks_garbled(F.lit("a normal line of text"))) is False
    assert one(spark, tx.looks_garbled(F.lit("*** ### $$$ %%%"))) is True
    assert one(spark, tx.sentences(F.lit("One. Two!  Three? "))) == ["One.", "Two!", "Three?"]
    assert one(spark, tx.strip_edge_digits(F.lit("12 Title 34"))) == "Title"
    assert one(spark, tx.join_hyphenated(F.lit("exam-"), F.lit("ple"))) == "exam"


def blocks(spark, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "doc int, block_ord long, level int, text string")


def test_sections(spark):
    b = blocks(spark, [(1, "A"), (None, "a"), (2, "B"), (3, "C"), (None, "c"), (2, "D"), (None, "d"), (1, "E"), (None, "e")])
    got = {r.block_ord: (r.parent_ord, r.path) for r in hierarchy.section_of(b, ["doc"]).collect()}
    assert got[0] == (None, []) and got[4] == (3, ["A", "B", "C"]) and got[5] == (0, ["A"]) and got[6] == (5, ["A", "D"]) and got[8] == (7, ["E"])
    numbers = {r.text: r.number for r in hierarchy.number_sections(b.where("level is not null"), ["doc"]).collect()}
    assert numbers == {"A": "1", "B": "1.1", "C": "1.1.1", "D": "1.2", "E": "2"}
    content = {r.title: r.content for r in hierarchy.section_contents(b, ["doc"]).collect()}
    assert content == {"A": "a", "B": "", "C": "c", "D": "d", "E": "e"}


def test_header_levels(spark):
    h = spark.createDataFrame([(1, i, float(x)) for i, x in enumerate([30, 20, 20, 14, 14, 30])] + [(2, 0, 9.0)], "doc int, block_ord int, height double")
    got = {(r.doc, r.block_ord): r.level for r in hierarchy.header_levels(h, ["doc"]).collect()}
    assert [got[1, i] for i in range(6)] == [1, 2, 2, 3, 3, 1] and got[2, 0] == 2


def test_traverse_with_cycle(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    got = {(r.key, r.depth) for r in hierarchy.traverse(e, spark.createDataFrame([("a",)], "key string"), 4).collect()}
    assert got == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}


def test_tables(spark):
    cells = spark.createDataFrame([("t", 0, 0, "a\nb"), ("t", 0, 1, "1\n2"), ("t", 1, 0, "x\ny"), ("t", 1, 1, "3\n4")], "t string, row_id int, col_id int, text string")
    got = sorted((r.row_id, r.col_id, r.text) for r in tables.split_stacked_rows(cells, ["t"]).collect())
    assert got == [(0, 0, "a"), (0, 1, "1"), (1, 0, "b"), (1, 1, "2"), (2, 0, "x"), (2, 1, "3"), (3, 0, "y"), (3, 1, "4")]
    money = spark.createDataFrame([("t", r, c, v) for r in (0, 1) for c, v in enumerate(["n", "$", "5"])], cells.schema)
    assert sorted((r.col_id, r.text) for r in tables.merge_dollar_columns(money, ["t"]).collect()) == [(0, "n"), (0, "n"), (2, "$5"), (2, "$5")]
    assert tables.to_html(money.where("row_id = 0"), ["t"]).first().html == "<table>\n<tr><td>n</td><td>$</td><td>5</td></tr>\n</table>"
    assert one(spark, tables.clean_text(F.lit("Total . . . . 5"))) == "Total 5"


def test_captions_and_lists(spark):
    rows = [(0, "Table", 0, 100), (1, "Caption", 102, 110), (2, "ListItem", 300, 310), (3, "ListItem", 312, 320), (4, "Text", 330, 340), (5, "ListItem", 400, 410)]
    b = spark.createDataFrame([(1, o, k, float(y0), float(y1)) for o, k, y0, y1 in rows], "page int, block_ord int, block_type string, y0 double, y1 double")
    b = b.select("page", "block_ord", "block_type", g.box(F.lit(0), "y0", F.lit(100), "y1").alias("box"), F.lit(1000.0).alias("page_height"))
    assert {r.block_ord: r.group_of for r in spatial.group_captions(b, ["page"]).collect()}[1] == 0
    got = {r.block_ord: (r.block_type, r.list_group is not None) for r in spatial.group_lists(b, ["page"]).collect()}
    assert got[2] == got[3] == ("ListItem", True) and got[5] == ("Text", False)


def test_qa(spark):
    t = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "user", "s")], "conv_id int, turn int, role string, text string")
    assert [(r.turn, r.question, r.answer) for r in qa.pairs(t).collect()] == [(0, "q", "a")]
    c = spark.createDataFrame([("k1", "factual"), ("k2", "factual"), ("k3", "conceptual")], "section_hash string, kind string")
    assert qa.sample(c, {"factual": 0.5, "conceptual": 0.5}, 2).count() == 2


PAGE = """<html lang=en><head><title>T &amp; t</title><meta charset=utf-8><meta name=author content=Me><script>var a="</p><p>no</p>";</script></head>
<body><nav><p>menu</p></nav><article><h1>Head</h1><p>one <b>bold</b><p>two<ul><li>x<li>y</ul><table><tr><th>h<th>i<tr><td>1<td>2</table><pre><code class="language-py">a
  b</code></pre></article></body></html>"""


def test_html(spark):
    found, meta = html.parse(PAGE)
    assert [(b[1], b[3]) for b in found] == [("SectionHeader", "Head"), ("Text", "one **bold**"), ("Text", "two"), ("ListItem", "x"), ("ListItem", "y"), ("TableCell", "h"), ("TableCell", "i"), ("TableCell", "1"), ("TableCell", "2"), ("Code", "a\n  b")]
    assert meta["title"] == "T & t" and meta["author"] == "Me" and meta["lang"] == "en"
    df = html.html_blocks(spark.createDataFrame([(1, PAGE), (2, None)], "page_id int, html string"))
    assert df.count() == 10
    assert html.markdown(df, ["page_id"]).first().markdown.startswith("# Head\n\none **bold**\n\ntwo\n\n- x")


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def zipped(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


def test_office(spark):
    doc = f'<w:document {W}><w:body><w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>Top</w:t></w:r></w:p><w:p><w:r><w:t>Body</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>c</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'
    files = [("a.docx", zipped(**{"word/document.xml": doc})), ("b.docx", b"PK\x03\x04broken"), ("c.xml", b"<?xml version='1.0'?><r><i><a>1</a><b>2</b></i><i><a>3</a><b>4</b></i></r>")]
    got = office.file_blocks(spark.createDataFrame(files, "path string, content binary")).collect()
    assert [(r.block_type, r.level, r.text) for r in got if r.path == "a.docx"] == [("SectionHeader", 2, "Top"), ("Text", None, "Body"), ("TableCell", None, "c")]
    assert [r.error is not None for r in got if r.path == "b.docx"] == [True]
    assert [r.text for r in got if r.path == "c.xml"] == ["a", "b", "1", "2", "3", "4"]


def test_hub(spark, tmp_path):
    b = spark.createDataFrame([("d", 1, 0, "Text", "x", None, None), ("d", 2, 1, "Text", "y", None, None)], "doc_id string, page_num int, block_ord long, block_type string, text string, level int, language string")
    hub.to_hub(b).write.json(str(tmp_path / "h"))
    back = hub.hub_blocks(hub.read_hub(spark, str(tmp_path / "h"))).collect()
    assert [(r.doc_id, r.page_num, r.text) for r in back] == [("d", 1, "x"), ("d", 2, "y")]
    assert hub.page_range("0,5-7,6") == [0, 5, 6, 7]


def test_a_title_owns_what_follows(spark):
    rows = [("d", 0, 0, "Title"), ("d", 1, None, "under the title"), ("d", 2, 1, "Part"), ("d", 3, None, "under the part")]
    got = {r.block_ord: (r.parent_ord, r.path) for r in hierarchy.section_of(spark.createDataFrame(rows, "doc string, block_ord int, level int, text string"), ["doc"]).collect()}
    assert got == {0: (None, []), 1: (0, ["Title"]), 2: (0, ["Title"]), 3: (2, ["Title", "Part"])}


def test_text_to_cells(spark):
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    cells = spark.createDataFrame([(0, 1, (0.0, 0.0, 10.0, 10.0)), (0, 2, (10.0, 0.0, 20.0, 10.0)), (0, 3, (50.0, 50.0, 60.0, 60.0))], f"page_id int, cell_id int, box {box}")
    lines = spark.createDataFrame([(0, 1, "low", (1.0, 6.0, 9.0, 9.0)), (0, 2, "high", (1.0, 1.0, 12.0, 4.0)), (0, 3, "away", (90.0, 90.0, 95.0, 95.0))], f"page_id int, line_id int, text string, box {box}")
    assert {r.cell_id: r.text for r in tables.text_to_cells(lines, cells, ["page_id"]).collect()} == {1: "high low", 2: None, 3: None}


def test_sample_by_kind(spark):
    c = spark.createDataFrame([(f"k{n}", kind) for n in range(60) for kind in ("factual", "conceptual")], "section_hash string, kind string")
    got = qa.sample(c, {"factual": 0.5, "conceptual": 0.25}, 21).collect()
    assert len({r.section_hash for r in got}) == len(got) == 21 and sum(r.kind == "conceptual" for r in got) == 5


def test_pages_go_through_in_slices():
    """No batch of blocks comes from more than PAGES pages, however many a batch of pages has."""
    import pyarrow as pa

    pages = ["<p>a</p><p>b</p>", None, "<h1>c</h1>", ""] * 50
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(200)), "html": pages})
    out = list(html._block_batches("page_id")(iter([batch])))
    assert max(len(set(b.column(0).to_pylist())) for b in out) <= html.PAGES < 200
    got = [(r["page_id"], r["block_ord"], r["block_type"], r["text"], r["attrs"]) for b in out for r in b.to_pylist()]
    assert got == [(i, b[0], b[1], b[3], list(b[8].items())) for i, h in enumerate(pages) for b in html.parse(h)[0]]
