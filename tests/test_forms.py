"""JSON forms, batched rewrites and question diversity against plain loops."""

import json
import random

from pyspark.sql import functions as F

from docloom.functions import geometry as g
from docloom.functions.similarity import sequence_ratio
from docloom.operators import batches, json_forms, qa


def documents(n=4, seed=3):
    rng = random.Random(seed)
    return [(d, k, k // 9, "SectionHeader" if (level := rng.choice([None, None, 1, 2, 3, 4, 6])) else rng.choice(["Text", "Table"]), level, f"t{k}") for d in range(n) for k in range(rng.randrange(1, 40))]


def nested(rows):
    """Sections by a stack."""
    out = {"blocks": [], "sections": []}
    stack = [(0, out["blocks"], out["sections"], None)]
    for _, k, page, kind, level, text in rows:
        if level is None:
            stack[-1][1].append({"type": kind, "text": text, "page_id": page})
            continue
        while stack[-1][0] >= level:
            stack.pop()
        s = {"id": k, "title": text, "level": level, "parent_id": stack[-1][3], "page_range": [page, page], "blocks": [], "subsections": []}
        stack[-1][2].append(s)
        stack.append((level, s["blocks"], s["subsections"], k))
    return out


def tidy(section):
    section["page_range"] = [section["page_range"][0], max([section["page_range"][0], *(b["page_id"] for b in section["blocks"])])]
    if section["parent_id"] is None:
        del section["parent_id"]
    for s in section["subsections"]:
        tidy(s)


def short(section):
    return {"id": section["id"], "title": section["title"], "level": section["level"], "blocks": [b["type"] for b in section["blocks"]], "subsections": [short(s) for s in section["subsections"]]}


def test_hierarchical_json(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc int, block_ord int, page_id int, block_type string, level int, text string").repartition(3)
    want = {d: nested([r for r in rows if r[0] == d]) for d in {r[0] for r in rows}}
    compact = {r.doc: json.loads(r.json) for r in json_forms.hierarchical_json(df, ["doc"], compact=True).collect()}
    assert compact == {d: {"blocks": [b["type"] for b in w["blocks"]], "sections": [short(s) for s in w["sections"]]} for d, w in want.items()}
    for w in want.values():
        for s in w["sections"]:
            tidy(s)
    assert {r.doc: json.loads(r.json) for r in json_forms.hierarchical_json(df, ["doc"]).collect()} == want


def test_merged_blocks(spark):
    data = [
        ("d", 0, 0, "Text", "a", 0, 0, 10, 10), ("d", 0, 1, "Text", "b", 12, 1, 20, 11), ("d", 0, 2, "Text", "c", 0, 14, 10, 24), ("d", 0, 3, "Line", "d", 0, 25, 10, 35), ("d", 0, 4, "Text", "e", 0, 36, 9, 46),
        ("d", 0, 5, "Text", "f", 60, 36, 70, 46), ("d", 0, 6, "Table", "g", 0, 47, 9, 57), ("d", 0, 7, "Table", "h", 0, 57, 9, 67), ("d", 1, 8, "Text", "i", 0, 0, 9, 9), ("d", 1, 9, "Text", None, 0, 9, 9, 9), ("e", 0, 0, "Text", "x", None, None, None, None),
    ]
    df = spark.createDataFrame([(*r[:5], *(None if v is None else float(v) for v in r[5:])) for r in data], "doc string, page_id int, block_ord int, block_type string, text string, x0 double, y0 double, x1 double, y1 double")
    df = df.withColumn("box", g.box("x0", "y0", "x1", "y1"))
    got = sorted((r.doc, r.page_id, r.block_ord, r.text, list(r.merged_ids)) for r in json_forms.merged_blocks(df, ["doc", "page_id"]).collect())
    assert got == [("d", 0, 0, "a b c", [0, 1, 2]), ("d", 0, 3, "d", [3]), ("d", 0, 4, "e", [4]), ("d", 0, 5, "f", [5]), ("d", 0, 6, "g", [6]), ("d", 0, 7, "h", [7]), ("d", 1, 8, "i", [8]), ("d", 1, 9, "", [9]), ("e", 0, 0, "x", [0])]
    whole = {r.doc: json.loads(r.json)["pages"] for r in json_forms.merged_json(df, ["doc"]).collect()}
    assert [(p["page_id"], p["children_merged"], len(p["blocks"])) for p in whole["d"]] == [(0, 2, 6), (1, 0, 2)]
    assert whole["d"][0]["blocks"][0]["bbox"] == [0.0, 0.0, 20.0, 24.0]


def test_line_batches(spark):
    df = spark.createDataFrame([("d", k, f"line {k}") for k in range(25)] + [("e", 0, None)], "doc string, line_ord int, text string")
    broken = lambda t: F.when(F.get(t, F.lit(0)) == "line 10", F.slice(t, 1, 3)).when(F.get(t, F.lit(0)) == "line 20", F.transform(t, lambda x: F.concat(x, F.lit("<math>")))).otherwise(F.transform(t, F.upper))
    got = {(r.doc, r.line_ord): (r.text, r.failed) for r in batches.rewrite_line_batches(df, ["doc"], F.lit(True), broken).collect()}
    assert got == {("d", k): (f"LINE {k}" if k < 10 else f"line {k}", k in (10, 20)) for k in range(25)} | {("e", 0): ("", False)}
    none = batches.rewrite_line_batches(df, ["doc"], F.lit(None).cast("boolean"), broken)
    assert sorted((r.doc, r.line_ord, r.text, r.failed) for r in none.collect()) == sorted((r.doc, r.line_ord, r.text, False) for r in df.collect())


def test_row_batches_keep_spans_whole(spark):
    down = {1: 3, 5: 9, 20: 2}
    cells = spark.createDataFrame([("t", k, down.get(k, 1)) for k in range(24)], "t string, row_id int, rowspan int")
    got = {r.row_id: r.batch for r in batches.row_batches(cells, ["t"], 4).collect()}
    groups = [[k for k in got if got[k] == b] for b in sorted(set(got.values()))]
    assert [sorted(x) for x in groups] == [[0, 1, 2, 3], [4], list(range(5, 14)), [14, 15, 16, 17], [18, 19, 20, 21], [22, 23]]


def test_table_batches(spark):
    cells = spark.createDataFrame([(t, r, c, f"{t}{r}{c}", 1, 1, False) for t in ("a", "b") for r in range(5) for c in range(2)], "t string, row_id int, col_id int, text string, rowspan int, colspan int, is_header boolean")
    model = lambda h: F.when(h.contains("b40"), "no corrections").otherwise(F.replace(h, F.lit(">a"), F.lit(">new ")))
    got = sorted((r.t, r.row_id, r.col_id, r.text, r.rewritten) for r in batches.rewrite_table_batches(cells, ["t"], model, most=2).collect())
    assert got == sorted([("a", r, c, f"new {r}{c}", True) for r in range(5) for c in range(2)] + [("b", r, c, f"b{r}{c}", False) for r in range(5) for c in range(2)])
    assert not any(r.rewritten for r in batches.rewrite_table_batches(cells, ["t"], model, most=2, most_rows=4).collect())


def test_diversity_in_blocks(spark):
    rng = random.Random(7)
    asked = [(g_, k, " ".join(rng.choices(["what", "is", "the", "size", "of", "é", "x"], k=rng.randrange(7)))) for g_ in range(3) for k in range([60, 1, 2][g_])] + [(9, 0, None), (9, 1, "")]
    best = {(a, k): max((sequence_ratio(q, p) for b, j, p in asked if b == a and j != k), default=0.0) for a, k, q in asked}
    df = spark.createDataFrame(asked, "conv int, turn int, question string")
    for block in (7, 400):
        assert {(r.conv, r.turn): r.most_similar for r in qa.diversity(df, ["conv"], "turn", block=block).collect()} == best


def test_one_large_group_of_questions(spark):
    df = spark.range(500).select(F.lit(1).alias("conv"), F.col("id").alias("turn"), F.concat(F.lit("question about "), F.sha2(F.col("id").cast("string"), 256)).alias("question"))
    assert qa.diversity(df, ["conv"], "turn", block=100).where("most_similar > 0.3").count() == 500


def test_broken_lines_are_kept_apart(spark, tmp_path):
    from docloom.sources import files

    (tmp_path / "qa.jsonl").write_text('{"instruction": "q", "input": "", "output": "a", "metadata": {"k": "v"}}\n{"instruction": \n\n[1]\n')
    assert [r.instruction for r in files.read_qa_lines(spark, str(tmp_path / "qa.jsonl")).collect()] == ["q"]
    assert sorted(r.broken for r in files.broken_qa_lines(spark, str(tmp_path / "qa.jsonl")).collect()) == ["[1]", '{"instruction": ']


def test_inversions():
    import numpy as np

    from docloom.operators.scoring import inversions

    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 60):
        v = rng.integers(0, 9, n)
        assert inversions(v) == sum(v[i] > v[j] for i in range(n) for j in range(i + 1, n))


def test_a_batch_of_one_row_is_rewritten(spark):
    """Eleven rows of one cell in batches of ten: the answer for the last row has one cell, as the batch has."""
    c = spark.createDataFrame([(1, r, 0, f"w{r}", 1, 1, False) for r in range(11)], "t int, row_id long, col_id int, text string, rowspan int, colspan int, is_header boolean")
    out = batches.rewrite_table_batches(c, ["t"], lambda h: F.replace(h, F.lit("w"), F.lit("x")), most=10).collect()
    assert sorted((r.row_id, r.text, r.rewritten) for r in out) == sorted((r, f"x{r}", True) for r in range(11))
    # an answer that joins several cells into one is still none
    out = batches.rewrite_table_batches(c, ["t"], lambda h: F.regexp_replace(h, "</td></tr><tr><td>", " "), most=10).collect()
    assert not any(r.rewritten for r in out) and len(out) == 11
