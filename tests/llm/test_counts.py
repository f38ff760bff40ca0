"""Divergence, collocations and language-model scores against brute force, DuckDB and odd tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_llm import LONG, ODD, SCHEMA, empty, odd  # noqa: F401

from docloom.llm import collocations, divergence, lm


def texts(seed, n=120, vocab=25, longest=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 5))) for _ in range(vocab)]
    out = []
    for k in range(n):
        body = " ".join(rng.choice(words[: rng.randrange(2, vocab)]) + rng.choice(["", "", "", ",", ".", "\n", "\t", "-X"]) for _ in range(rng.randrange(longest)))
        out.append((k, body, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None, "é"]), len(body)))
    return out + out[:7]


def in_duckdb(spark, rows, sql):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", rows)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return names, sorted(cur.fetchall(), key=str)


def rows_of(df, names):
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


# divergence


def test_tries_keep_their_leaves():
    rng = random.Random(3)
    for _ in range(100):
        trie, known = divergence.Trie(), {}
        for _ in range(rng.randrange(1, 200)):
            term = bytes(rng.choice(b"ab\xc3") for _ in range(rng.randrange(1, 8)))
            assert trie.leaf(term, len(known)) == known.setdefault(term, len(known))
        assert list(trie.walk()) == sorted(known.items())


@pytest.mark.parametrize("least", [1, 3, 10_000])
def test_audit_equals_sql(spark, least):
    rows = texts(1)
    names, want = in_duckdb(spark, rows, divergence.oracle_sql(least, 7))
    assert rows_of(divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), min_docs=least, top=7), names) == want
    assert want


def test_audit_in_small_pieces(spark, monkeypatch):
    """Many tries, pages, ranges, chunks and blocks of sources give the same. Ranges are few, so the parameters go with the closures."""
    rows = [(k, t, lang, f"s{k % 9}", n) for k, t, lang, _, n in texts(2)]
    names, want = in_duckdb(spark, rows, divergence.oracle_sql(2, 5))
    for name, value in dict(RANGE_LEAVES=20, CHUNK=5, BLOCK=2).items():
        monkeypatch.setattr(divergence, name, value)
    assert rows_of(divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(4), min_docs=2, top=5), names) == want


def test_full_tries_are_written_down(monkeypatch):
    import pandas as pd

    rows = pd.DataFrame([((lang or "").encode(), source or "", text.encode()) for _, text, lang, source, _ in texts(4)], columns=["lang", "source", "text"])

    def counters(pages):
        out = Counter()
        for frame in pages:
            for p in frame.itertuples(index=False):
                assert list(p.terms) == sorted(p.terms)
                for leaf, source, n in zip(p.leaf, p.source, p.n, strict=True):
                    out[p.lang, p.terms[leaf], p.names[source]] += n
                for term, df in zip(p.terms, p.df, strict=True):
                    out[p.lang, term] += df
        return out

    whole = counters(divergence._counted(iter([rows])))
    for name, value in dict(LEAVES=10, CELLS=30, PAGE=3).items():
        monkeypatch.setattr(divergence, name, value)
    assert counters(divergence._counted(iter([rows]))) == whole


def test_audit_of_odd_tables(spark, odd, empty):  # noqa: F811
    got = divergence.audit(odd, min_docs=1).collect()
    groups = {(r[2] or "", r[3] or "") for r in ODD}
    pairs = {(r.lang, r.source, r.item) for r in got if r.part == "pair"}
    assert pairs == {(a, s, t) for a, s in groups for b, t in groups if a == b and s != t}
    assert all(r.value == 0 for r in divergence.audit(odd, min_docs=99).collect())
    assert divergence.audit(empty).collect() == []


# collocations


@pytest.mark.parametrize("least", [2, 5, 30])
def test_collocations_equal_sql(spark, least):
    rows = texts(5, 200, 12)
    names, want = in_duckdb(spark, rows, collocations.oracle_sql(least, 40))
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), min_count=least, top=40, chunk_words=500)
    assert rows_of(got, names) == want
    assert want


def test_collocations_over_many_ranges(spark, monkeypatch):
    rows = texts(6, 200, 12)
    names, want = in_duckdb(spark, rows, collocations.oracle_sql(3))
    monkeypatch.setattr(collocations, "RANGE_KEYS", 200)
    assert rows_of(collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), min_count=3, chunk_words=300), names) == want


def test_radix_order_and_runs():
    rng = np.random.default_rng(2)
    for size in (0, 1, 5000):
        high, low = rng.integers(0, 1 << 40, size, dtype=np.uint64) & np.uint64(0xFF000000FF), rng.integers(0, 3, size, dtype=np.uint64)
        order = collocations.radix_order(high, low)
        assert (order == np.lexsort((low, high))).all()
        h, s, n = collocations.run_lengths(high, low, np.ones(size, np.int64))
        assert dict(zip(zip(h.tolist(), s.tolist(), strict=True), n.tolist(), strict=True)) == Counter(zip(high.tolist(), low.tolist(), strict=True))


def test_collocations_of_odd_tables(spark, odd, empty):  # noqa: F811
    rows = collocations.collocations(odd, min_count=2).collect()
    words = len(LONG.split())
    assert {(r.phrase, r.a) for r in rows if r.phrase.startswith("word")} == {("word word word word", words - 3)}
    assert ("same text of a", 3) in {(r.phrase, r.a) for r in rows}
    assert {r.n for r in rows if r.lang == "en"} == {words + 3 * 7}
    assert collocations.collocations(empty).collect() == []


# language-model scores


class Katz:
    """The model from plain dictionaries."""

    def __init__(self, docs, order):
        self.order, self.counts = order, [Counter() for _ in range(order)]
        for words in docs:
            tokens = ["<s>"] * (order - 1) + words
            for i in range(order - 1, len(tokens)):
                for k in range(order):
                    self.counts[k][tuple(tokens[i - k : i + 1])] += 1
        self.lost = [lm.Discounts([len(c), sum(c.values()), *[sum(v == r for v in c.values()) for r in range(1, lm.LARGE + 2)]]) for c in self.counts]
        self.after = [defaultdict(list) for _ in range(order)]
        for k, c in enumerate(self.counts):
            for gram in c:
                self.after[k][gram[:-1]].append(gram[-1])

    def p(self, word, context):
        k = len(context)
        c, lost = self.counts[k], self.lost[k]
        n = c[(*context, word)]
        total = sum(c[(*context, w)] for w in self.after[k][tuple(context)])
        off = lambda n: float(lost.of(np.array([n]))[0])
        if k == 0:
            return (n - off(n)) / total if n else (sum(map(off, c.values())) / total if total else 1.0)
        if n:
            return (n - off(n)) / total
        if not total:
            return self.p(word, context[1:])
        seen = self.after[k][tuple(context)]
        free = sum(off(c[(*context, w)]) for w in seen) / total
        return free / (1 - sum(self.p(w, context[1:]) for w in seen)) * self.p(word, context[1:])


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_a_plain_model(spark, order):
    rows = texts(8, 150, 20) + [(None, "a row without an id", None, None, 1)]
    split = [(k, (t or "").encode().lower().split() + [b""]) for k, t, *_ in rows]
    model = Katz([w for k, w in split if not is_held(k)], order)
    n, v = sum(model.counts[0].values()), len(model.counts[0])
    want = []
    for k, words in split:
        tokens = ["<s>"] * (order - 1) + words
        score = sum(math.log10(model.p(tokens[i], tokens[i - order + 1 : i])) for i in range(order - 1, len(tokens)))
        base = sum(math.log10((model.counts[0][w,] + 1) / (n + v + 1)) for w in words)
        want.append((str(k), is_held(k), len(words), sum(model.counts[0][w,] > 0 for w in words), n, round(base, 7), round(score, 7)))
    got = lm.score_texts(spark.createDataFrame(rows, SCHEMA).repartition(3), order=order, chunk_tokens=400).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 7), round(r.score, 7)) for r in got) == sorted(want)


def test_contexts_add_up_to_one():
    model = Katz([(t or "").encode().lower().split() + [b""] for _, t, *_ in texts(9, 80, 15)], 3)
    words = [g[0] for g in model.counts[0]] + ["unknown"]
    for k in (1, 2):
        for context in list(model.after[k])[:60]:
            assert abs(sum(model.p(w, list(context)) for w in words) - 1) < 1e-9


def test_discounts_where_counts_of_counts_fail():
    for found in ([0] * 8, [1, 9, 0, 0, 0, 0, 0, 0], [3, 3, 3, 0, 0, 0, 0, 0], [40, 100, 20, 8, 5, 3, 2, 2]):
        d = lm.Discounts(found)
        r = np.arange(1, 20)
        assert ((d.of(r) > 0) & (d.of(r) < r)).all() and 0 < d.unknown <= 1


def test_scores_of_odd_tables(spark, odd, empty, sf_dir):  # noqa: F811
    got = lm.score_texts(odd).collect()
    assert len(got) == len(ODD) and all(np.isfinite([r.score, r.base_score]).all() and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 6)} == {1}
    assert lm.score_texts(empty).collect() == []
    held = spark.createDataFrame([(k, "no training text", None, None, 1) for k in range(200) if is_held(k)], SCHEMA)
    assert {(r.n_known, r.train_tokens, r.score) for r in lm.score_texts(held).collect()} == {(0, 0, 0.0)}
    docs = lm.score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in docs) > sum(r.base_score for r in docs)


# a template family: most shingles are common to all, no pair is similar


def test_template_family_brings_no_pairs(spark):
    from docloom.llm import simhash

    words = [f"w{k}" for k in range(104)]

    def text(i):
        own = list(words)
        for slot in (10, 35, 60, 85):
            own[slot] = f"own{i}x{slot}"
        return " ".join(own)

    df = spark.createDataFrame([(i, text(i)) for i in range(300)], "doc_id long, text string")
    sketches = simhash._sketches(simhash._rows(df, "doc_id", "text"), 5, 0.8)
    places = sketches.select("id", "n", "prefix").mapInPandas(simhash._kept_places(simhash._repeated(sketches)), "id bigint, n int, at int, h bigint")
    assert places.where(f"at < {simhash._index_size('n', 0.8)}").count() == 0
    assert simhash.similar_documents(df).where("doc_id <> component_id").count() == 0


def test_clean_text_stays_beside_another_of_its_id(spark):
    from docloom.llm import decontamination

    item = " ".join(f"bench{k}" for k in range(30))
    docs = spark.createDataFrame([(1, f"before {item} after"), (1, "quite another text"), (2, "clean"), (None, item)], "doc_id long, text string")
    kept = decontamination.clean(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("1", "quite another text"), ("2", "clean"), ("None", item)]


def test_no_folder_of_one_machine_on_a_cluster():
    from types import SimpleNamespace

    from docloom.llm.shared import shared_folder

    def session(master, warehouse, checkpoint=None):
        conf = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": checkpoint}
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: {}), conf=SimpleNamespace(get=lambda key, default=None: conf.get(key) or default))

    assert shared_folder(session("yarn", "hdfs://x/w")) == "hdfs://x/w" and shared_folder(session("yarn", "file:/w", "file:///mnt/all")) == "file:///mnt/all"
    with pytest.raises(ValueError, match="one machine"):
        shared_folder(session("spark://a:7077", "file:/home/spark-warehouse"))


def test_a_worker_gives_back_what_another_operator_cached(monkeypatch):
    from docloom.llm import shared

    monkeypatch.setattr(shared, "_HELD", {})
    given = []
    for operator in ("leaks", "leaks", "pieces", "quality", "leaks"):
        shared.begin(operator, lambda operator=operator: given.append(operator))
    assert given == ["leaks", "pieces", "quality"]
    assert list(shared._HELD) == ["leaks"]
