"""Source divergence audit: how far the sources of a language differ in the terms they use.

Every task counts the terms of its documents in byte tries, one a language, whose leaves have a counter for each source.
A full or finished trie is cut into pages of leaves in UTF-8 order. Pages are split at the bounds of prefix ranges, the
pages of a range merge into one trie, and its traversal gives the kept terms in UTF-8 order: in chunks, over which pairs
of sources are compared, and as candidates, of which equal values keep the order of the traversal.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, discard

#: Leaves, and counters at rest and pending, that a task holds before it writes its tries down; leaves of a page and of a chunk.
LEAVES, CELLS, PAGE, CHUNK = 400_000, 2_000_000, 4_096, 4_096
#: Leaves of all pages together for each prefix range, the most ranges, and sources compared at once.
RANGE_LEAVES, RANGES, BLOCK = 1_000_000, 1 << 16, 256
#: Bytes by which the root of a trie branches.
ROOT = 3
_APART = bytes(b if b > 0x7F or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
PAGES = "lang binary, terms array<binary>, df array<bigint>, leaf array<int>, source array<int>, n array<bigint>, names array<string>"


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of letters A-Z and a-z and of characters beyond ASCII, only A-Z lower-cased."""
    return (text or b"").translate(_APART).split()


class Trie:
    """A radix trie over bytes, whose root branches by the first ROOT bytes: an edge below is [label, edges by first byte or
    None, leaf or -1]. The leaf of a term that ends at the root's edge stands at -1."""

    def __init__(self):
        self.roots: dict[bytes, dict] = {}

    def leaf(self, term: bytes, fresh: int) -> int:
        """The leaf of a term; fresh if the term is new."""
        head = term[:ROOT]
        edges = self.roots.get(head)
        if edges is None:
            edges = self.roots[head] = {}
        at, n = ROOT, len(term)
        if n <= ROOT:
            return edges.setdefault(-1, fresh)
        while True:
            edge = edges.get(term[at])
            if edge is None:
                edges[term[at]] = [term[at:], None, fresh]
                return fresh
            label = edge[0]
            end = at + len(label)
            if term[at:end] != label:
                k = next((k for k, (x, y) in enumerate(zip(label, term[at:], strict=False)) if x != y), n - at)
                edge[:] = [label[:k], {label[k]: [label[k:], edge[1], edge[2]]}, -1]
                end = at + k
            if end == n:
                if edge[2] < 0:
                    edge[2] = fresh
                return edge[2]
            at, edges = end, edge[1]
            if edges is None:
                edges = edge[1] = {}

    def walk(self) -> Iterator[tuple[bytes, int]]:
        """(term, leaf) in byte order."""
        for head in sorted(self.roots):
            edges = self.roots[head]
            if -1 in edges:
                yield head, edges[-1]
            stack = [(head, edges[c]) for c in sorted(edges, reverse=True) if c >= 0]
            while stack:
                before, (label, below, leaf) = stack.pop()
                term = before + label
                if leaf >= 0:
                    yield term, leaf
                if below:
                    stack += [(term, below[c]) for c in sorted(below, reverse=True)] if len(below) > 1 else [(term, *below.values())]


class Tries:
    """A trie for each language, whose leaves have a document count and a counter for each source that has the term."""

    def __init__(self):
        self.tries: dict[bytes, Trie] = {}
        self.names: dict[str, int] = {}
        self.df = np.zeros(1024, np.int64)
        self.size = self.waiting = 0
        self.cells = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

    def trie(self, lang: bytes) -> Trie:
        return self.tries.get(lang) or self.tries.setdefault(lang, Trie())

    def leaf(self, trie: Trie, term: bytes) -> int:
        out = trie.leaf(term, self.size)
        if out == self.size:
            self.size += 1
            if out == len(self.df):
                self.df = np.concatenate((self.df, np.zeros(out, np.int64)))
        return out

    def source(self, name: str) -> int:
        return self.names.setdefault(name, len(self.names))

    def add(self, leaves: np.ndarray, sources: np.ndarray | int, n: np.ndarray) -> None:
        """Adds to counters; leaves and sources may repeat."""
        self.cells.append((leaves.astype(np.int64) << 31 | sources, n))
        self.waiting += len(n)
        if self.waiting > CELLS:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate(x) for x in zip(*self.cells, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        self.cells = [(keys[first], np.add.reduceat(n, first) if len(first) else n)]
        self.waiting = 0
        return self.cells[0]

    def full(self) -> bool:
        return self.size > LEAVES or len(self.cells[0][0]) > CELLS

    def pages(self, size: int = PAGE, least: int = 0) -> Iterator[tuple]:
        """The leaves in byte order, with a document count of at least `least`, `size` to a page."""
        keys, n = self.settle()
        starts = np.searchsorted(keys, np.arange(self.size + 1) << 31)
        names = list(self.names)
        for lang in sorted(self.tries):
            kept = [(t, k) for t, k in self.tries[lang].walk() if self.df[k] >= least]
            for at in range(0, len(kept), size):
                part = kept[at : at + size]
                leaves = np.array([k for _, k in part])
                counts = starts[leaves + 1] - starts[leaves]
                picked = np.repeat(starts[leaves] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                used, source = np.unique(keys[picked] & ((1 << 31) - 1), return_inverse=True)
                yield lang, [t for t, _ in part], self.df[leaves], np.repeat(np.arange(len(part), dtype=np.int32), counts), source.astype(np.int32), n[picked], [names[k] for k in used]


class _Leaves(dict):
    """term -> leaf, so that a term goes down its trie once."""

    def __init__(self, tries: Tries, lang: bytes):
        self.tries, self.trie = tries, tries.trie(lang)

    def __missing__(self, term: bytes) -> int:
        out = self[term] = self.tries.leaf(self.trie, term)
        return out


def _page_frame(pages: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(pages, columns=["lang", "terms", "df", "leaf", "source", "n", "names"])


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pages of the tries of a task's documents (lang, source, text; lang and text in UTF-8)."""
    tries, known = Tries(), {}
    for frame in frames:
        for lang, source, text in frame.itertuples(index=False):
            words = terms_of(text)
            if not words:
                continue
            look = known.get(lang) or known.setdefault(lang, _Leaves(tries, lang))
            leaves, n = np.unique(np.fromiter(map(look.__getitem__, words), np.int64, len(words)), return_counts=True)
            tries.df[leaves] += 1
            tries.add(leaves, tries.source(source), n)
            if tries.full():
                for page in tries.pages():
                    yield _page_frame([page])
                tries, known = Tries(), {}
    for page in tries.pages():
        yield _page_frame([page])


def _split(bounds: list[tuple[bytes, bytes]]):
    """Cuts pages at the bounds of the prefix ranges. What a page holds is sliced, not read, but for the terms that the search for a bound meets."""
    names = [c.split()[0] for c in PAGES.split(", ")]

    def one(batch: pa.RecordBatch, i: int, at: int, end: int, part: int) -> pa.RecordBatch:
        cells = lambda c: (lambda x: x.values.slice(x.offsets[i].as_py(), x.offsets[i + 1].as_py() - x.offsets[i].as_py()))(batch.column(c))
        leaf = cells("leaf")
        a, b = np.searchsorted(leaf.to_numpy(), (at, end))
        listed = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        own = {"terms": cells("terms").slice(at, end - at), "df": cells("df").slice(at, end - at), "leaf": pc.subtract(leaf.slice(a, b - a), pa.scalar(at, pa.int32())), "source": cells("source").slice(a, b - a), "n": cells("n").slice(a, b - a), "names": cells("names")}
        return pa.RecordBatch.from_arrays([batch.column("lang").slice(i, 1), *[listed(own[c]) for c in names[1:]], pa.array([part], pa.int64())], [*names, "part"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                terms = batch.column("terms")[i].values
                at = 0
                while at < len(terms):
                    k = bisect_right(bounds, (lang, terms[at].as_py()))
                    end = len(terms) if k == len(bounds) or bounds[k][0] != lang else bisect_left(range(len(terms)), bounds[k][1], at, key=lambda j: terms[j].as_py())
                    yield one(batch, i, at, end, k)
                    at = end

    return split


def _merged(least: int):
    """The kept terms of each prefix range, whose pages follow one another, as (lang, chunk, term, first, total, source, n)."""

    def emit(part: int, tries: Tries) -> Iterator[pd.DataFrame]:
        for number, (lang, terms, _, leaf, source, n, names) in enumerate(tries.pages(CHUNK, least)):
            total = np.add.reduceat(n, np.searchsorted(leaf, np.arange(len(terms))))
            words = np.array([t.decode("utf-8", "replace") for t in terms], object)
            yield pd.DataFrame({"lang": lang.decode("utf-8", "replace"), "chunk": (part << 32) + number, "term": words[leaf], "first": np.concatenate(([True], leaf[1:] != leaf[:-1])), "total": total[leaf], "source": np.array(names, object)[source], "n": n})

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, tries = None, Tries()
        for frame in frames:
            for page in frame.itertuples(index=False):
                if page.part != part:
                    if part is not None:
                        yield from emit(part, tries)
                    part, tries = page.part, Tries()
                trie, leaf = tries.trie(page.lang), tries.leaf
                leaves = np.array([leaf(trie, t) for t in page.terms], np.int64)
                tries.df[leaves] += np.asarray(page.df)  # a page has a term once
                names = np.array([tries.source(s) for s in page.names], np.int64)
                tries.add(leaves[np.asarray(page.leaf)], names[np.asarray(page.source)], np.asarray(page.n))
        if part is not None:
            yield from emit(part, tries)

    return merged


def kept_terms(rows: DataFrame, min_docs: int) -> DataFrame:
    """(lang, chunk, term, first, total, source, n): the counters of all terms in at least min_docs documents of their language.

    rows: lang, source, text without nulls in the first two. chunk numbers runs of CHUNK terms in UTF-8 order; total is
    the term's count in the language; first marks one counter of each term.
    """
    pages = cut(rows.select(F.col("lang").cast("binary"), "source", F.col("text").cast("binary")).mapInPandas(_counted, PAGES), "tries")
    size = pages.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)), F.count("*")).first()
    ranges = min(RANGES, -(-size[0] // RANGE_LEAVES))
    bounds: list[tuple[bytes, bytes]] = []
    if ranges > 1:  # from the middle terms of some pages
        middle = pages.select("lang", F.expr("terms[size(terms) div 2]").alias("t"))
        some = sorted((bytes(r[0]), bytes(r[1])) for r in middle.sample(min(1.0, 20 * ranges / size[1]), 7).collect())
        bounds = sorted({some[len(some) * k // ranges] for k in range(1, ranges)}) if some else []
    parts = pages.mapInArrow(_split(bounds), f"{PAGES}, part bigint").repartition("part").sortWithinPartitions("part")
    out = cut(parts.mapInPandas(_merged(min_docs), "lang string, chunk bigint, term string, first boolean, total bigint, source string, n bigint"), "terms")
    discard(pages)
    return out


def _share(count: str, total: str, terms: str) -> Column:
    """p in billionths, exact: decimals hold what passes 64 bits."""
    return F.expr(f"1 + ((1000000000 * (cast({count} as decimal(20, 0)) + 5)) div nullif(cast({total} as decimal(20, 0)) + 5 * {terms}, 0))")


def _distances(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums of the differences of p over the terms of a chunk, for the pairs of sources of two blocks.

    Rows without a term hold a source's p of count zero, which stands wherever the source lacks a term.
    """
    marks = frame[frame["term"].isna()].sort_values("no")
    cells = frame[frame["term"].notna()]
    numbers = marks["no"].to_numpy(np.int64)
    left, right = marks["block"] == frame["bi"].iloc[0], marks["block"] == frame["bj"].iloc[0]
    place, terms = np.searchsorted(numbers, cells["no"].to_numpy(np.int64)), pd.factorize(cells["term"])
    n_terms = int(frame["n_terms"].iloc[0])
    p = np.repeat(marks["p"].to_numpy(np.int64)[:, None], len(terms[1]), axis=1)
    p[place, terms[0]] = cells["p"].to_numpy(np.int64)
    base, rest = marks["p"].to_numpy(np.int64), n_terms - len(terms[1])  # terms that no source of the blocks has
    names, out = marks["source"].to_numpy(object), []
    mine = np.flatnonzero(right.to_numpy())
    for i in np.flatnonzero(left.to_numpy()):
        others = mine[mine > i] if (frame["bi"].iloc[0] == frame["bj"].iloc[0]) else mine
        if len(others):
            sums = np.abs(p[others] - p[i]).sum(axis=1) + rest * np.abs(base[others] - base[i])
            out += [(frame["lang"].iloc[0], names[i], names[k], value) for k, value in zip(others, sums.tolist(), strict=True)]
    return pd.DataFrame(out, columns=["lang", "a", "b", "value"])


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 30, top: int = 50) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part `pair` for each other source of the language, farthest first;
    part `term` for the `top` terms that a source has more of than its language.

    Terms are runs of A-Z, a-z and characters beyond ASCII, only A-Z lower-cased. A language keeps the terms of at least
    min_docs of its documents (rows). p = 1 + floor(10^9 (count + 5) / (N + 5 V)) with the N occurrences of the V kept
    terms in the source, or the language; a pair's value is the sum of |p - q| over all kept terms (0 without any), a
    term's is p - q. Ties go by item in UTF-8 order. Arithmetic is exact. Null lang, source and text count as ''. Each
    (lang, source) that occurs has its pairs, also without any term; a language with one source has none. Repeated rows
    count each time; other columns are ignored; an empty table gives an empty result.

    A partition's term is shuffled once for each of its tries, with all its counters, so common terms and large sources
    make no large group. Sources are compared in blocks of BLOCK over chunks of CHUNK terms.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(name(lang).alias("lang"), name(source).alias("source"), F.col(text).alias("text"))
    cells = kept_terms(rows, min_docs)
    langs = cells.groupBy("lang").agg(F.sum(F.col("first").cast("bigint")).alias("v"), F.sum("n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["v", "total", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = cut(groups.withColumn("no", number).withColumn("block", F.floor(F.col("no") / BLOCK)).withColumn("base", _share("0", "total", "v")), "sources")
    cells = cells.withColumnRenamed("total", "in_lang").join(groups, ["lang", "source"])
    scored = cells.withColumn("p", _share("n", "total", "v")).withColumn("q", _share("in_lang", "lang_total", "v"))
    own = scored.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = own.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    # pairs: the counters of a chunk and, for each of its sources, p of count zero; once for every two blocks
    chunks = cells.groupBy("lang", "chunk").agg(F.sum(F.col("first").cast("bigint")).alias("n_terms"))
    blocks = groups.groupBy("lang").agg(F.max("block").alias("last"))
    marks = chunks.join(groups, "lang").select("lang", "chunk", "source", "no", "block", F.col("base").alias("p"), F.lit(None).cast("string").alias("term"))
    both = marks.unionByName(scored.select("lang", "chunk", "source", "no", "block", "p", "term")).join(blocks, "lang").join(chunks, ["lang", "chunk"])
    ends = F.transform(F.sequence(F.lit(0).cast("bigint"), "last"), lambda k: F.struct(F.least("block", k).alias("bi"), F.greatest("block", k).alias("bj")))
    dealt = both.withColumn("e", F.explode(ends)).select("lang", "chunk", "source", "no", "block", "p", "term", "n_terms", "e.bi", "e.bj")
    sums = dealt.groupBy("lang", "chunk", "bi", "bj").applyInPandas(_distances, "lang string, a string, b string, value bigint").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sums = cut(sums, "distances")
    ways = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = groups.select("lang", F.col("source").alias("a")).join(groups.select("lang", F.col("source").alias("b")), "lang").where("a <> b").join(ways, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), F.coalesce("value", F.lit(0).cast("bigint")).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(own)


def oracle_sql(min_docs: int = 30, top: int = 50) -> str:
    """The same in DuckDB SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    share = lambda n, total: f"(1 + (1000000000::hugeint * ({n} + 5)) // ({total} + 5 * v))"
    return f"""with d as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
t as (select row, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
kept as (select lang, term, count(*)::hugeint as in_lang from t group by all having count(distinct row) >= {min_docs}),
cells as (select lang, source, term, count(*)::hugeint as n from t semi join kept using (lang, term) group by all),
langs as (select lang, count(*) as v, sum(in_lang) as lang_total from kept group by all),
groups as (select g.lang, g.source, coalesce(sum(n), 0)::hugeint as total, any_value(coalesce(v, 0)) as v, any_value(coalesce(lang_total, 0)) as lang_total
  from (select distinct lang, source from d) g left join langs using (lang) left join cells c on c.lang = g.lang and c.source = g.source group by all),
p as (select g.lang, g.source, k.term, coalesce(n, 0) as n, {share('coalesce(n, 0)', 'total')} as p, {share('in_lang', 'lang_total')} as q
  from groups g join kept k using (lang) left join cells c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, sum(abs(a.p - b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
every as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0) as value from groups a join groups b on a.lang = b.lang and a.source <> b.source left join pairs x on x.lang = a.lang and x.source = a.source and x.item = b.source),
terms as (select lang, source, 'term' as part, term as item, p - q as value from p where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (select * from every union all select * from terms))
select lang, source, part, item, value::bigint as value, rank::int as rank from r where part = 'pair' or rank <= {top}"""
