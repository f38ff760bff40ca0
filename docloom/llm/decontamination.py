"""Benchmark decontamination: documents that hold a passage within an edit distance of a benchmark item.

Words are the symbols. The CGK random walk [Chakraborty, Goldenberg, Koucky 2016] reads a word at each step and moves on
or stays as a random bit of that step and word says, so two sequences with few edits between them fall into step again
after each, and edit distance becomes Hamming distance between walks. Bit sampling on the walks (a few steps of each,
for several independent walks) is the LSH key. Item-sized windows of the documents are looked up in the items' tables,
and every candidate is verified by exact edit distance.

A window starts where a short run of words is one that some item has near its start: a passage within the allowed edits
keeps at least one such run whole, so no passage is lost by it, and other places need no walk. A walk takes 64 steps at
most: of a longer item each of its runs near the start has a walk of its own, and edits beyond 64 words from there don't
matter to it. The tests measure the recall of items of up to 250 words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import begin, cut

WORD = re.compile(r"\w+")
#: Walks, and steps sampled of each. At a similarity of 0.8 the tests measure a recall above 0.95 for them.
WALKS, SAMPLED = 12, 3
#: What a worker holds: words of items, words of documents that are searched together, and words whose codes are kept.
BLOCK_WORDS, _SLAB_WORDS, _KEPT_WORDS = 500_000, 250_000, 100_000
#: Places of a seed map for each seed, and bits of the largest map.
_ROOM, _MAP_BITS = 64, 22
MATCHES = "doc_id bigint, item_id bigint, distance int, item_words int, start_word bigint, end_word bigint, similarity double"


class _Codes(dict):
    """word -> 64-bit code; bounded, and the same on every worker."""

    room = _KEPT_WORDS

    def __missing__(self, word: str) -> int:
        code = xxhash.xxh64_intdigest(word) or 1
        if len(self) < self.room and len(word) <= 64:
            self[word] = code
        return code


_CODES = _Codes()


def _forget() -> None:
    _CODES.clear()


def codes(text: str | None) -> np.ndarray:
    """Codes of a text's words, in lower case and without marks."""
    words = WORD.findall(text.lower()) if text else []
    return np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))


def _odd(*seed: int, size) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, size, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


_GRAM = _odd(11, size=3)


def grams(tokens: np.ndarray, g: int) -> np.ndarray:
    """A code for each run of g words; as many as there are runs."""
    n = max(0, len(tokens) - g + 1)
    out = np.zeros(n, np.uint64)
    for k in range(g):
        out += tokens[k : k + n] * _GRAM[k]
    out ^= out >> np.uint64(29)
    return out * _GRAM[0]


def walk_keys(tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: int) -> np.ndarray:
    """WALKS x len(starts): the sampled steps of each walk from each start. Beyond its end a walk reads symbol 0."""
    out = np.zeros((WALKS, len(starts)), np.uint64)
    last = len(tokens) - 1
    for w in range(WALKS):
        bits, mixed = _odd(steps, w, 1, size=steps), _odd(steps, w, 2, size=steps)
        taken = np.random.default_rng((steps, w, 3)).choice(steps, min(SAMPLED, steps), replace=False)
        at, final = starts.copy(), int(taken.max())
        for t in range(final + 1):
            inside = at < ends
            symbol = np.where(inside, tokens[np.minimum(at, last)], np.uint64(0))
            if t in taken:
                out[w] += symbol * mixed[t]
            at += ((symbol * bits[t]) >> np.uint64(63)).astype(np.int64)
    return out


def within(item: list[int], region: list[int], most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the stretch of region nearest to item by edit distance, if at most `most`; the leftmost end on ties."""
    row, begun = list(range(len(item) + 1)), [0] * (len(item) + 1)
    best = (row[-1], 0, 0) if row[-1] <= most else None
    for j, r in enumerate(region, 1):
        above, diagonal = row, begun
        row, begun = [0] * len(above), [j] * len(above)
        for i, x in enumerate(item, 1):
            cost, start = above[i - 1] + (x != r), diagonal[i - 1]
            if above[i] + 1 < cost:
                cost, start = above[i] + 1, diagonal[i]
            if row[i - 1] + 1 < cost:
                cost, start = row[i - 1] + 1, begun[i - 1]
            row[i], begun[i] = cost, start
        if row[-1] <= most and (best is None or row[-1] < best[0]):
            best = (row[-1], begun[-1], j)
    return best


@dataclass
class _Class:
    """Items of one size class and run length: their seeds, and for each walk a sorted table of keys."""

    gram: int
    steps: int
    seeds: np.ndarray
    seen: np.ndarray  # a map over the seeds' leading bits
    shift: int  # bits that it leaves out
    keys: np.ndarray  # walks x entries, sorted
    order: np.ndarray  # the entry of each
    item: np.ndarray
    offset: np.ndarray


class Items:
    """Tables over a block of items."""

    def __init__(self, items: list[tuple[int, str | None]], similarity: float = 0.8):
        self.ids, self.words, self.most = [], [], []
        groups: dict[tuple[int, int], list[int]] = {}
        for item_id, text in items:
            w = codes(text)
            n = len(w)
            if item_id is None or not n:
                continue
            k = int(n * (1 - similarity) + 1e-9)
            gram = next((g for g in (3, 2) if n - g + 1 > g * k), 1)
            steps = min(64, 1 << (n.bit_length() - 1))
            groups.setdefault((gram, steps), []).append(len(self.ids))
            self.ids.append(item_id)
            self.words.append(w)
            self.most.append(k)
        self.plain = [w.tolist() for w in self.words]
        self.classes = [self._tables(gram, steps, members) for (gram, steps), members in sorted(groups.items())]

    def _tables(self, gram: int, steps: int, members: list[int]) -> _Class:
        at, tokens, starts, ends, item, offset, seeds = 0, [], [], [], [], [], []
        for m in members:
            w = self.words[m]
            runs = grams(w, gram)
            reach = min(len(runs), self.most[m] * gram + 1)  # each edit spoils `gram` runs, so one of these is whole
            tokens.append(w)
            for j in range(reach):
                starts.append(at + j)
                ends.append(at + len(w))
                item.append(m)
                offset.append(j)
            seeds.append(runs[:reach])
            at += len(w)
        keys = walk_keys(np.concatenate(tokens), np.array(starts), np.array(ends), steps)
        order = np.argsort(keys, axis=1, kind="stable").astype(np.int32)
        seeds = np.unique(np.concatenate(seeds))
        bits = min(_MAP_BITS, (len(seeds) * _ROOM).bit_length())
        seen = np.zeros(1 << bits, bool)
        seen[(seeds >> np.uint64(64 - bits)).astype(np.int64)] = True
        return _Class(gram, steps, seeds, seen, 64 - bits, np.take_along_axis(keys, order, axis=1), order, np.array(item), np.array(offset))

    def _candidates(self, tokens: np.ndarray, doc_ends: np.ndarray, c: _Class) -> np.ndarray:
        """Unique rows (item, place where the item's first word would be, document of the hit). The place may lie before the document."""
        runs = grams(tokens, c.gram)
        place = np.flatnonzero(c.seen[(runs >> np.uint64(c.shift)).astype(np.int64)])
        known = np.minimum(np.searchsorted(c.seeds, runs[place]), len(c.seeds) - 1)
        place = place[c.seeds[known] == runs[place]]
        place = place[place + c.gram <= doc_ends[np.searchsorted(doc_ends, place, side="right")]]
        if not len(place):
            return np.empty((0, 3), np.int64)
        owner = np.searchsorted(doc_ends, place, side="right")
        keys = walk_keys(tokens, place, doc_ends[owner], c.steps)
        out = []
        for w in range(WALKS):
            first, last = np.searchsorted(c.keys[w], keys[w], side="left"), np.searchsorted(c.keys[w], keys[w], side="right")
            many = last - first
            hit = np.repeat(np.arange(len(place)), many)
            entry = c.order[w][np.repeat(first - np.cumsum(many) + many, many) + np.arange(len(hit))]
            out.append(np.stack([c.item[entry], place[hit] - c.offset[entry], owner[hit]], axis=1))
        return np.unique(np.concatenate(out), axis=0)

    def matches(self, docs: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """(index of document, index of item, distance, start, end), the best for each pair of document and item."""
        sizes = np.array([len(d) for d in docs], np.int64)
        if not sizes.sum() or not self.ids:
            return []
        tokens, doc_ends = np.concatenate(docs), np.cumsum(sizes)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for c in self.classes:
            done: dict[tuple[int, int], int] = {}
            for m, at, d in self._candidates(tokens, doc_ends, c).tolist():
                k, n = self.most[m], len(self.words[m])
                low, high = int(doc_ends[d] - sizes[d]), int(doc_ends[d])
                a, b = max(low, at - k), min(high, at + n + k)
                if b - a < n - k or done.get((d, m), -1) >= b:
                    continue
                region = tokens[a:b].tolist()
                if sum(map(set(region).__contains__, self.plain[m])) < n - k:  # a set: arrays this short cost more to sort
                    continue
                got = within(self.plain[m], region, k)
                if got:
                    done[d, m] = b
                    one = (got[0], a - low + got[1], a - low + got[2])
                    best[d, m] = min(best.get((d, m), one), one)
        return [(d, m, *x) for (d, m), x in sorted(best.items())]


def _searched(items: Items):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("leaks", _forget)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
        names = [c.split()[0] for c in MATCHES.split(", ")]

        def found(ids: list, docs: list[np.ndarray]) -> pa.RecordBatch:
            rows = [(ids[d], items.ids[m], dist, len(items.words[m]), a, b, 1 - dist / len(items.words[m])) for d, m, dist, a, b in items.matches(docs)]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        ids, docs, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                docs.append(codes(text.as_py()))  # one text at a time
                held += len(docs[-1])
                if held >= _SLAB_WORDS:
                    yield found(ids, docs)
                    ids, docs, held = [], [], 0
        if ids:
            yield found(ids, docs)

    return search


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    block, held = [], 0
    for r in benchmark.orderBy("item_id").toLocalIterator():
        block.append((r.item_id, r.text))
        held += len(r.text or "") // 4 + 1
        if held >= BLOCK_WORDS:
            yield block
            block, held = [], 0
    if block or not held:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", similarity: float = 0.8) -> DataFrame:
    """One row for each pair of document and item: doc_id, item_id, distance, item_words, start_word, end_word, similarity.

    A pair is reported when a stretch of the document's words is within (1 - similarity) * item_words edits of the item;
    the nearest, then leftmost, stretch is given. Words are runs of letters and digits in lower case. Items go to the
    tasks in blocks of BLOCK_WORDS words, so what a worker holds is bounded; a larger benchmark means more passes over
    the documents, which are scanned whole and never shuffled. Items without words or with a null id match nothing;
    documents without words have no match. Repeated documents or items are rows of their own; a null doc_id is reported
    as null. Empty tables give an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    out = None
    for block in _blocks(items):
        part = rows.mapInArrow(_searched(Items(block, similarity)), MATCHES)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without those that hold a passage of the benchmark. Rows are told apart by doc_id and text, so a clean text stays
    whatever another row with its doc_id holds; rows with a null doc_id stay."""
    row = F.xxhash64(F.col(doc_id).cast("long"), F.col(text).isNull(), F.col(text))
    keyed = docs.where(F.col(doc_id).isNotNull()).select(row.alias("_row"), F.col(text).alias("text"))
    bad = cut(find_leaks(keyed, benchmark, doc_id="_row", **options).select(F.col("doc_id").alias("_row")).distinct(), "leaks")
    # written first: its size tells Spark whether to broadcast it
    return docs.join(bad, F.col(doc_id).isNotNull() & (row == F.col("_row")), "left_anti")
