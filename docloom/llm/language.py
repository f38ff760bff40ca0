"""Language identification by cross-parsing: the language whose labelled text needs fewest phrases to cover a text.

A phrase is the longest match from its start that occurs anywhere in a language's sample, and at least one symbol. The
suffix automaton of the sample accepts exactly its substrings, so the longest match is a walk from the root until no
transition is left. Transitions lie in a hash table; a missing one leads on from the root and marks a phrase, so a parse
is one walk, and many blocks of text walk in step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512
#: Symbols: 0 any run of non-letters, 1 any letter that no sample has, then the samples' letters, all of them.
GAP, STRANGE = 0, 1
_SLAB = 1 << 21
_CODE_POINTS = 0x110000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def suffix_automaton(symbols: np.ndarray) -> tuple[int, np.ndarray]:
    """(states, transitions as rows (state, symbol, next state)) of the automaton that accepts all substrings; state 0 is the root."""
    link, length = [-1], [0]
    rows: list[dict[int, int]] = [{}]
    last = 0
    for c in symbols.tolist():
        cur = len(rows)
        rows.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in rows[p]:
            rows[p][c] = cur
            p = link[p]
        if p != -1:
            q = rows[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(rows)
                rows.append(dict(rows[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and rows[p].get(c) == q:
                    rows[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return len(rows), np.array([(state, c, to) for state, row in enumerate(rows) for c, to in row.items()], np.int64).reshape(-1, 3)


class Transitions:
    """An automaton's transitions in a hash table with linear probing; any number of symbols costs no room for those a state lacks."""

    def __init__(self, states: int, edges: np.ndarray, width: int):
        self.width, self.alone = width, states  # alone: the state after a symbol that the sample lacks
        self.root = np.full(width, states, np.int32)
        at_root = edges[edges[:, 0] == 0]
        self.root[at_root[:, 1]] = at_root[:, 2]
        bits = max(4, (2 * len(edges)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        keys, to = edges[:, 0] * width + edges[:, 1], edges[:, 2]
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == -1)
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.to[slot[placed]] = keys[placed], to[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, to, slot = keys[rest], to[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _SPREAD) >> self.shift).view(np.int64)

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, whether a phrase ends before the symbol): a missing transition starts a phrase at the root."""
        keys = states.astype(np.int64) * self.width + symbols
        slot = self._slot(keys)
        held = self.keys[slot]
        out, ended = self.to[slot], held == -1
        open_ = np.flatnonzero((held != keys) & ~ended)
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            held = self.keys[slot[open_]]
            out[open_] = self.to[slot[open_]]
            ended[open_] = held == -1
            open_ = open_[(held != keys[open_]) & (held != -1)]
        return np.where(ended, self.root[symbols], out), ended


@dataclass
class Languages:
    names: list[str]
    letters: np.ndarray  # code point -> symbol
    tables: list[Transitions]

    def symbols(self, text: str) -> np.ndarray:
        """The text's letters in lower case, with one gap for each run of other characters, but none at either end."""
        s = self.letters[np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")]
        keep = s != GAP
        keep[1:] |= s[:-1] != GAP
        s = s[keep]
        a = 1 if len(s) and s[0] == GAP else 0
        return s[a : len(s) - 1 if len(s) > a and s[-1] == GAP else len(s)]

    def phrases(self, blocks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of each block (row, padded) by language, but for the one that its end closes."""
        out = np.zeros((len(self.tables), len(blocks)), np.int64)
        order = np.argsort(-sizes, kind="stable")
        columns, sizes = np.ascontiguousarray(blocks[order].T), sizes[order]
        live = np.searchsorted(-sizes, -np.arange(blocks.shape[1]), side="left")  # rows longer than each place
        for k, table in enumerate(self.tables):
            state, found = table.root[columns[0]], np.zeros(len(blocks), np.int64)
            for t in range(1, blocks.shape[1]):
                n = live[t]
                if not n:
                    break
                state[:n], ended = table.step(state[:n], columns[t, :n])
                found[:n] += ended
            out[k, order] = found
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        held: list[tuple[int, np.ndarray]] = []
        room = 0
        for k, text in enumerate(texts):
            s = self.symbols(text) if text else np.empty(0, np.int32)
            if len(s) and self.names:
                held.append((k, s))
                room += len(s)
            if held and (room >= _SLAB or k == len(texts) - 1):
                self._decide(held, names, scores)
                held, room = [], 0
        if held:
            self._decide(held, names, scores)
        return names, scores

    def _decide(self, held: list[tuple[int, np.ndarray]], names: list[str], scores: list[float]) -> None:
        counts = np.array([-(-len(s) // BLOCK) for _, s in held])
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        sizes = np.full(int(counts.sum()), BLOCK)
        blocks = np.zeros((len(sizes), BLOCK), np.int32)
        for (_, s), a, c in zip(held, starts, counts, strict=True):
            blocks[a : a + c].reshape(-1)[: len(s)] = s
            sizes[a + c - 1] = len(s) - (c - 1) * BLOCK
        # the phrase that a block's end closes counts too
        total = np.add.reduceat(self.phrases(blocks, sizes) + 1, starts, axis=1)
        for (k, s), own in zip(held, total.T, strict=True):
            rank = np.argsort(own, kind="stable")
            names[k] = self.names[rank[0]]
            if len(own) == 1:
                scores[k] = 1.0
            else:
                # entropy estimate in bits: phrases * log2(length); what the runner-up needs more, as odds
                gap = float(own[rank[1]] - own[rank[0]]) * np.log2(len(s) + 1)
                scores[k] = float(1 - 0.5 ** (1 + min(gap, 60.0)))


def learn(samples: dict[str, list[str]], symbols_each: int = 40_000, symbols_in_all: int = 1_600_000) -> Languages:
    """Build the automata from each language's sample texts: symbols_each symbols a language, or an equal part of
    symbols_in_all where that is less, which bounds the model. Every letter of the samples is a symbol of its own."""
    names = sorted(samples)
    seen = np.array(sorted({ord(c) for texts in samples.values() for t in texts for c in t.lower() if c.isalpha()}), np.int64)
    letters = np.array([STRANGE if chr(k).isalpha() else GAP for k in range(_CODE_POINTS)], np.int32)
    letters[seen] = np.arange(len(seen)) + 2
    model = Languages(names, letters, [])
    for name in names:
        parts, room = [np.empty(0, np.int32)], max(1, min(symbols_each, symbols_in_all // len(names)))
        for text in samples[name]:
            s = model.symbols(text)[:room]
            parts += [s, np.array([GAP], np.int32)]
            room -= len(s) + 1
            if room <= 0:
                break
        model.tables.append(Transitions(*suffix_automaton(np.concatenate(parts)), len(seen) + 2))
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id as text, modulo 4, is 2: rows that training never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 64, chars: int = 4_000) -> dict[str, list[str]]:
    """Up to per_language labelled texts of each language that aren't held out, by the least hash of doc_id.

    A text longer than chars gives a stretch of that length from a place that its hash picks. Counts come first, so that
    each language is thinned to a few hundred rows before any are gathered; the driver gets per_language * chars
    characters a language at most.
    """
    known = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t"), F.col(lang).alias("l")).where("d is not null and t is not null and l is not null").where(~held_out("d"))
    rows = known.withColumn("h", F.pmod(F.xxhash64("d", "l"), F.lit(1 << 40)))
    sizes = {r.l: r.n for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, int(min(1.0, 4 * per_language / n) * (1 << 40)))])
    start = F.expr(f"cast(pmod(xxhash64(h), greatest(length(t) - {chars}, 0) + 1) as int) + 1")
    thin = rows.where(F.col("h") < share[F.col("l")]).select("l", "h", "d", F.substring("t", start, F.lit(chars)).alias("t"))
    first = thin.selectExpr("*", "row_number() over (partition by l order by h, d, t) as k").where(F.col("k") <= per_language)
    out: dict[str, list[str]] = {}
    for r in sorted(first.select("l", "k", "t").collect(), key=lambda r: (r.l, r.k)):
        out.setdefault(r.l, []).append(r.t)
    return out


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", model: Languages | None = None) -> DataFrame:
    """One row for each document: doc_id, held_out, lang_pred, score (0 to 1; 0.5 and more unless undecided, 0 for und).

    Whole texts are parsed, in blocks of BLOCK symbols; a phrase ends with its block. Fewest phrases win, ties by name.
    Null texts and those without a letter, or all if nothing could be learned, get `und`. Rows stay one for one; null
    doc_ids are kept and not held out; an empty table gives an empty result.
    """
    model = model or learn(sample_texts(docs, doc_id, text, lang))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by symbols_in_all, and an array of all code points

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores = shared.value.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), predicted(F.col(text)).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")
