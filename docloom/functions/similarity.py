"""Similarity of texts and vectors. Vector measures are expressions; fuzzy text ratios are Arrow-batched helpers."""

from __future__ import annotations

import difflib
import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 where a norm is 0."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(0.0)).otherwise(dot(a, b) / norms)


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence: bits of one integer stand for a's characters."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        hit = free & where.get(c, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def indel_ratio(a: str | None, b: str | None) -> float:
    """100 for equal texts, 0 for texts without a common character; null counts as empty."""
    a, b = a or "", b or ""
    return 100.0 if not a and not b else 200.0 * common_length(a, b) / (len(a) + len(b))


def best_window(a: str | None, b: str | None, gram: int = 4) -> float:
    """The best indel_ratio of the shorter text with a stretch of the longer one, of its length or cut off at the ends.

    Stretches where the shorter text's grams stand come first. Then the stretch slides along with a count of the
    characters that both have, which no common subsequence can pass, nor can it be longer by more than one than a place before;
    only where both leave room for a better one is it found, by bits of one integer. Nothing is kept of a stretch, so memory is that of the two texts.
    """
    short, long = sorted((a or "", b or ""), key=len)
    if not short:
        return 100.0 if not long else 0.0
    if short in long:
        return 100.0
    n, best, tried = len(short), 0.0, set()
    for i in range(0, n - gram + 1, gram):
        at = long.find(short[i : i + gram])
        for _ in range(8):
            if at < 0:
                break
            start = at - i
            if start not in tried and 1 - n <= start < len(long):
                tried.add(start)
                best = max(best, indel_ratio(short, long[max(0, start) : start + n]))
            at = long.find(short[i : i + gram], at + 1)
    left: dict[str, int] = {}  # of each character, how many of the shorter text's no place of the stretch has; below 0, how many more the stretch has
    for c in short:
        left[c] = left.get(c, 0) + 1
    common = reach = 0  # reach: what a subsequence of the stretch can have at most, by the last one found; a step adds one
    for end in range(1, len(long) + n):
        if end <= len(long):
            c = long[end - 1]
            rest = left.get(c, 0)
            common += rest > 0
            left[c] = rest - 1
        start = end - n
        if start > 0:
            c = long[start - 1]
            rest = left[c]
            common -= rest >= 0
            left[c] = rest + 1
        size, reach = min(end, len(long)) - max(0, start), reach + 1
        if 200.0 * min(common, reach) > best * (n + size):
            reach = common_length(short, long[max(0, start) : end])
            best = max(best, 200.0 * reach / (n + size))
    return best


def token_sort_ratio(a: str | None, b: str | None) -> float:
    return indel_ratio(" ".join(sorted((a or "").split())), " ".join(sorted((b or "").split())))


def sequence_ratio(a: str | None, b: str | None) -> float:
    return difflib.SequenceMatcher(None, a or "", b or "").ratio()


def _by_pair(measure):
    @F.pandas_udf("double")
    def measured(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([measure(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return measured


def fuzzy(a: Column, b: Column, kind: str = "ratio") -> Column:
    """kind: ratio, partial, token_sort (0 to 100), or sequence (0 to 1)."""
    return _by_pair({"ratio": indel_ratio, "partial": best_window, "token_sort": token_sort_ratio, "sequence": sequence_ratio}[kind])(a, b)


def common_terms(text: str | None) -> set[str]:
    return set(re.findall(r"\w+", (text or "").lower()))


def hash_embedding(text: Column, size: int = 1024) -> Column:
    """A unit vector drawn from a normal distribution by a generator that the text's MD5 seeds: equal texts, equal vectors. Null gives null."""

    @F.pandas_udf("array<double>")
    def drawn(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            v = np.random.RandomState(int(hashlib.md5(t.encode()).hexdigest(), 16) % (1 << 32)).normal(0, 1, size)
            return v / np.linalg.norm(v)

        return texts.map(one)

    return drawn(text)


def best_match(text: Column, choices: Column, least: float = 80.0) -> Column:
    """(choice, score): the array element most like text by token_sort_ratio, the first on ties; null where none reaches `least`."""

    @F.pandas_udf("choice string, score double")
    def matched(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for t, options in zip(texts, lists, strict=True):
            scored = [(token_sort_ratio(t, o), -k, o) for k, o in enumerate(options if options is not None else []) if o is not None]
            top = max(scored, default=(-1.0, 0, None)) if t is not None else (-1.0, 0, None)
            rows.append((top[2], top[0]) if top[0] >= least else (None, None))
        return pd.DataFrame(rows, columns=["choice", "score"]).astype({"score": "float64"})

    out = matched(text, choices)
    return F.when(out["choice"].isNotNull(), out)
