"""Token counts without token ids: byte-pair merging on a heap and a linked list."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokenizing import CACHE_ENTRIES, Words, byte_letters

# Fixed value: how byte-level vocabularies split a text, but for white space, which is split off before.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+")


def merges_done(symbols: list[str], rank: dict[tuple[str, str], int]) -> int:
    """How many merges byte-pair encoding makes: pops the pair of lowest rank (leftmost on ties) until none is left.

    Neighbours are linked by index. A popped entry is stale when its pair has changed since it was pushed.
    """
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := rank.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    done = 0
    while heap:
        r, i = heapq.heappop(heap)
        j = after[i]
        if j >= n or not symbols[i] or rank.get((symbols[i], symbols[j])) != r:
            continue
        symbols[i] += symbols[j]
        symbols[j] = ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := rank.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := rank.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h))
        done += 1
    return done


class TokenCounter:
    """Counts tokens of a byte-level vocabulary file; special strings inside a text count as one token each."""

    def __init__(self, path: str, room: int = CACHE_ENTRIES):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"])
        self.rank = {pair: r for r, pair in enumerate(pairs)}
        self.letters = byte_letters()
        strings = sorted((regex.escape(t["content"]) for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(strings)) if strings else None
        self.words = Words(self._count_chunk, lambda word: self._count_chunk(" " + word), sum, True, room)

    def _count_chunk(self, chunk: str) -> int:
        total = 0
        for piece in PIECES.findall(chunk):
            symbols = [self.letters[b] for b in piece.encode()]
            total += len(symbols) - merges_done(symbols.copy(), self.rank)
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(sum(self.words.values_of(p)) for p in parts if p)


@lru_cache(maxsize=2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_count(text: Column, path: str) -> Column:
    """Number of tokens of a text under the byte-level vocabulary in path; 0 for null and empty texts."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(path)
        for texts in batches:
            yield texts.map(counter.count, na_action=None).astype("int64")

    return counted(text)


def with_token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """docs with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit); columns of these names are replaced.

    No shuffle: one pass over the texts. Null texts count as empty (0, 0, false). Rows are kept one for one, repeated
    ones too, with any other column as it is; an empty table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"n_bytes": F.octet_length(body).cast("long"), "n_tokens": token_count(body, path)}).withColumn("over_limit", F.col("n_tokens") > limit)
