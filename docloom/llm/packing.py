"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most `capacity` tokens. Full pieces are sequences by themselves. The others are dealt by
hash over islands of a few thousand pieces. On an island an individual is a grouping of its pieces into bins, at first in
random orders; crossover
injects whole well-filled bins of one parent into the other, removes what is then twice there, and best-fits what was
displaced. Between epochs each island's elite, its fullest bins as lists of lengths, migrates to the next island in the
ring, which builds an individual around them from its own pieces of those lengths. At last the pieces of all poorly
filled bins are pooled on fewer islands, so that open bins don't add up with the number of islands.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import begin, cut
from .tokenizing import forget_encoders, text_encoder

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
ISLAND = 4_000
ELITE = 16


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document: its ids with end_id, cut only where they are more than capacity."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("pieces", forget_encoders)
        encoder, end = text_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for d, t in zip(batch.column(0).to_pylist(), map(pa.StringScalar.as_py, batch.column(1)), strict=True):
                code = encoder.encode(t) + end
                for k, at in enumerate(range(0, len(code), 4 * capacity)):
                    part = code[at : at + 4 * capacity]
                    rows.append((d, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut_up, PIECES)


class Island:
    """Groupings of one island's pieces. A bin is a list of piece indexes; a grouping is a list of bins."""

    def __init__(self, sizes: np.ndarray, capacity: int, seed: int):
        self.sizes, self.capacity, self.random = sizes.tolist(), capacity, np.random.default_rng(seed)
        self.fewest = -(-int(sizes.sum()) // capacity)
        self.crossed = self.depth = 0

    def fill(self, group: list[int]) -> int:
        return sum(map(self.sizes.__getitem__, group))

    def best_fit(self, items: list[int], bins: list[list[int]]) -> list[list[int]]:
        """Put each item, in the given order, into the fullest bin that has room; bins by their room in a bit set."""
        at: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        rooms = 0
        for k, group in enumerate(bins):
            room = self.capacity - self.fill(group)
            at[room].append(k)
            rooms |= 1 << room
        for item in items:
            size = self.sizes[item]
            fits = rooms >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                k = at[room].pop()
                if not at[room]:
                    rooms ^= 1 << room
                bins[k].append(item)
            else:
                room, k = self.capacity, len(bins)
                bins.append([item])
            at[room - size].append(k)
            rooms |= 1 << (room - size)
        return bins

    def falling(self, items) -> list[int]:
        return sorted(items, key=self.sizes.__getitem__, reverse=True)

    def worth(self, bins: list[list[int]]) -> tuple[int, float]:
        """Fewer bins are better; among as many, those with squares of fills that are larger."""
        return -len(bins), sum((self.fill(g) / self.capacity) ** 2 for g in bins)

    def first(self) -> list[list[int]]:
        """Best fit in a random order."""
        return self.best_fit(self.random.permutation(len(self.sizes)).tolist(), [])

    def inject(self, whole: list[list[int]], host: list[list[int]]) -> list[list[int]]:
        """host with the bins of whole: bins that share an item with them go, and their other items are best-fitted."""
        given = {i for g in whole for i in g}
        kept, displaced = [], []
        for group in host:
            rest = [i for i in group if i not in given]
            if len(rest) == len(group):
                kept.append(group[:])
            else:
                displaced += rest
        return self.best_fit(self.falling(displaced), [g[:] for g in whole] + kept)

    def cross(self, a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
        full = sorted(a, key=self.fill, reverse=True)[: max(1, len(a) // 3)]
        take = self.random.random(len(full)) < 0.5
        return self.inject([g for g, t in zip(full, take, strict=True) if t] or full[:1], b)

    def mutate(self, bins: list[list[int]]) -> list[list[int]]:
        """Empty the least filled bins and a few at random; best-fit their items."""
        order = sorted(range(len(bins)), key=lambda k: self.fill(bins[k]))
        gone = {*order[: 1 + len(bins) // 50], *self.random.integers(0, len(bins), 1 + len(bins) // 100).tolist()}
        return self.best_fit(self.falling(i for k in gone for i in bins[k]), [g[:] for k, g in enumerate(bins) if k not in gone])

    def realise(self, patterns: list[list[int]]) -> list[list[int]]:
        """Bins of the given lengths from this island's pieces, as far as it has them."""
        by_size: dict[int, list[int]] = {}
        for i, s in enumerate(self.sizes):
            by_size.setdefault(s, []).append(i)
        out = []
        for pattern in patterns:
            got: list[int] = []
            for s in pattern:
                if not by_size.get(s):
                    break
                got.append(by_size[s].pop())
            if len(got) == len(pattern):
                out.append(got)
            else:
                for i in got:
                    by_size[self.sizes[i]].append(i)
        return out

    def evolve(self, start: list[list[list[int]]], generations: int, population: int = 6) -> list[list[int]]:
        """The best grouping after some generations of crossover, from `start` and groupings in random orders.

        As many children as the population has are born before a grouping of the fewest bins that the total allows ends
        it; of equally good groupings a child goes before its forebears. `crossed` counts the crossovers, `depth` tells
        how many lie between the result and the first groupings.
        """
        if not self.sizes:
            return []
        group = [*start, *(self.first() for _ in range(max(2, population) - len(start)))]
        scored = sorted(((self.worth(g), 0, k, g) for k, g in enumerate(group)), reverse=True)
        for step in range(generations):
            if step >= len(group) and -scored[0][0][0] <= self.fewest:
                break
            a, b = self.random.choice(len(scored), 2, replace=False).tolist()
            child, depth = self.cross(scored[a][3], scored[b][3]), 1 + max(scored[a][1], scored[b][1])
            self.crossed += 1
            if step % 3 == 2:
                child = self.mutate(child)
            scored[-1] = max(scored[-1], (self.worth(child), depth, len(group) + step, child))
            scored.sort(reverse=True)
        self.depth = scored[0][1]
        return scored[0][3]

    def elite(self, bins: list[list[int]]) -> list[list[int]]:
        """The fullest bins of more than one piece, as lengths."""
        best = sorted((g for g in bins if len(g) > 1), key=self.fill, reverse=True)[:ELITE]
        return [sorted((self.sizes[i] for i in g), reverse=True) for g in best]


BINS = "uid bigint, length bigint, island bigint, bin int, fill bigint, elite array<array<int>>"


def _grouped(rows: pd.DataFrame, capacity: int, generations: int, migrants: list[list[int]]) -> pd.DataFrame:
    rows = rows.sort_values("uid", kind="stable").reset_index(drop=True)
    island = Island(rows["length"].to_numpy(np.int64), capacity, seed=int(rows["island"].iloc[0]) % (1 << 31))
    start = []
    if "bin" in rows:
        own = [g.tolist() for g in rows.groupby("bin", sort=True).indices.values()]
        start = [own]
        if whole := island.realise(migrants):
            start.append(island.inject(whole, own))
    best = island.evolve(start, generations)
    where, fill = np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int64)
    for k, g in enumerate(best):
        where[g], fill[g] = k, island.fill(g)
    elite = [None] * len(rows)
    elite[0] = island.elite(best)  # one row of an island carries it
    return rows[["uid", "length", "island"]].assign(bin=where, fill=fill, elite=elite)


def _epoch(rows: DataFrame, capacity: int, generations: int) -> DataFrame:
    """Evolve each island by itself. rows: uid, length, island."""
    return rows.groupBy("island").applyInPandas(lambda g: _grouped(g, capacity, generations, []), BINS)


def _migration(rows: DataFrame, islands: int, capacity: int, generations: int) -> DataFrame:
    """Evolve each island from its own grouping and the elite of the one before it in the ring."""
    sent = rows.where("elite is not null").select(((F.col("island") + 1) % islands).alias("island"), "elite")

    def received(own: pd.DataFrame, elite: pd.DataFrame) -> pd.DataFrame:
        if own.empty:
            return pd.DataFrame(columns=["uid", "length", "island", "bin", "fill", "elite"])
        return _grouped(own, capacity, generations, [[int(s) for s in p] for e in elite["elite"] for p in e])

    return rows.select("uid", "length", "island", "bin").groupBy("island").cogroup(sent.groupBy("island")).applyInPandas(received, BINS)


def _dealt(rows: DataFrame, islands: int, seed: int) -> DataFrame:
    return rows.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(islands)).cast("long").alias("island"))


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, doc_id: str = "doc_id", text: str = "text", generations: int = 18, well_filled: float = 0.99) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (gapless from 0).

    Null and empty texts hold end_id alone. Repeated rows and null doc_ids are packed like any other row; an empty table
    gives an empty result. Islands are as many as the pieces need at ISLAND each, so no task's work grows with the input,
    and their number has no part in what a piece holds. Every epoch is written to the shared folder.
    """
    pieces = cut(pieces_of(docs, tokenizer, end_id, capacity, doc_id, text).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})
    loose = pieces.where(F.col("length") < capacity).select("uid", "length")
    islands = max(1, -(-loose.count() // ISLAND))
    now = cut(_epoch(_dealt(loose, islands, 0), capacity, generations), "epoch")
    if islands > 1:
        now = cut(_migration(now, islands, capacity, generations), "epoch")
        poor = F.col("fill") < well_filled * capacity
        pooled = now.where(poor)
        few = max(1, -(-pooled.count() // ISLAND))
        # bins of the pool are numbered after those of the islands
        last = cut(_epoch(_dealt(pooled, few, 1), capacity, 4 * generations).withColumn("island", F.col("island") + islands), "epoch")
        now = now.where(~poor).unionByName(last)
    bins = now.select("uid", (F.col("island") * (ISLAND * 8) + F.col("bin")).alias("sequence_id"))
    placed = pieces.join(bins, "uid")
    offset = F.expr("coalesce(sum(length) over (partition by sequence_id order by uid rows between unbounded preceding and 1 preceding), 0)")
    return placed.withColumn("offset", offset).unionByName(whole).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
