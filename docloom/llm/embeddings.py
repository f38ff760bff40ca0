"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine >= c are within squared distance 2 - 2c. After a rotation that spreads energy evenly, they are
split into blocks of a few dimensions; were every block of a pair over its share of that budget, the sum would be over
it too. So each block is range-joined under its share: a grid over some of its dimensions gives the equi-key, one side
standing in its own cell and the other in all cells its ball touches, and the join condition is the block's squared
distance. The union over the blocks is then verified exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, cut

BLOCK = 8
_SLACK = 1e-5  # coordinates are kept as floats
ROWS = "vec_id bigint, label string, key binary, raw array<double>, blocks array<array<float>>"


def rotation(size: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same on every worker."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _prepared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    turns: dict[int, np.ndarray] = {}
    for frame in frames:
        rows = []
        for vec_id, label, v in frame.itertuples(index=False):
            a = None if v is None else np.array([np.nan if x is None else x for x in v], np.float64)
            top = 0.0 if a is None or not len(a) or not np.isfinite(a).all() else float(np.abs(a).max())
            if label is None or not top:
                rows.append((vec_id, label, None, None, None))
                continue
            a = np.ldexp(a, -math.frexp(top)[1]) + 0.0  # by a power of two, so no square overflows; no negative zero
            if len(a) not in turns:
                turns[len(a)] = rotation(len(a))
            unit = turns[len(a)] @ (a / np.linalg.norm(a))
            parts = np.zeros((-(-len(a) // BLOCK), BLOCK), np.float32)
            parts.reshape(-1)[: len(a)] = unit
            rows.append((vec_id, label, hashlib.blake2b(label.encode() + b"\0" + a.tobytes(), digest_size=16).digest(), a, list(parts)))
        yield pd.DataFrame(rows, columns=["vec_id", "label", "key", "raw", "blocks"]).astype({"vec_id": "Int64"})


def candidates(classes: DataFrame, budget: float, gridded: int) -> DataFrame:
    """Pairs (a, b), a < b, of classes with one label and size that meet a block's share of the budget in some block.

    classes: id, label, blocks. gridded: how many of a block's dimensions the grid has.
    """
    share = F.lit(budget) / F.size("blocks")
    flat = classes.select("id", "label", F.size("blocks").alias("m"), (F.sqrt(share) + _SLACK).alias("r"), F.posexplode("blocks").alias("block", "x"))
    flat = flat.select("id", "label", "m", "r", "block", *[F.col("x")[k].alias(f"x{k}") for k in range(BLOCK)])
    cell = lambda e: F.floor(e / (2 * F.col("r")))
    key = lambda cells: F.xxhash64("label", "m", "block", *cells)
    home = flat.select(F.col("id").alias("b"), key([cell(F.col(f"x{k}")) for k in range(gridded)]).alias("key"), F.col("label").alias("label_b"), F.col("block").alias("block_b"), *[F.col(f"x{k}").alias(f"y{k}") for k in range(BLOCK)])
    probe = flat
    for k in range(gridded):
        touched = F.sequence(cell(F.col(f"x{k}") - F.col("r")), cell(F.col(f"x{k}") + F.col("r")))
        probe = probe.withColumn(f"c{k}", F.explode(touched))
    probe = probe.select(F.col("id").alias("a"), "label", "block", "r", key([F.col(f"c{k}") for k in range(gridded)]).alias("key"), *[f"x{k}" for k in range(BLOCK)])
    far = " + ".join(f"(x{k} - y{k}) * (x{k} - y{k})" for k in range(BLOCK))
    return probe.join(home, "key").where(f"a < b and label = label_b and block = block_b and {far} <= r * r").select("a", "b").distinct()


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding", cosine: float = 0.98) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null and their cosine, in double precision, is at least `cosine`.
    Every vector is scaled by a power of two first, so its length never overflows.
    Equal vectors of a label form a class, which is joined once with its size as weight; n_links counts all other rows
    linked directly. Vectors that are null, empty, zero or hold a null or non-finite component, and those with a null
    label, link with nothing: their component is their own vec_id. Vectors of different sizes don't link. Rows that
    share a vec_id are vectors of their own; a null vec_id has a null component unless what it is linked to has an id.
    An empty table gives an empty result.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    rows = cut(rows.mapInPandas(_prepared, ROWS), "vectors")
    usable = rows.where("key is not null")
    classes = usable.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("raw").alias("raw"), F.first("blocks").alias("blocks"))
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    gridded = min(BLOCK, 3 + max(0, math.ceil(math.log(max(classes.count(), 1) / 100_000, 4))))
    found = candidates(classes.select("id", "label", "blocks"), 2 - 2 * cosine, gridded)
    left = classes.select(F.col("id").alias("a"), F.col("raw").alias("va"), F.col("n").alias("na"))
    right = classes.select(F.col("id").alias("b"), F.col("raw").alias("vb"), F.col("n").alias("nb"))
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    near = dot("va", "vb") / F.sqrt(dot("va", "va") * dot("vb", "vb")) >= cosine
    links = cut(found.join(left, "a").join(right, "b").where((F.size("va") == F.size("vb")) & near).select("a", "b", "na", "nb"), "links")
    others = links.select(F.col("a").alias("id"), F.col("nb").alias("n")).unionAll(links.select("b", "na")).groupBy("id").agg(F.sum("n").alias("linked"))
    roots = components(links, "a", "b").select(F.col("node").alias("id"), "root")
    named = cut(classes.select("key", "id", "rep", "n").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "named")
    known = named.join(named.groupBy("root").agg(F.min("rep").alias("component_id")), "root").join(others, "id", "left")
    known = known.select("key", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    out = usable.select("vec_id", "key").join(known, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
