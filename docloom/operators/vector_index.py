"""Nearest vectors by cosine: in blocks against all rows, and by an index of lists that leaves out what can't be near."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Vectors and queries of a block, and vectors that centres are fitted on.
VECTORS, QUERIES, SAMPLE = 20_000, 2_000, 20_000
#: Cosines of equal vectors differ by rounding; angles are taken a little wider.
_SLACK = 1e-6


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in rows])


def _units(rows: pd.Series) -> np.ndarray:
    m = _matrix(rows)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def usable(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """Rows whose vector has a direction: not null, empty or zero, no null or non-finite component; as array<double>."""
    v = vectors.withColumn(embedding, F.col(embedding).cast("array<double>"))
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(embedding, lambda x: x != 0)
    return v.where(F.coalesce(sound, F.lit(False)))


def _best(k: int):
    """The k best vectors of a block for each query of a block: single precision rules out what is too far, doubles decide among the rest."""

    def best(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"q_id": [], "id": [], "c": []}).astype({"q_id": "int64", "id": "int64", "c": "float64"})
        if queries.empty or vectors.empty:
            return empty
        q_id, ids, v = queries["q_id"].to_numpy(np.int64), vectors["of"].to_numpy(np.int64), _units(vectors["vv"])
        single = v.astype(np.float32).T
        slack = 2 * (v.shape[1] + 4) * 2.0**-23  # more than two products of unit vectors in single precision can be off
        out = []
        for at in range(0, len(q_id), 256):
            q = _units(queries["qv"].iloc[at : at + 256])
            c = q.astype(np.float32) @ single
            some = c[:, : max(k, 2048)].copy()  # the k-th best of some is no better than that of all
            some[q_id[at : at + 256, None] == ids[None, : some.shape[1]]] = -np.inf
            bound = np.partition(some, -k, axis=1)[:, -k] if some.shape[1] >= k else np.full(len(q), -np.inf)
            for i, own in enumerate(q_id[at : at + 256]):
                col = np.flatnonzero(c[i] >= bound[i] - slack)
                col = col[ids[col] != own]
                if not len(col):
                    continue
                near = v[col] @ q[i]
                order = np.lexsort((ids[col], -near))
                col, near = col[order], near[order]
                # with what ties for the last place, but of equal cosines the first k ids are enough
                held = (near >= near[min(k, len(col)) - 1] - 1e-9) & (np.arange(len(col)) - np.searchsorted(-near, -near) < k)
                out.append((np.full(held.sum(), own), ids[col[held]], near[held]))
        return pd.DataFrame(dict(zip(("q_id", "id", "c"), map(np.concatenate, zip(*out, strict=True)), strict=True))) if out else empty

    return best


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q_id").orderBy(F.desc(F.round("c", 9)), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def nearest(queries: DataFrame, vectors: DataFrame, k: int, n_vectors: int, n_queries: int) -> DataFrame:
    """(q_id, id, c, rank): the k vectors of highest cosine to each query, itself left out, by id where cosines agree to nine digits.

    queries: q_id, v. vectors: id, v; n_vectors and n_queries are about how many there are. Every block of queries meets
    every block of vectors in one task, which gives the k best of the block; no pair leaves it.
    """
    parts, blocks = max(1, -(-n_vectors // VECTORS)), max(1, -(-n_queries // QUERIES))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")  # noqa: E731  (both sides' keys need one type, or their groups don't meet)
    q = queries.select("q_id", F.col("v").alias("qv"), dealt("q_id", blocks).alias("qp")).withColumn("vp", all_of(parts))
    v = vectors.select(F.col("id").alias("of"), F.col("v").alias("vv"), dealt("id", parts).alias("wp")).withColumn("wq", all_of(blocks))
    found = q.groupBy("vp", "qp").cogroup(v.groupBy("wp", "wq")).applyInPandas(_best(k), "q_id bigint, id bigint, c double")
    return _ranked(found, k)


def nearest_of_all(vectors: DataFrame, k: int, n_vectors: int) -> DataFrame:
    """(q_id, id, c, rank) as nearest() gives them, with every vector as a query.

    vectors: id, v; n_vectors is about how many there are. Each pair of blocks meets once, in a task that holds the two blocks and
    looks both ways; all pairs are looked at, so the time grows with the square of the vectors.
    """
    parts = max(1, -(-n_vectors // VECTORS), min(6, n_vectors // 1000))
    other = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    v = vectors.select(F.col("id").alias("of"), F.col("v").alias("vv"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")).withColumn("other", other)
    best = _best(k)

    def both_ways(block: pd.DataFrame) -> pd.DataFrame:
        low, high = block[block["part"] == block["low"]], block[block["part"] == block["high"]]
        asked = lambda rows: rows[["of", "vv"]].set_axis(["q_id", "qv"], axis=1)
        found = best(asked(low), high)
        return found if (block["low"] == block["high"]).all() else pd.concat([found, best(asked(high), low)], ignore_index=True)

    pairs = v.select("of", "vv", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    return _ranked(pairs.groupBy("low", "high").applyInPandas(both_ways, "q_id bigint, id bigint, c double"), k)


def fit_centres(vectors: DataFrame, lists: int, sample: int = SAMPLE, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Unit vectors, at most `lists`, around which others lie: spherical k-means on at most `sample` vectors. vectors: v."""
    n = vectors.count()
    rows = vectors.sample(min(1.0, sample / max(1, n)), seed).limit(sample).toPandas()
    if rows.empty:
        return np.zeros((0, 1))
    x, rng = _units(rows["v"]), np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        of = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def _angles(c: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(c, -1.0, 1.0))


def _assigned(centres: np.ndarray):
    def assigned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            c = _units(frame["v"]) @ centres.T
            of = c.argmax(axis=1)
            yield frame.assign(list=of, angle=_angles(c[np.arange(len(of)), of]))

    return assigned


def write_index(vectors: DataFrame, path: str, lists: int, sample: int = SAMPLE) -> None:
    """Vectors (id, v) as Parquet under path, a folder for each list: each vector in the list of its nearest centre, with its angle to
    it. The centres (fitted on at most `sample` vectors), and each list's size and least and greatest angle, lie beside."""
    spark, centres = vectors.sparkSession, fit_centres(vectors.select("v"), lists, sample)
    placed = vectors.select("id", "v").mapInPandas(_assigned(centres), "id bigint, v array<double>, list int, angle double")
    placed.repartition("list", F.pmod(F.xxhash64("id"), F.lit(4))).write.mode("overwrite").partitionBy("list").parquet(f"{path}/vectors")
    back = spark.read.parquet(f"{path}/vectors")
    shape = back.groupBy("list").agg(F.count("*").alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    rows = [(k, c.tolist()) for k, c in enumerate(centres)]
    spark.createDataFrame(rows, "list int, centre array<double>").join(shape, "list").coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")


def _probes(centres: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Each query with each list: the least angle that a vector of the list can have to it, and the list's place by that."""

    def probes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            a = _angles(_units(frame["v"]) @ centres.T)
            least = np.maximum(0.0, np.maximum(a - high, low - a))
            place = np.lexsort((a, least), axis=1).argsort(axis=1)
            n = len(ids)
            yield pd.DataFrame({"q_id": np.repeat(frame["q_id"].to_numpy(), n), "list": np.tile(ids, len(frame)), "to_centre": a.ravel(), "least": least.ravel(), "place": place.ravel()})

    return probes


def search(spark: SparkSession, path: str, queries: DataFrame, k: int, first: int = 2) -> tuple[DataFrame, DataFrame]:
    """(the rows that nearest() gives, (q_id, list) of the lists that were read for each query).

    Each query reads the `first` lists that can be nearest. A list whose least possible angle, by the triangle
    inequality from its centre, is greater than that of the k-th vector found there holds nothing nearer and isn't read.
    So nothing is lost, and how much is read depends on how
    far apart the vectors lie: lists that all lie at like angles to a query can't be left out.
    """
    lists = spark.read.parquet(f"{path}/lists").orderBy("list").toPandas()
    ids = lists["list"].to_numpy(np.int32)
    probe = queries.select("q_id", "v").mapInPandas(_probes(_matrix(lists["centre"]), ids, lists["low"].to_numpy(), lists["high"].to_numpy()), "q_id bigint, list int, to_centre double, least double, place int")
    vectors = spark.read.parquet(f"{path}/vectors")
    sized = spark.read.parquet(f"{path}/lists").select("list", (F.floor((F.col("n") - 1) / VECTORS) + 1).cast("int").alias("parts"))

    def scored(pairs: DataFrame) -> DataFrame:
        blocks = 16
        q = pairs.join(queries.select("q_id", F.col("v").alias("qv")), "q_id").join(F.broadcast(sized), "list")
        q = q.withColumn("vp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("qp", F.pmod(F.xxhash64("q_id"), F.lit(blocks)))
        wanted = pairs.select("list", F.pmod(F.xxhash64("q_id"), F.lit(blocks)).alias("wq")).distinct()
        v = vectors.join(F.broadcast(sized), "list").withColumn("wp", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).join(wanted, "list")
        v = v.select(F.col("id").alias("of"), F.col("v").alias("vv"), F.col("list").alias("wl"), "wp", "wq")
        return q.select("q_id", "qv", "list", "vp", "qp").groupBy("list", "vp", "qp").cogroup(v.groupBy("wl", "wp", "wq")).applyInPandas(_best(k), "q_id bigint, id bigint, c double")

    near = probe.where(F.col("place") < first)
    begun = scored(near)
    kth = _ranked(begun, k).groupBy("q_id").agg(F.when(F.count("*") >= k, F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.min("c")))) + _SLACK).otherwise(math.pi + 1).alias("bound"))
    more = probe.where(F.col("place") >= first).join(kth, "q_id", "left").where(F.col("least") <= F.coalesce("bound", F.lit(math.pi + 1)))
    found = begun.unionByName(scored(more.select("q_id", "list")))
    return _ranked(found, k), near.select("q_id", "list").unionByName(more.select("q_id", "list"))
