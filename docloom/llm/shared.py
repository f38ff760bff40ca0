"""What the corpus operators share: the shared folder, cut lineage and connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="docloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share. Where it is unset: a folder of our own in
    local mode, as in tests; on a cluster the warehouse, unless that is a folder of one machine."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.startswith("local"):
        return _own_folder()
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")):
        raise ValueError("spark.checkpoint.dir is unset and the warehouse is a folder of one machine")
    return warehouse


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/docloom/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: its lineage ends here, and lost executors lose nothing."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._docloom_folder = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what cut() wrote for frames that nothing reads any more."""
    for df in frames:
        remove(df.sparkSession, df._docloom_folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that fresh_path() or a caller named, on whatever store it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Bits of the largest bitmap of sieve(), 16 MB, and bits for each key below that.
_SIEVE_BITS, _ROOM = 27, 64


def sieve(rows: DataFrame, code: Column, keys: DataFrame, flag: str | None = None) -> DataFrame:
    """The rows whose code (a 64-bit hash) a bitmap of the keys has: all that keys has, and a few others. With flag: all rows,
    with a column of that name which says so.

    keys: one column of codes, read twice. The bitmap is broadcast in pieces of 4 KB, 16 MB at any size, so rows stay where they are.
    """
    name = keys.columns[0]
    bits = min(_SIEVE_BITS, max(15, (keys.count() * _ROOM).bit_length()))
    place = lambda c: F.shiftrightunsigned(c, 64 - bits)
    pieces = keys.select(place(F.col(name)).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits"))
    placed = rows.withColumn("_place", place(code))
    met = placed.join(F.broadcast(pieces), F.bitmap_bucket_number("_place") == F.col("_piece"), "left")
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    has = F.coalesce(F.expr("shiftright(_byte, cast(bitmap_bit_position(_place) % 8 as int)) & 1") == 1, F.lit(False))
    met = met.withColumn("_byte", byte).withColumn(flag or "_has", has).drop("_place", "_piece", "_bits", "_byte")
    return met if flag else met.where("_has").drop("_has")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What tasks of this worker keep between them, by operator: how to give it back.
_HELD: dict[str, Callable[[], None]] = {}


def nothing() -> None:
    pass


def begin(operator: str, release: Callable[[], None] = nothing) -> None:
    """For the start of an operator's task in a Python worker. Workers are reused: what tasks of other operators cached there
    (release empties it) goes back to the system before this one fills its own."""
    others = [name for name in _HELD if name != operator]
    for name in others:
        _HELD.pop(name)()
    _HELD[operator] = release
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)


def _edge_state(edges: DataFrame) -> tuple:
    # a sum of decimals cannot overflow and does not depend on the order of rows
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph, as (node, root) with the smallest node of each component as root.

    edges: two columns of one orderable type. Null ends and loops are ignored; nodes without an edge don't appear.
    Alternates large-star and small-star steps [Kiveris et al. 2014]; all state stays in the shared folder, and each step
    is a grouped minimum (combined before the shuffle) and an equi-join that adaptive execution can split on hot nodes.
    """
    e = (
        edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
        .where("x is not null and y is not null and x <> y")
        .select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
        .distinct()
    )
    e = cut(e, "edges")
    state = _edge_state(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("p"))
        before_small, e = e, cut(small.select("p.u", "p.v").where("u <> v").distinct(), "small")
        discard(before_small, large)
        before, state = state, _edge_state(e)
        if state == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
