"""Token ids in files: frequency-ranked, byte-aligned variable-length coding with separate control bytes.

Format. A folder holds `ranks` (token_id, rank; Parquet) and `shards` (Parquet). Ids are replaced by their rank in the
corpus, the most frequent being 0, so that most take one byte. A block is one row of shards:

    shard int, block int    ascending order of documents: by shard, then block, then place in the block
    before bigint           tokens of the shard's blocks before this one
    doc_ids, n_tokens       arrays, one entry for each document of the block (n_tokens with the end id)
    control binary          two bits a token, four tokens a byte, lowest bits first: length of its code minus one
    data binary             the codes, little-endian, one to four bytes each

A decoder looks up, for each control byte, the four lengths in a table of 256 rows, sums them up for the places of the
codes, and gathers those.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import remove
from .tokenizing import text_encoder

BLOCK_TOKENS = 1 << 18
LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
PLACE = "shard int, block int, before bigint, doc_ids array<bigint>, n_tokens array<bigint>"
STAGED = f"{PLACE}, ids binary"
SHARDS = f"{PLACE}, control binary, data binary"


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    extra = (v > 0xFF).view(np.uint8) + (v > 0xFFFF).view(np.uint8) + (v > 0xFFFFFF).view(np.uint8)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = extra
    control = codes[::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    starts = np.cumsum(extra, dtype=np.int64) - extra + np.arange(len(v))
    data = np.zeros(len(v) + int(extra.sum(dtype=np.int64)), np.uint8)
    data[starts] = v & 0xFF
    at = np.arange(len(v))
    for k in (1, 2, 3):
        at = at[extra[at] >= k]
        data[starts[at] + k] = v[at] >> (8 * k) & 0xFF
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values that pack() was given."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(size, dtype=np.int64) - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[starts].astype(np.uint32)
    at = np.arange(n)
    for k in (1, 2, 3):
        at = at[size[at] > k]
        out[at] |= raw[starts[at] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _encode_blocks(path: str, kind: str, end_id: int):
    """Sorted (doc_id, text) rows of a partition to blocks of raw ids."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, n_blocks, before = text_encoder(path), TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        doc_ids, lengths, parts, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4").astype(kind).tobytes()
            return _row(STAGED, [shard, n_blocks, before, doc_ids, lengths, ids])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), map(pa.StringScalar.as_py, batch.column(1)), strict=True):  # one text at a time
                code = encoder.encode(text) + end
                doc_ids.append(doc_id)
                lengths.append(len(code) // 4)
                parts.append(code)
                held += lengths[-1]
                if held >= BLOCK_TOKENS:
                    yield block()
                    n_blocks, before = n_blocks + 1, before + held
                    doc_ids, lengths, parts, held = [], [], [], 0
        if doc_ids:
            yield block()

    return blocks


def _row(schema: str, values: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64()), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[t]) for v, t in zip(values, types, strict=True)], list(names))


def _count_ids(kind: str, vocabulary: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), kind), minlength=vocabulary)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["token_id", "n"])

    return counted


def _pack_blocks(kind: str, rank_of: np.ndarray):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                control, data = pack(rank_of[np.frombuffer(batch.column("ids")[k].as_buffer(), kind)])
                place = batch.slice(k, 1).columns[:-1]
                yield pa.RecordBatch.from_arrays([*place, pa.array([control], pa.binary()), pa.array([data], pa.binary())], [*batch.schema.names[:-1], "control", "data"])

    return packed


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", shards: int | None = None) -> None:
    """Encode every text, append end_id, and write ranks and shards in ascending doc_id order to folder.

    One pass range-partitions and sorts the documents, encodes them and stages raw ids; ids are counted from there over
    the whole corpus (a vocabulary-sized array for each task, summed by a grouped aggregate), and a map over the staged
    blocks codes ranks. The rank table has one row for each id of the vocabulary at most, so the driver may hold it.
    Null texts are empty: they hold end_id alone. Rows with equal doc_id stay, in the order of their texts; null doc_ids
    come first. An empty table gives empty files.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    vocabulary = max(text_encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1)
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    n = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = rows.repartitionByRange(n, "d").sortWithinPartitions("d", "t")
    ordered.mapInArrow(_encode_blocks(tokenizer, kind, end_id), STAGED).write.option("compression", "zstd").parquet(f"{folder}/staged")
    staged = spark.read.schema(STAGED).parquet(f"{folder}/staged")
    counts = staged.select("ids").mapInArrow(_count_ids(kind, vocabulary), "token_id bigint, n bigint").groupBy("token_id").agg(F.sum("n").alias("n"))
    ranked = sorted(counts.collect(), key=lambda r: (-r.n, r.token_id))  # as many rows as the vocabulary has ids, at most
    rank_of = np.zeros(vocabulary, np.uint32)
    rank_of[[r.token_id for r in ranked]] = np.arange(len(ranked), dtype=np.uint32)
    spark.createDataFrame([(r.token_id, k) for k, r in enumerate(ranked)], "token_id bigint, rank bigint").coalesce(1).write.parquet(f"{folder}/ranks")
    staged.mapInArrow(_pack_blocks(kind, rank_of), SHARDS).write.option("compression", "zstd").parquet(f"{folder}/shards")
    remove(spark, f"{folder}/staged")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each document: doc_id, start (ids of all documents before it), n_tokens, ids binary (little-endian uint32)."""
    return _decoded(spark, folder, "ids binary", lambda ids: ids.tobytes(), pa.binary())


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """As read_token_files, with the unsigned crc32 of the ids' bytes in their stead."""
    return _decoded(spark, folder, "ids_crc32 bigint", lambda ids: zlib.crc32(ids.tobytes()), pa.int64())


def _decoded(spark: SparkSession, folder: str, column: str, value, kind: pa.DataType) -> DataFrame:
    ranks = spark.read.parquet(f"{folder}/ranks").collect()  # bounded by the vocabulary
    id_of = np.zeros(len(ranks) + 1, "<u4")
    id_of[[r["rank"] for r in ranks]] = [r.token_id for r in ranks]
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards")
    # a row for each shard, summed up over all shards: as few as the files' partitions, so they may be broadcast
    sizes = shards.select("shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    starts = sizes.selectExpr("shard", "coalesce(sum(n) over (order by shard rows between unbounded preceding and 1 preceding), 0) as shard_start")
    name = column.split()[0]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["n_tokens"], np.int64)
                ids = id_of[unpack(row["control"], row["data"], int(sizes.sum()))]
                ends = np.cumsum(sizes)
                values = [value(ids[e - s : e]) for s, e in zip(sizes, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - sizes), pa.array(sizes), pa.array(values, kind)], ["doc_id", "start", "n_tokens", name])

    placed = shards.join(F.broadcast(starts), "shard").withColumn("start", F.expr("shard_start + before"))
    return placed.select("doc_ids", "n_tokens", "control", "data", "start").mapInArrow(decoded, f"doc_id bigint, start bigint, n_tokens bigint, {column}")
