"""An inverted index over English stems, and searches of it."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.stems import porter

_WORD = re.compile(rb"[a-z]+").findall
#: Stems that a task keeps, the longest word it keeps one for, and words that it folds at once, or those of one longer document.
_KNOWN, _LONGEST, _WORDS = 200_000, 40, 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokens(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, pos, word): the words of a text, runs of A-Z and a-z in lower case, numbered from 0."""
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), F.lit("[a-z]+"), 0)
    return rows.select(key, F.posexplode(words).alias("pos", "word"))


def _folded(kind: pa.DataType):
    """(key, text) in order of key to (key, stem, at): each key's stems once, with their places in all of its texts, in order."""

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, str] = {}

        def stem_of(word: bytes) -> str:
            stem = known.get(word)
            if stem is None:
                stem = porter(word.decode())
                if len(known) < _KNOWN and len(word) <= _LONGEST:
                    known[word] = stem
            return stem

        def postings_of(keys: list, of: list[int], sizes: list[int], words: list[bytes]) -> pa.RecordBatch:
            coded = pa.array(words, pa.binary()).dictionary_encode()
            stems = pa.array([stem_of(w) for w in coded.dictionary.to_pylist()], pa.string()).dictionary_encode()
            stem = stems.indices.to_numpy().astype(np.int64)[coded.indices.to_numpy()]
            n = np.array(sizes, np.int64)
            at = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n)
            group = np.repeat(np.array(of, np.int64), n) * max(1, len(stems.dictionary)) + stem
            order = np.lexsort((at, group))
            group = group[order]
            first = np.flatnonzero(np.diff(group, prepend=-1))
            doc, stem = np.divmod(group[first], max(1, len(stems.dictionary)))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(words)), pa.int32()), pa.array(at[order], pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(keys, kind).take(pa.array(doc)), stems.dictionary.take(pa.array(stem)), lists], ["key", "stem", "at"])

        keys, of, sizes, words = [], [], [], []
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if not keys or key != keys[-1]:
                    if len(words) >= _WORDS:
                        yield postings_of(keys, of, sizes, words)
                        keys, of, sizes, words = [], [], [], []
                    keys.append(key)
                found = _WORD((text or b"").lower())  # of bytes, so that only A to Z change
                of.append(len(keys) - 1)
                sizes.append(len(found))
                words += found
        yield postings_of(keys, of, sizes, words)

    return folded


def _stemmed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, stem, positions): where a document has a stem, in order. Whole texts, not their words, are dealt by key and folded some documents
    at a time; a word that a task still knows is not stemmed again."""
    whole = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).repartition("key").sortWithinPartitions("key")
    kind = whole.schema["key"].dataType
    return whole.mapInArrow(_folded(to_arrow_type(kind)), f"key {kind.simpleString()}, stem string, at array<int>").select(F.col("key").alias(key), "stem", F.col("at").alias("positions"))


def postings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(stem, key, positions): where a document has a stem, in order."""
    return _stemmed(docs, key, text).select("stem", key, "positions")


def write_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", parts: int = 64) -> None:
    """The postings as Parquet under path, in folders by a hash of the stem and sorted by stem within, so that a search reads the
    folders of its own stems, and of those the pages that hold them."""
    spread = _stemmed(docs, key, text).withColumns({"part": F.pmod(F.xxhash64("stem"), F.lit(parts)), "_of": F.pmod(F.xxhash64(key), F.lit(8))})
    spread = spread.repartition("part", "_of").select("part", "stem", key, "positions")
    spread.sortWithinPartitions("part", "stem", key).write.mode("overwrite").partitionBy("part").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def search(index: DataFrame, queries: DataFrame, key: str = "doc_id", query: str = "query_id", text: str = "text") -> DataFrame:
    """(query, key, n_hits, phrase): documents that have every stem of a query, how often they have them all together, and whether
    the query's stems stand there one after another.

    Each query begins at its rarest stem: only documents that have it are looked up for the others, so common stems
    aren't joined with all their documents. Queries without a word find nothing.
    """
    wanted = _stemmed(queries, query, text).withColumnRenamed("positions", "places")
    hits = index.join(wanted.select("stem").distinct(), "stem", "left_semi")
    often = hits.groupBy("stem").agg(F.count("*").alias("n_docs"))
    known = wanted.join(often, "stem", "left").withColumn("n_docs", F.coalesce("n_docs", F.lit(0)))
    rarest = known.groupBy(query).agg(F.min(F.struct("n_docs", "stem"))["stem"].alias("stem"), F.count("*").alias("n_stems"), F.sum(F.size("places")).alias("length"))
    opened = rarest.join(hits.select("stem", key), "stem").select(query, key, "n_stems", "length")
    found = opened.join(wanted, query).join(hits, ["stem", key])
    each = found.groupBy(query, key, "n_stems", "length").agg(F.count("*").alias("_n"), F.sum(F.size("positions")).cast("bigint").alias("n_hits"), F.collect_list(F.struct("places", "positions")).alias("_p")).where("_n = n_stems")
    # a phrase begins where each place of the query, taken off a position of its stem, comes out the same
    begins = F.flatten(F.transform("_p", lambda p: F.transform(p["places"], lambda q: F.transform(p["positions"], lambda x: x - q))))
    return each.withColumn("_b", begins).select(query, key, "n_hits", (F.size(F.aggregate("_b", F.col("_b")[0], lambda s, b: F.array_intersect(s, b))) > 0).alias("phrase"))
