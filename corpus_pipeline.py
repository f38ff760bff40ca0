"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's documents.

Every stage but the last returns the columns of documents. quality drops what the classifier rejects; near_dedup keeps
one document of each group that a similarity of 0.8 over five-word shingles links; decontaminate drops documents that hold
a benchmark passage; secrets masks every secret in the texts (n_chars follows) and drops none; pack cuts what is left into
pieces and lays them into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import decontamination, packing, quality, secrets, simhash
from docloom.llm.shared import cut, table
from docloom.llm.tokenizing import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_similar(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("secrets", mask_secrets),
    ("pack", pack_sequences),
]

#: A trained model, tokenizers and reachability have no DuckDB form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
