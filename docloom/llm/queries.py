"""The registered queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import collocations, divergence, embeddings, lm, secrets, substrings
from .decontamination import find_leaks
from .language import identify
from .packing import pack
from .quality import classify
from .shared import fresh_path, table
from .simhash import near_duplicates
from .token_counts import with_token_counts
from .token_files import read_checksums, write_token_files
from .tokenizing import tokenizer_path


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_counts(docs, tokenizer_path("byte_bpe_50k.json")).drop("text")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return read_checksums(spark, folder)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents"), window=20, digest=True)


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("all_spans")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_simhash_near_dedup, op3_token_counts, op4_benchmark_decontamination, op5_token_files, op6_language_id, op7_substring_dedup, op8_secret_scans, op9_embedding_near_dedup, op10_best_fit_packing, op11_source_divergence, op12_phrase_collocations, op13_lm_scoring)}
ORACLE_SQL: dict[str, str] = {"op8_secret_scans": secrets.oracle_sql(), "op11_source_divergence": divergence.oracle_sql(), "op12_phrase_collocations": collocations.oracle_sql()}
