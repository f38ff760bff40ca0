"""Scores of converted documents against references, and of methods against each other."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inversions(values: np.ndarray) -> int:
    """Pairs whose first value is the greater, counted while merging sorted halves."""

    def counted(v: np.ndarray) -> tuple[np.ndarray, int]:
        if len(v) < 2:
            return v, 0
        (left, a), (right, b) = counted(v[: len(v) // 2]), counted(v[len(v) // 2 :])
        across = len(left) * len(right) - int(np.searchsorted(left, right, side="right").sum())
        return np.sort(v, kind="stable"), a + b + across

    return counted(values)[1]


def _balance(values) -> int:
    """Pairs in order less pairs out of order; equal values are neither."""
    v = np.asarray(values, np.int64)
    same = np.unique(v, return_counts=True)[1]
    return len(v) * (len(v) - 1) // 2 - int((same * (same - 1) // 2).sum()) - 2 * inversions(v)


def order_score(ranks: DataFrame, doc: list[str], truth: str = "truth", found: str = "found") -> DataFrame:
    """(doc, order_score): (Kendall's tau + 1) / 2 * 100 of two orders of a document's parts; 100 for one part or none.

    A document's parts, which are its blocks, are gathered in order and their inversions counted by merging.
    """
    each = ranks.groupBy(*doc).agg(F.transform(F.array_sort(F.collect_list(F.struct(truth, found))), lambda r: r[found].cast("long")).alias("f"))
    n = F.size("f")

    @F.pandas_udf("bigint")
    def balance(orders: pd.Series) -> pd.Series:
        return orders.map(_balance).astype("int64")

    return each.select(*doc, F.when(n <= 1, 100.0).otherwise((balance("f") / (n * (n - 1) / 2) + 1) / 2 * 100).alias("order_score"))


def document_score(parts: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, score): 0.8 of the parts' scores weighted by length and 0.2 of the order score. parts: doc, length, score, order_score."""
    weighted = F.sum(F.col("length") * F.col("score")) / F.greatest(F.sum("length"), F.lit(1))
    return parts.groupBy(*doc).agg((0.8 * weighted + 0.2 * F.max("order_score")).alias("score"))


def win_rates(votes: DataFrame) -> DataFrame:
    """(method_a, method_b, n, a_wins, a_percent) over votes (method_a, method_b, winner), each pair in one order."""
    swap = F.col("method_a") > F.col("method_b")
    v = votes.select(F.when(swap, F.col("method_b")).otherwise(F.col("method_a")).alias("method_a"), F.when(swap, F.col("method_a")).otherwise(F.col("method_b")).alias("method_b"), "winner")
    wins = F.count_if(F.col("winner") == F.col("method_a"))
    return v.groupBy("method_a", "method_b").agg(F.count("*").alias("n"), wins.alias("a_wins"), (100 * wins / F.count("*")).alias("a_percent"))


def score_rollup(scores: DataFrame) -> DataFrame:
    """Mean scores by method, by method and document type, and by method and block type, in one pass."""
    return scores.groupingSets([["method"], ["method", "doc_type"], ["method", "block_type"]], "method", "doc_type", "block_type").agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"))


def feature_times(steps: DataFrame, run: list[str]) -> DataFrame:
    """(run columns, feature, seconds): what each feature took in a run, from steps with feature and seconds. A null time counts nothing."""
    return steps.groupBy(*run, "feature").agg(F.round(F.coalesce(F.sum("seconds"), F.lit(0.0)), 1).alias("seconds"))


def run_performance(steps: DataFrame, run: list[str]) -> DataFrame:
    """One row for each run: total_seconds, n_analyses, n_successful, n_fallbacks and average_seconds, the total over its
    analyses (0 without any). steps: run columns, seconds and the flags is_analysis, is_successful and is_fallback."""
    total, n = F.coalesce(F.sum("seconds"), F.lit(0.0)), F.count_if(F.col("is_analysis"))
    good = F.count_if(F.col("is_analysis") & F.col("is_successful"))
    average = F.when(n > 0, total / n).otherwise(F.lit(0.0))
    return steps.groupBy(*run).agg(F.round(total, 1).alias("total_seconds"), n.alias("n_analyses"), good.alias("n_successful"), F.count_if(F.col("is_fallback")).alias("n_fallbacks"), F.round(average, 1).alias("average_seconds"))
