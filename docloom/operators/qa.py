"""Question and answer sets: pairing, context, sampling, validation and report."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import sequence_ratio
from ..functions.text import term_overlap


def pairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, turn, question, answer): a user's turn and the assistant's that follows it."""
    w = Window.partitionBy(conv).orderBy(turn)
    t = turns.select(conv, turn, "role", F.col("text").alias("question"), F.lead("role").over(w).alias("_r"), F.lead("text").over(w).alias("answer"))
    return t.where("role = 'user' and _r = 'assistant'").select(conv, turn, "question", "answer")


def contexts(blocks: DataFrame, doc: list[str], order: str = "block_ord", least: int = 100) -> DataFrame:
    """One row for each section whose text reaches `least` characters: the text up to the block with which it does.

    blocks: document columns, order, block_type, text, parent_ord. Blocks of under ten characters are passed over. Only
    the blocks that go in are gathered: their place is told by a running length.
    """
    t = blocks.where((F.col("block_type") == "Text") & (F.length(F.trim("text")) >= 10) & F.col("parent_ord").isNotNull())
    w = Window.partitionBy(*doc, "parent_ord").orderBy(order)
    t = t.withColumn("_n", F.sum(F.length("text")).over(w.rowsBetween(Window.unboundedPreceding, 0)) + 2 * (F.row_number().over(w) - 1))
    t = t.withColumn("_before", F.coalesce(F.lag("_n").over(w), F.lit(0))).where(F.col("_before") < least)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("text").alias("t")))), lambda x: x["t"]), "\n\n")
    whole = t.groupBy(*doc, "parent_ord").agg(text.alias("context"), F.max("_n").alias("_n"))
    return whole.where(F.col("_n") >= least).select(*doc, "parent_ord", "context")


def question(kind: Column, title: Column, context: Column) -> Column:
    """(question, answer) by template; the answer is the context's first hundred characters."""
    text = F.when(kind == "factual", F.format_string("What does the section on %s say?", title)).when(kind == "conceptual", F.format_string("Explain the main idea of %s.", title)).otherwise(F.format_string("How does %s relate to the document?", title))
    return F.struct(text.alias("question"), F.substring(context, 1, 100).alias("answer"))


def sample(candidates: DataFrame, shares: dict[str, float], most: int, seed: int = 0, key: str = "section_hash") -> DataFrame:
    """At most int(most * share) candidates of each kind, the rest to the first kind, no key twice, by a seeded hash order."""
    wanted = {k: int(most * s) for k, s in shares.items()}
    first = next(iter(shares))
    wanted[first] += most - sum(wanted.values())
    once = candidates.withColumn("_h", F.xxhash64(F.lit(seed), key, "kind"))
    once = once.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy("_h"))).where("_k = 1")
    # a top-n of each kind with its own literal limit, which each task applies before anything is gathered
    kinds = [once.where(F.col("kind") == k).orderBy("_h", key).limit(n) for k, n in wanted.items()]
    return reduce(DataFrame.unionByName, kinds).drop("_h", "_k")


def diversity(questions: DataFrame, group: list[str], key: str, threshold: float = 0.8, block: int = 400) -> DataFrame:
    """(group, key, most_similar, diverse): the greatest sequence ratio of a question to another of its group.

    A group's distinct questions are dealt to blocks of `block` by length, and every two blocks of a group meet in one
    task, so no task holds a group. There each question is held against the others from the likeliest on: what two texts
    share of each character bounds their ratio, and those that can't pass the best so far aren't compared. Repeated
    questions have a ratio of 1 and are compared with others once. Null questions count as empty.
    """
    whole = questions.withColumn("_q", F.coalesce("question", F.lit("")))
    texts = whole.groupBy(*group, "_q").agg(F.count("*").alias("_n"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.length("_q"), "_q")) - 1
    dealt = texts.select(*group, "_q", F.floor(place / block).cast("int").alias("_b"))
    last = dealt.groupBy(*group).agg(F.max("_b").alias("_last"))
    dealt = dealt.join(last, group).withColumn("_e", F.explode(F.transform(F.sequence(F.lit(0), "_last"), lambda k: F.struct(F.least("_b", k).alias("i"), F.greatest("_b", k).alias("j")))))

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        texts, blocks = rows["_q"].tolist(), rows["_b"].to_numpy()
        counts = np.zeros((len(texts), 128), np.int16)
        for i, t in enumerate(texts):
            counts[i] = np.bincount(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") % 128, minlength=128)
        sizes, best, one_block = np.array([len(t) for t in texts]), np.zeros(len(texts)), len(set(blocks)) == 1
        for i, text in enumerate(texts):
            bound = 2.0 * np.minimum(counts, counts[i]).sum(axis=1, dtype=np.int64) / np.maximum(1, sizes + sizes[i])
            bound[i] = -1
            if not one_block:
                bound[blocks == blocks[i]] = -1
            for j in np.argsort(-bound, kind="stable"):
                if bound[j] <= best[i]:
                    break
                best[i] = max(best[i], sequence_ratio(text, texts[j]))
        return rows[[*group, "_q"]].assign(_best=best)

    kinds = dict(questions.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in group), "_q string", "_best double"])
    found = dealt.groupBy(*group, "_e.i", "_e.j").applyInPandas(compared, schema).groupBy(*group, "_q").agg(F.max("_best").alias("_best"))
    top = texts.join(found, [*group, "_q"]).select(*group, "_q", F.when(F.col("_n") > 1, 1.0).otherwise(F.col("_best")).alias("most_similar"))
    return whole.join(top, [*group, "_q"]).select(*group, key, "most_similar", (1.0 - F.col("most_similar") >= 1.0 - threshold).alias("diverse"))


def relevance(context_similarity: Column, question_overlap: Column, answer_overlap: Column, threshold: float = 0.7) -> Column:
    """(score, passed): context similarity counts where it is 0.6 or more."""
    score = F.when(context_similarity >= 0.6, 0.4 * context_similarity).otherwise(0.0) + 0.3 * question_overlap + 0.3 * answer_overlap
    return F.struct(score.alias("score"), (score >= threshold).alias("passed"))


def report(checks: DataFrame) -> DataFrame:
    """checks (check, score, passed) to (check, n, n_passed, mean_score, passed_percent), with a total row."""
    return checks.groupingSets([["check"], []], "check").agg(F.count("*").alias("n"), F.count_if("passed").alias("n_passed"), F.avg("score").alias("mean_score"), (100 * F.count_if("passed") / F.count("*")).alias("passed_percent"))


def to_instructions(pairs_: DataFrame, metadata: list[str]) -> DataFrame:
    """Rows of the instruction format: instruction, an empty input, output, metadata."""
    return pairs_.select(F.col("question").alias("instruction"), F.lit("").alias("input"), F.col("answer").alias("output"), F.struct(*metadata).alias("metadata"))


def accuracy(answer: Column, context: Column, kind: Column, sequence: Column, corpus: Column | None = None, blocks: Column | None = None, threshold: float = 0.6) -> Column:
    """(score, passed): how far the answer's words are found in its context, by overlap of terms and the sequence ratio.

    Code with few shared terms but a like sequence, and tables with some shared terms, are met half-way. A corpus that
    holds more of the answer counts for 0.3, then each block (array of texts, in order) that holds more for 0.4. An
    empty or null answer or context scores 0 and fails.
    """
    shared = term_overlap(answer, context)
    shared = (
        F.when((kind == "code") & (shared < 0.5) & (sequence > 0.4), F.least(shared + 0.3, F.lit(1.0))).when((kind == "table") & (shared >= 0.4), F.least(shared + 0.2, F.lit(1.0)))
        .otherwise(shared)
    )
    lifted = lambda own, other, part: F.when(other > own, (1 - part) * own + part * other).otherwise(own)
    if corpus is not None:
        shared = lifted(shared, term_overlap(answer, corpus), 0.3)
    if blocks is not None:
        overlaps = F.transform(F.filter(blocks, lambda b: b.isNotNull() & (b != "")), lambda b: term_overlap(answer, b))
        shared = F.coalesce(F.aggregate(overlaps, shared.cast("double"), lambda own, o: lifted(own, o, 0.4)), shared)
    given = (F.coalesce(answer, F.lit("")) != "") & (F.coalesce(context, F.lit("")) != "")
    score = F.when(given, 0.6 * shared + 0.2 + 0.2 * sequence).otherwise(0.0)
    return F.struct(score.alias("score"), (given & (score >= threshold)).alias("passed"))
