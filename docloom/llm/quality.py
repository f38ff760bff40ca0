"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import begin, cut

FEATURES = (
    "log_words chars_per_word upper lower digits high_bytes marks odd_marks bang hash dollar percent ampersand star pipe braces at_signs "
    "line_words lines_per_word repeated_lines top_line distinct_words top_word shouted_words marked_words short_words long_words "
    "capitalised end_marks repeated_bigrams"
).split()
_UPPER, _LOWER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_ODD = _MARK.copy()
_ODD[list(b".,;:'\"!?()-")] = False


def statistics(text: str | None) -> list[float]:
    """The features of one text; all zero without words."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "replace")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, n = len(raw), len(words)
    share = lambda chars: float(count[chars].sum()) / size
    of = lambda char: float(count[ord(char)]) / n
    lines = Counter(x for x in (x.strip() for x in text.split("\n")) if x)
    n_lines = max(1, sum(lines.values()))
    seen = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    shouted = sum(k for w, k in seen.items() if len(w) > 2 and w.isupper())
    marked = sum(k for w, k in seen.items() if not w[-1].isalnum() and w[-1] not in ".,;:!?)\"'")
    capital = sum(k for w, k in seen.items() if w[0].isupper())
    ended = sum(k for w, k in seen.items() if w[-1] in ".!?")
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        float(np.log1p(n)), float(lengths.mean()), share(_UPPER), share(_LOWER), share(_DIGIT), float(count[128:].sum()) / size, share(_MARK), share(_ODD),
        of("!"), of("#"), of("$"), of("%"), of("&"), of("*"), of("|"), of("{") + of("}") + of("<") + of(">"), of("@"),
        n / n_lines, n_lines / n, 1 - len(lines) / n_lines, max(lines.values(), default=0) / n_lines, len(seen) / n, max(seen.values()) / n, shouted / n, marked / n,
        float((lengths <= 2).mean()), float((lengths >= 12).mean()), capital / n, ended / n, 1 - pairs / (n - 1) if n > 1 else 0.0,
    ]


@dataclass
class Trees:
    """Complete trees of one depth, flattened: node k of a tree has children 2k + 1 and 2k + 2; leaves follow the nodes."""

    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray  # trees x nodes
    leaf: np.ndarray  # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row: all rows step down all trees together."""
        out = np.full(len(x), self.base)
        nodes = self.feature.shape[1]
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            rows, trees = np.arange(len(part))[:, None], np.arange(len(self.feature))[None, :]
            node = np.zeros((len(part), len(self.feature)), np.int64)
            for _ in range((nodes + 1).bit_length() - 1):
                node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.threshold[trees, node])
            out[at : at + 4096] += self.leaf[trees, node - nodes].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, min_rows: int = 8) -> Trees:
    """Gradient boosting of the logistic loss on binned features; each level's histograms are two bincounts."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    nodes, leaves = (1 << depth) - 1, 1 << depth
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    feature, threshold, leaf = np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf), np.zeros((trees, leaves))
    raw, columns = np.full(n, base), np.arange(width)
    usable = np.stack([np.arange(bins) < len(c) for c in cuts])
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            slot = (((node - first)[:, None] * width + columns) * bins + binned).ravel()
            shape, size = (many, width, bins), many * width * bins
            left = [np.bincount(slot, np.repeat(w, width), size).reshape(shape).cumsum(axis=2) for w in (g, h, np.ones(n))]
            total = [s[:, :, -1:] for s in left]
            gain = sum(gs**2 / (hs + ridge) for gs, hs in ((left[0], left[1]), (total[0] - left[0], total[1] - left[1]))) - total[0] ** 2 / (total[1] + ridge)
            gain[(left[2] < min_rows) | (total[2] - left[2] < min_rows) | ~usable[None]] = -np.inf
            best = gain.reshape(many, -1).argmax(axis=1)
            value = gain.reshape(many, -1)[np.arange(many), best]
            for k in np.flatnonzero(value > 1e-9):
                j, b = divmod(int(best[k]), bins)
                feature[t, first + k], threshold[t, first + k] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        place = node - nodes
        leaf[t] = -rate * np.bincount(place, g, leaves) / (np.bincount(place, h, leaves) + ridge)
        raw += leaf[t, place]
    return Trees(feature, threshold, leaf, base)


def with_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x): x holds the FEATURES of the whole text."""

    @F.pandas_udf("array<float>")
    def measured(texts: pd.Series) -> pd.Series:
        return texts.map(statistics, na_action=None)

    return docs.select(F.col(doc_id).alias("doc_id"), measured(F.col(text)).alias("x"))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the doc_id as text, modulo 5, is 0: rows that training never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(measured: DataFrame, labels: DataFrame, max_rows: int = 20_000, **options) -> Trees | None:
    """Fit on at most max_rows labelled rows that aren't held out, taken by the least hash of doc_id; None without any.

    max_rows bounds what reaches the driver: max_rows times len(FEATURES) floats. Rows with a null doc_id or quality are
    not learned from.
    """
    known = labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
    sample = measured.join(known, "doc_id").where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_rows).select("x", "y").toPandas()
    if sample.empty:
        return None
    return fit(np.array(sample["x"].tolist(), np.float32).astype(float), sample["y"].to_numpy(float), **options)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3, max_rows: int = 20_000) -> DataFrame:
    """One row for each document: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    Statistics of every whole text are taken once and written; labels never enter a score. Null and empty texts have
    all-zero statistics and are scored like any other. Repeated rows stay; a null doc_id is kept, not held out. With no
    usable label every score is 0.5. An empty table gives an empty result.
    """
    measured = cut(with_statistics(docs, doc_id, text), "statistics")
    trees = train(measured, labels, max_rows)

    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        if trees is None or not len(x):
            return pd.Series(np.full(len(x), 0.5))
        return pd.Series(trees.score(np.array(x.tolist(), np.float32).astype(float)))

    out = measured.select("doc_id", held_out().alias("held_out"), scored("x").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def train_on(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", max_rows: int = 20_000) -> Trees | None:
    """train(), with statistics of the sampled documents alone; ids are matched before texts are read."""
    ids = docs.select(F.col(doc_id).alias("doc_id")).distinct()
    sample = labels.where("quality in (0, 1)").select("doc_id").where(~held_out()).distinct().join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id", "left_semi")  # max_rows ids at most
    return train(with_statistics(chosen), labels, max_rows)


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3, max_rows: int = 20_000) -> DataFrame:
    """The rows of docs, all columns, whose score is at least threshold; no shuffle of texts. Without a usable label all stay."""
    trees = train_on(docs, labels, doc_id, text, max_rows)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        begin("quality")
        if trees is None or not len(texts):
            return pd.Series(np.full(len(texts), 0.5))
        return pd.Series(trees.score(np.array([statistics(t) for t in texts], np.float32).astype(float)))

    return docs.where(scored(F.col(text)) >= threshold)


def is_held_out(doc_id) -> bool:
    """held_out() for one value, for tests."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
