"""Similarity of table trees: one less the tree edit distance over the larger tree's size [Zhang and Shasha 1989]."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .similarity import indel_ratio


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__()
        self.root = ("", [], [])
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        spans = tuple(sorted((k, v) for k, v in attrs if k in ("rowspan", "colspan")))
        node = ((tag, spans), [], [])
        self.open[-1][1].append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        while len(self.open) > 1:
            if self.open.pop()[0][0] == tag:
                break

    def handle_data(self, data):
        self.open[-1][2].append(data.strip())


def _flat(html: str) -> tuple[list, list[int]]:
    """Labels in postorder and, for each node, its leftmost leaf."""
    tree = _Tree()
    tree.feed(html or "")
    labels, leftmost = [], []

    def visit(node) -> int:
        first = None
        for child in node[1]:
            leaf = visit(child)
            first = leaf if first is None else first
        labels.append((node[0], " ".join(filter(None, node[2]))))
        leftmost.append(len(labels) - 1 if first is None else first)
        return leftmost[-1]

    visit(tree.root)
    return labels, leftmost


def _change(a, b) -> float:
    if a[0] != b[0]:
        return 1.0
    return 1 - indel_ratio(a[1], b[1]) / 100 if a[1] or b[1] else 0.0


def tree_similarity(a: str | None, b: str | None) -> float:
    """1 for equal tables, 0 for nothing in common."""
    (x, lx), (y, ly) = _flat(a or ""), _flat(b or "")
    roots = lambda leftmost: sorted({leaf: i for i, leaf in enumerate(leftmost)}.values())
    whole = [[0.0] * len(y) for _ in x]
    for i in roots(lx):
        for j in roots(ly):
            p, q = lx[i], ly[j]
            d = [[0.0] * (j - q + 2) for _ in range(i - p + 2)]
            for u in range(1, i - p + 2):
                d[u][0] = d[u - 1][0] + 1
            for v in range(1, j - q + 2):
                d[0][v] = d[0][v - 1] + 1
            for u in range(1, i - p + 2):
                for v in range(1, j - q + 2):
                    s, t = p + u - 1, q + v - 1
                    least = min(d[u - 1][v], d[u][v - 1]) + 1
                    if lx[s] == p and ly[t] == q:
                        d[u][v] = whole[s][t] = min(least, d[u - 1][v - 1] + _change(x[s], y[t]))
                    else:
                        d[u][v] = min(least, d[lx[s] - p][ly[t] - q] + whole[s][t])
    return 1 - whole[-1][-1] / max(len(x), len(y))


def table_similarity(a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def measured(p: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series([tree_similarity(x, y) for x, y in zip(p, q, strict=True)], dtype="float64")

    return measured(a, b)
