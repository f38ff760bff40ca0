"""Texts to chunks of bounded token counts, sections first."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: a numbered bold line opens a section.
SECTION = re.compile(r"^\*\*(\d+(?:\.\d+)*\.?)\s+([A-Z0-9][^\n*]+?)\s*\*\*[ \t]*$", re.M)
_END = re.compile(r"(?<=[.!?])\s+")
CHUNKS = "chunk_no int, section string, title string, text string, n_tokens int, chunk_hash string"


def sections(text: str) -> list[tuple[str, str, str]]:
    """(number, title, content) of the numbered bold sections; text before the first is dropped; none: one without a title."""
    found = list(SECTION.finditer(text))
    if not found:
        return [("", "", text)]
    ends = [m.start() for m in found[1:]] + [len(text)]
    return [(m[1], m[2], text[m.end() : e].strip("\n")) for m, e in zip(found, ends, strict=True)]


def packed(content: str, most: int) -> Iterator[tuple[str, int]]:
    """Sentences put together up to `most` tokens, four characters each; a longer sentence is split at its spaces."""
    held, size = "", 0
    for sentence in filter(None, (s.strip() for s in _END.split(content))):
        n = len(sentence) // 4
        if n > most:
            if held:
                yield held, size
            held, size = "", 0
            for word in sentence.split(" "):
                m = (len(word) + 1) // 4
                if held and size + m > most:
                    yield held, size
                    held, size = "", 0
                held, size = f"{held}{word} ", size + m
            yield held, size
            held, size = "", 0
        else:
            if held and size + n > most:
                yield held, size
                held, size = "", 0
            held, size = f"{held} {sentence}" if held else sentence, size + n
    if held:
        yield held, size


def chunk(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 500) -> DataFrame:
    """Chunks of every document, in order: doc_id and CHUNKS. Null and blank texts have none."""
    kind = dict(docs.dtypes)[doc_id]

    def chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [doc_id, *(c.split()[0] for c in CHUNKS.split(", "))]
        for f in frames:
            rows = []
            for d, t in f.itertuples(index=False):
                k = 0
                for number, title, content in sections(t or ""):
                    for body, n in packed(content, most):
                        rows.append((d, k, number, title, body, n, hashlib.sha256(body.encode()).hexdigest()[:16]))
                        k += 1
            yield pd.DataFrame(rows, columns=names)

    return docs.select(F.col(doc_id), F.col(text)).mapInPandas(chunks, f"{doc_id} {kind}, {CHUNKS}")
