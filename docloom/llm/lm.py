"""Language-model scores: Katz backoff with Good-Turing discounts.

An n-gram's key is a 64-bit hash. Chunks of documents send the distinct keys of each order, with their training counts, to
the partition that a key's leading bits name; partitions merge counts into tables, answer each chunk with the totals of its
keys, and name one chunk as the owner of each n-gram. Owners sum what their n-grams' contexts lose to discounts and what
these words have in the order below; merged by context these sums give backoff weights with which each context's
probabilities add up to one. A text is then scored token by token, from the longest order down to where its n-gram is known.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, discard

#: Tokens of a chunk, and keys of all chunks together for each table partition.
CHUNK_TOKENS, PARTITION_KEYS = 2_000_000, 4_000_000
#: Good-Turing gives what counts up to LARGE lose; larger ones lose what LARGE does.
LARGE = 5
_END, _SEED = b"", 42  # no word is empty
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BEGIN = np.uint64(0x51ED270B7F3A9C25)  # stands for the start of a text in contexts
CHUNKS = "chunk bigint, hashes binary, stream binary, lengths binary, doc_ids array<bigint>, held array<boolean>"
MERGED = "chunk bigint, level int, part bigint, keys binary, totals binary, found array<bigint>"


def words_of(text: bytes | None) -> list[bytes]:
    """Words at ASCII white space, A-Z lower-cased."""
    return (text or b"").lower().split()


def _pack(values: np.ndarray) -> bytes:
    """Compressed by planes of bytes, so that leading zeros cost nothing."""
    values = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    raw, size = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, "<u8"), dtype=np.uint64)


def _mixed(context: np.ndarray | np.uint64, word: np.ndarray) -> np.ndarray:
    x = (context + _MIX[0]) * _MIX[1] ^ word
    x = (x ^ x >> np.uint64(30)) * _MIX[1]
    x = (x ^ x >> np.uint64(27)) * _MIX[2]
    return x ^ x >> np.uint64(31)


def _chunked(room: int):
    """Chunks of whole documents (doc_id, held, text in UTF-8): hashes of their words, and the texts in numbers of them."""

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        known, parts, lengths, doc_ids, held = {}, [], [], [], []

        def row() -> pa.RecordBatch:
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, _SEED) for w in known), np.uint64, len(known))
            columns = [[number], [_pack(hashes)], [_pack(np.concatenate(parts))], [_pack(np.array(lengths, np.int64))], [doc_ids], [held]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in CHUNKS.split(", ")])

        total = 0
        for batch in batches:
            for doc_id, is_held, text in zip(*(batch.column(c) for c in ("doc_id", "held", "text")), strict=True):
                words = words_of(text.as_py())
                words.append(_END)
                for w in words:
                    if w not in known:
                        known[w] = len(known)
                parts.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
                lengths.append(len(words))
                doc_ids.append(doc_id.as_py())
                held.append(is_held.as_py())
                total += len(words)
                if total >= room:
                    yield row()
                    number, known, parts, lengths, doc_ids, held, total = number + 1, {}, [], [], [], [], 0
        if parts:
            yield row()

    return chunked


class _Texts:
    """A chunk's tokens with the keys of their n-grams and contexts, order by order."""

    def __init__(self, row):
        self.lengths = _unpack(row.lengths, "<i8")
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.held = np.asarray(row.held, bool)
        self.trained = np.repeat(~self.held, self.lengths)
        self.word = _unpack(row.hashes, "<u8")[_unpack(row.stream, "<u4")]

    def shifted(self, values: np.ndarray, at_start) -> np.ndarray:
        """What stands a token earlier in the same text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.starts] = at_start
        return out

    def orders(self, order: int) -> Iterator[tuple[int, np.ndarray | None, np.ndarray]]:
        """(level, contexts, keys) for each order from 1."""
        keys, begin = self.word, _BEGIN
        yield 1, None, keys
        for level in range(2, order + 1):
            contexts = self.shifted(keys, begin)
            keys = _mixed(contexts, self.word)
            yield level, contexts, keys
            begin = _mixed(np.full(1, begin), np.full(1, _BEGIN))[0]


def _slices(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(part, from, to) of sorted keys, by their leading bits."""
    parts = (keys >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(parts, prepend=-1))
    if len(keys):
        yield from zip(parts[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(keys)], strict=True)


def _asked(order: int, bits: int):
    """The distinct keys of a chunk with their training counts."""

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                texts = _Texts(row)
                for level, _, keys in texts.orders(order):
                    distinct, place = np.unique(keys, return_inverse=True)
                    n = np.bincount(place[texts.trained], minlength=len(distinct)).astype(np.uint32)
                    for part, a, b in _slices(distinct, bits):
                        yield pd.DataFrame({"level": [level], "part": [part], "chunk": [row.chunk], "keys": [_pack_keys(distinct[a:b])], "n": [_pack(n[a:b])]})

    return asked


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    """A table partition: its keys and counts, (chunk null), and the answer to each chunk: twice the total of each key, and one more where the chunk owns it.

    found: keys with a count, their counts' sum, and how many counts are 1, 2, ... LARGE + 1.
    """
    frame = frame.sort_values("chunk")
    keys = [_unpack_keys(k) for k in frame["keys"]]
    sizes = [len(k) for k in keys]
    n = np.concatenate([_unpack(x, "<u4") for x in frame["n"]]).astype(np.int64)
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    total = np.add.reduceat(n, first)
    group = np.repeat(np.arange(len(first)), np.diff(np.concatenate((first, [len(keys)]))))
    with_count = np.flatnonzero(n)
    owners = with_count[np.concatenate(([True], group[with_count][1:] != group[with_count][:-1]))] if len(with_count) else with_count
    answer = total[group] * 2
    answer[owners] += 1
    back = np.empty_like(answer)
    back[order] = answer
    has = total > 0
    found = [int(has.sum()), int(total.sum()), *np.bincount(np.minimum(total, LARGE + 2), minlength=LARGE + 3)[1 : LARGE + 2].tolist()]
    level, part = frame["level"].iloc[0], frame["part"].iloc[0]
    out = [(None, level, part, _pack_keys(keys[first][has]), _pack(total[has]), found)]
    for chunk, answers in zip(frame["chunk"], np.split(back, np.cumsum(sizes)[:-1]), strict=True):
        out.append((chunk, level, part, None, _pack(answers), None))
    return pd.DataFrame(out, columns=["chunk", "level", "part", "keys", "totals", "found"]).astype({"chunk": "Int64"})


class Discounts:
    """What counts of one order lose: r - (r + 1) n(r + 1) / n(r) up to LARGE, larger ones as much as LARGE.

    Where counts of counts don't allow that (a loss not between 0 and r), all lose n(1) / (n(1) + 2 n(2)), 0.9 at most,
    0.5 if no count is 1.
    """

    def __init__(self, found: list[int]):
        self.types, self.total, *often = found
        with np.errstate(divide="ignore", invalid="ignore"):
            r, n = np.arange(1, LARGE + 1), np.array(often, float)
            lost = r - (r + 1) * n[1:] / n[:-1]
        if not ((lost > 0) & (lost < r)).all():
            lost = np.full(LARGE, min(0.9, n[0] / (n[0] + 2 * n[1])) if n[0] else 0.5)
        self.lost = np.concatenate(([0.0], lost))
        counted = np.concatenate((n[:LARGE], [self.types - n[:LARGE].sum()]))
        #: The share of all that all counts lose together.
        self.unknown = float(counted @ np.concatenate((lost, lost[-1:]))) / self.total if self.total else 1.0

    def of(self, counts: np.ndarray) -> np.ndarray:
        return self.lost[np.minimum(counts, LARGE)]


def _weighed(order: int, bits: int, discounts: list[Discounts], n_texts: int):
    """Scores a chunk as far as its own answers go. Rows of kind `sum`: what contexts lose and give to the words seen after
    them, of owned n-grams; `ask`: contexts whose backoff weight is needed; `wait`: their place for each token that
    waits, and its text; `text`: one row with the results of all texts."""

    def weighed(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame(columns=WEIGHED_COLUMNS)
        row = next(left.itertuples(index=False))
        texts = _Texts(row)
        text_of = np.repeat(np.arange(len(texts.lengths)), texts.lengths)
        per_text = lambda x: np.add.reduceat(x, texts.starts)
        answers = {k: np.concatenate([_unpack(x, "<i8") for x in g.sort_values("part")["totals"]]) for k, g in right.groupby("level")}
        out, waits, before, highest = [], [], None, np.ones(len(text_of), np.int8)
        for level, contexts, keys in texts.orders(order):
            own = discounts[level - 1]
            _, first, place = np.unique(keys, return_index=True, return_inverse=True)
            n = answers[level][place] >> 1
            seen = n > 0
            if level == 1:
                p = np.where(seen, (n - own.of(n)) / max(1, own.total), own.unknown)
                base, known = per_text(np.log10((n + 1) / (own.total + own.types + 1))), per_text(seen.astype(np.int64))
            else:
                of_context = texts.shifted(before, n_texts)
                mine = first[(answers[level] & 1).astype(bool)]  # all in training texts, so known in every lower order
                by, at = np.unique(contexts[mine], return_inverse=True)
                lost, lower = np.bincount(at, own.of(n[mine]), len(by)), np.bincount(at, p[mine], len(by))
                out += [("sum", level, part, row.chunk, _pack_keys(by[a:b]), _pack(lost[a:b]), _pack(lower[a:b])) for part, a, b in _slices(by, bits)]
                wait = np.flatnonzero(~seen & (of_context > 0))
                waits.append((level, wait, contexts[wait], of_context[wait]))
                p[seen] = (n[seen] - own.of(n[seen])) / of_context[seen]
                highest[seen] = level
            before = n
        log_p = np.log10(p)
        for level, wait, contexts, of_context in waits:
            keep = highest[wait] < level  # the others are known in a higher order
            wait, contexts = wait[keep], contexts[keep]
            log_p[wait] -= np.log10(of_context[keep])
            need, at = np.unique(contexts, return_inverse=True)
            out += [("ask", level, part, row.chunk, _pack_keys(need[a:b])) for part, a, b in _slices(need, bits)]
            out.append(("wait", level, None, row.chunk, None, _pack(at.astype(np.int64)), _pack(text_of[wait])))
        out.append(("text", None, None, row.chunk, None, None, None, row.doc_ids, texts.held, texts.lengths, known, base, per_text(log_p)))
        return pd.DataFrame([r + (None,) * (len(WEIGHED_COLUMNS) - len(r)) for r in out], columns=WEIGHED_COLUMNS).astype({"level": "Int32", "part": "Int64"})

    return weighed


WEIGHED = (
    "kind string, level int, part bigint, chunk bigint, keys binary, lost binary, lower binary, doc_ids array<bigint>, held array<boolean>, "
    "n_tokens array<bigint>, n_known array<bigint>, base array<double>, score array<double>"
)
WEIGHED_COLUMNS = [c.split()[0] for c in WEIGHED.split(", ")]


def _weights(least: float):
    """A partition of backoff weights times the context's count (chunk null), and the answers to the chunks that ask."""

    def weights(frame: pd.DataFrame) -> pd.DataFrame:
        sums = frame[frame["kind"] == "sum"].sort_values("chunk")
        level, part = frame["level"].iloc[0], frame["part"].iloc[0]
        if len(sums):
            keys, at = np.unique(np.concatenate([_unpack_keys(k) for k in sums["keys"]]), return_inverse=True)
            lost, lower = (np.bincount(at, np.concatenate([_unpack(x, "<f8") for x in sums[c]]), len(keys)) for c in ("lost", "lower"))
            weight = lost / np.maximum(1 - lower, least if level == 2 else 1e-12)
        else:
            keys, weight = np.zeros(0, np.uint64), np.zeros(0)
        out = [(None, level, part, _pack_keys(keys), _pack(weight))]
        for row in frame[frame["kind"] == "ask"].itertuples(index=False):
            out.append((row.chunk, level, part, None, _pack(weight[np.searchsorted(keys, _unpack_keys(row.keys))])))
        return pd.DataFrame(out, columns=["chunk", "level", "part", "keys", "weights"]).astype({"chunk": "Int64"})

    return weights


RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _final(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The results of a chunk's texts, with the backoff weights that their tokens waited for."""
    texts = left[left["kind"] == "text"]
    if texts.empty:
        return pd.DataFrame(columns=[c.split()[0] for c in RESULT.split(", ")])
    row = next(texts.itertuples(index=False))
    score = np.array(row.score)
    answers = {k: np.concatenate([_unpack(x, "<f8") for x in g.sort_values("part")["weights"]]) for k, g in right.groupby("level")}
    for wait in left[left["kind"] == "wait"].sort_values("level").itertuples(index=False):
        at = _unpack(wait.lost, "<i8")
        if len(at):
            score += np.bincount(_unpack(wait.lower, "<i8"), np.log10(answers[wait.level][at]), len(score))
    return pd.DataFrame({"doc_id": pd.Series(list(row.doc_ids), dtype="Int64"), "held_out": row.held, "n_tokens": row.n_tokens, "n_known": row.n_known, "base_score": row.base, "score": score})


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id as text, modulo 7, is 2: rows that training never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = 2, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words (A-Z lower-cased, split at ASCII white space) and one end. The model of n-grams up to `order` is
    learned from all texts that aren't held out. A count r loses what Discounts says; a context gives what its words lose
    to the words not seen after it, in the proportions of the order below, so its probabilities add up to one. Below the
    words stands one unknown word with what all words lose, 1 without any training text. score is the log10 probability
    of all tokens; base_score that of single words with one added to each count. n_known tokens occur in training.

    Null and empty texts are the end alone; a null doc_id is a training row; repeated rows count each time; other columns
    are ignored; an empty table gives an empty result. Hashes of 64 bits tell words and n-grams apart. The tables of
    counts and backoff weights lie in the shared folder while the scores are made (see tables()).

    Chunks send each distinct n-gram once, hashes spread evenly over partitions, so frequent words make no large group.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held"), F.col(text).cast("binary").alias("text"))
    chunks, merged, discounts, n_texts, bits = tables(rows, order, chunk_tokens)
    answers = merged.where("chunk is not null").select(F.col("chunk").alias("of"), "level", "part", "totals")
    weighed = cut(chunks.groupBy("chunk").cogroup(answers.groupBy("of")).applyInPandas(_weighed(order, bits, discounts, n_texts), WEIGHED), "weighed")
    discard(chunks)
    weights = cut(
        weighed.where("kind in ('sum', 'ask')").select("kind", "level", "part", "chunk", "keys", "lost", "lower").groupBy("level", "part").applyInPandas(_weights(discounts[0].unknown), "chunk bigint, level int, part bigint, keys binary, weights binary"), "weights"
    )
    answers = weights.where("chunk is not null").select(F.col("chunk").alias("of"), "level", "part", "weights")
    ends = weighed.where("kind in ('text', 'wait')").drop("part", "keys")
    out = cut(ends.groupBy("chunk").cogroup(answers.groupBy("of")).applyInPandas(_final, RESULT), "scores")
    discard(merged, weighed, weights)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(discounts[0].total).cast("long").alias("train_tokens"), "base_score", "score")


def tables(rows: DataFrame, order: int, chunk_tokens: int = CHUNK_TOKENS) -> tuple[DataFrame, DataFrame, list[Discounts], int, int]:
    """(chunks, merged, discounts by order, training texts, leading bits that name a partition), learned from rows (doc_id,
    held, text in UTF-8). In merged, the rows without a chunk are the tables: keys and counts by level and part."""
    chunks = cut(rows.mapInArrow(_chunked(chunk_tokens), CHUNKS), "chunks")
    n_chunks, n_texts = chunks.agg(F.count("*"), F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()
    bits = max(4, (n_chunks * chunk_tokens // PARTITION_KEYS).bit_length())
    asked = chunks.mapInPandas(_asked(order, bits), "level int, part bigint, chunk bigint, keys binary, n binary")
    merged = cut(asked.groupBy("level", "part").applyInPandas(_merged, MERGED), "tables")
    sums = [F.coalesce(F.sum(F.col("found")[k]), F.lit(0)).alias(f"f{k}") for k in range(LARGE + 3)]
    found = {r[0]: list(r[1:]) for r in merged.where("chunk is null").groupBy("level").agg(*sums).collect()}
    return chunks, merged, [Discounts(found.get(k, [0] * (LARGE + 3))) for k in range(1, order + 1)], n_texts, bits
