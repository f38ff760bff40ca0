"""Exact substring deduplication over word windows, by fixed-block anchors.

A window of W words covers, at any alignment, one whole block of W // 2 words that starts at a multiple of W // 2 in its
document. So the blocks of each document, which don't overlap, are the index, every rolling run of that length is a
probe, and each repeated window has a hit. Hits are then extended: the windows around them are compared by their own
hashes, the earliest place of each is found, and covered words add up to maximal repeats.

Documents are dealt by hash into groups of a few hundred, which stay together: they are written once, bucketed by group,
so later passes read them where they are and no text is shuffled. What goes over the network are packed, sorted hashes,
one of each for a group at most; a passage that many documents share therefore costs one entry a group, not one a copy.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut

GROUP_DOCS = 256
_NULL = -(1 << 63)  # stands for a null doc_id, which thereby comes first
_BASE = {"a": 0x9E3779B97F4A7C15, "b": 0xC2B2AE3D27D4EB4F}
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Codes(dict):
    """word -> 64-bit code; bounded, and the same on every worker."""

    room = 300_000

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(word)
        if len(self) < self.room and len(word) <= 64:
            self[word] = code
        return code


_CODES = _Codes()


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n - 1, modulo 2 ** 64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
    return out


def rolling(codes: np.ndarray, size: int, which: str) -> np.ndarray:
    """A hash of each run of `size` codes, in the order of their starts."""
    n = len(codes)
    if n < size:
        return np.empty(0, np.uint64)
    base = _BASE[which]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * _powers(base, n), dtype=np.uint64)))
    out = (sums[size:] - sums[:-size]) * _powers(pow(base, -1, 1 << 64), n - size + 1)
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(29))


class _Group:
    """The documents of one group that aren't copies of an earlier one, as one sequence of words."""

    def __init__(self, docs: pd.DataFrame, notes: pd.DataFrame, window: int):
        copies = notes[notes["h"].notna()]
        known = set(zip(copies["d"].tolist(), copies["h"].tolist(), strict=True))
        self.window, self.block = window, window // 2
        self.doc_ids = docs["d"].tolist()
        self.words = [t.encode().split() for t in docs["t"]]
        self.copy = [(d, h) in known for d, h in zip(self.doc_ids, docs["h"], strict=True)]
        own = [[] if c else w for w, c in zip(self.words, self.copy, strict=True)]
        sizes = np.array([len(w) for w in own], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.codes = np.fromiter((_CODES[w] for words in own for w in words), np.uint64, int(sizes.sum()))
        self.doc_of = np.repeat(np.arange(len(own)), sizes)

    def inside(self, size: int) -> np.ndarray:
        """Whether a run of `size` words from each place stays in its document."""
        n = max(0, len(self.codes) - size + 1)
        return np.arange(n) + size <= self.ends[self.doc_of[:n]]

    def repeated(self) -> np.ndarray:
        """Whether the run of a block's length at each place is a block of this group, and stands in two places of it."""
        runs, at = rolling(self.codes, self.block, "a"), np.flatnonzero(self.inside(self.block))
        keys, first, counts = np.unique(runs[at], return_inverse=True, return_counts=True)
        anchor = np.zeros(len(keys), bool)
        anchor[first[(at - self.starts[self.doc_of[at]]) % self.block == 0]] = True
        hit = np.zeros(len(runs), bool)
        hit[at] = (anchor & (counts > 1))[first]
        return hit

    def around(self, hit: np.ndarray) -> np.ndarray:
        """Starts of the windows that have a hit at one of the places 0 .. window - block after their start."""
        n = len(self.codes) - self.window + 1
        if n < 1:
            return np.empty(0, np.int64)
        many = np.concatenate(([0], np.cumsum(hit)))
        last = np.arange(n) + (self.window - self.block) + 1
        return np.flatnonzero((many[np.minimum(last, len(hit))] > many[:n]) & self.inside(self.window))

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """doc_id and start of the places."""
        docs = self.doc_of[at]
        return np.array(self.doc_ids, np.int64)[docs], at - self.starts[docs]


def _sent(group: int, hashes: np.ndarray, bits: int, columns: dict) -> pd.DataFrame:
    """A row for each bucket: columns (arrays aligned to hashes, which are sorted) cut at bucket borders, packed."""
    buckets = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(buckets)) + 1
    at = np.concatenate(([0], edges)) if len(buckets) else np.empty(0, np.int64)
    out = {"bucket": buckets[at].astype(np.int32), "grp": np.full(len(at), group, np.int64)}
    for name, values in columns.items():
        out[name] = [x.tobytes() for x in np.split(values, edges)] if len(at) else []
    return pd.DataFrame(out)


def _probes(bits: int, window: int):
    def probes(key, docs: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        g = _Group(docs, notes, window)
        runs = rolling(g.codes, g.block, "a")
        at = np.flatnonzero(g.inside(g.block))
        anchored = (at - g.starts[g.doc_of[at]]) % g.block == 0
        keys, first, counts = np.unique(runs[at], return_inverse=True, return_counts=True)
        flags = (counts > 1).astype(np.uint8)
        flags[first[anchored]] |= 2
        short = (keys >> np.uint64(32 - bits)).astype("<u4")  # 32 bits after those of the bucket
        return _sent(key[0], keys, bits, {"keys": short, "flags": flags})

    return probes


def _hits(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: keys that are a block somewhere and stand in two places at least, given back to their groups."""
    keys = np.concatenate([np.frombuffer(b, "<u4") for b in rows["keys"]])
    flags = np.concatenate([np.frombuffer(b, np.uint8) for b in rows["flags"]])
    source = np.repeat(np.arange(len(rows)), [len(b) // 4 for b in rows["keys"]])
    order = np.argsort(keys, kind="stable")
    new = np.concatenate(([True], np.diff(keys[order]) != 0))
    heads = np.flatnonzero(new)
    found = np.bitwise_or.reduceat(flags[order], heads)
    several = (np.diff(np.append(heads, len(order))) > 1) | (found & 1 > 0)
    hit = np.zeros(len(keys), bool)
    hit[order] = (several & (found & 2 > 0))[np.cumsum(new) - 1]
    out = [(rows["bucket"].iat[0], g, keys[(at := np.flatnonzero(hit[a:b]) + a)].tobytes()) for g, a, b in zip(rows["grp"], np.searchsorted(source, np.arange(len(rows))), np.searchsorted(source, np.arange(len(rows)), side="right"), strict=True)]
    return pd.DataFrame([r for r in out if r[2]], columns=["bucket", "grp", "keys"])


def _windows(bits: int, window: int):
    """Of one group: the windows around its hits, each at its first place here."""

    def windows(key, docs: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        g = _Group(docs, notes, window)
        names = ["bucket", "grp", "a", "b", "doc", "start"]
        replies = notes[notes["keys"].notna()]
        if replies.empty or len(g.codes) < window:
            return pd.DataFrame(columns=names)
        wanted = np.unique(np.concatenate([np.frombuffer(k, "<u4").astype(np.uint64) | np.uint64(int(b) << 32) for b, k in zip(replies["bucket"], replies["keys"], strict=True)]))
        runs = rolling(g.codes, g.block, "a") >> np.uint64(32 - bits)
        hit = np.isin(runs, wanted) & g.inside(g.block)
        at = g.around(hit)
        if not len(at):
            return pd.DataFrame(columns=names)
        a, b = rolling(g.codes, window, "a")[at], rolling(g.codes, window, "b")[at].astype("<u4")
        doc, start = g.place(at)
        order = np.lexsort((start, doc, b, a))
        a, b, doc, start = a[order], b[order], doc[order], start[order].astype("<i4")
        new = np.concatenate(([True], (np.diff(a) != 0) | (np.diff(b) != 0)))
        return _sent(key[0], a[new], bits, {"a": a[new], "b": b[new], "doc": doc[new], "start": start[new]})

    return windows


def _later(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: windows that another group has at an earlier place, given back to their groups."""
    a, b, doc, start = (np.concatenate([np.frombuffer(x, kind) for x in rows[name]]) for name, kind in (("a", "<u8"), ("b", "<u4"), ("doc", "<i8"), ("start", "<i4")))
    source = np.repeat(np.arange(len(rows)), [len(x) // 4 for x in rows["b"]])
    order = np.lexsort((start, doc, b, a))
    new = np.concatenate(([True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)))
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.zeros(len(a), bool)
    later[order] = (doc[order] > doc[head]) | ((doc[order] == doc[head]) & (start[order] > start[head]))
    edges = np.searchsorted(source, np.arange(len(rows) + 1))
    out = []
    for g, x, y in zip(rows["grp"], edges, edges[1:], strict=False):
        at = np.flatnonzero(later[x:y]) + x
        if len(at):
            out.append((g, a[at].tobytes(), b[at].tobytes()))
    return pd.DataFrame(out, columns=["grp", "a", "b"])


def _kept(window: int):
    def kept(key, docs: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        g = _Group(docs, notes, window)
        gone = np.zeros(len(g.codes) + 1, np.int64)
        at = g.around(g.repeated())
        if len(at):  # repeats within the group
            a, b = rolling(g.codes, window, "a")[at], rolling(g.codes, window, "b")[at]
            doc, start = g.place(at)
            order = np.lexsort((start, doc, b, a))
            new = np.concatenate(([True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)))
            head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
            later = np.zeros(len(at), bool)
            later[order] = (doc[order] > doc[head]) | ((doc[order] == doc[head]) & (start[order] > start[head]))
            np.add.at(gone, at[later], 1)
            np.add.at(gone, at[later] + window, -1)
        replies = notes[notes["a"].notna()]
        if len(replies):  # windows that stand earlier in another group
            at = np.flatnonzero(g.inside(window))
            a, b = rolling(g.codes, window, "a")[at], rolling(g.codes, window, "b")[at].astype("<u4")
            ra, rb = np.frombuffer(b"".join(replies["a"]), "<u8"), np.frombuffer(b"".join(replies["b"]), "<u4")
            near = np.flatnonzero(np.isin(a, ra))
            at, both = at[near], np.stack([a[near], b[near].astype(np.uint64)], axis=1)
            sent = np.stack([ra, rb.astype(np.uint64)], axis=1)
            known = np.isin(np.ascontiguousarray(both).view("u8,u8").ravel(), np.ascontiguousarray(sent).view("u8,u8").ravel()) if len(both) else np.empty(0, bool)
            np.add.at(gone, at[known], 1)
            np.add.at(gone, at[known] + window, -1)
        covered = np.cumsum(gone)[:-1] > 0
        rows = []
        for k, words in enumerate(g.words):
            if g.copy[k]:
                rest = words if len(words) < window else []
            else:
                mine = covered[g.starts[k] : g.ends[k]]
                rest = [w for w, c in zip(words, mine.tolist(), strict=True) if not c] if mine.any() else words
            rows.append((g.doc_ids[k], len(words), len(words) - len(rest), b" ".join(rest)))
        return pd.DataFrame(rows, columns=["d", "n_words", "n_removed", "kept"])

    return kept


def _digest(step):
    def digested(key, docs: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        out = step(key, docs, notes)
        return out.assign(kept=[hashlib.sha256(k).hexdigest() for k in out["kept"]])

    return digested


def _decoded(step):
    def decoded(key, docs: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        out = step(key, docs, notes)
        return out.assign(kept=[k.decode() for k in out["kept"]])

    return decoded


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20, digest: bool = False) -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed, and kept (the words left, joined by one space) or kept_sha256.

    A word goes if a window of `window` consecutive words covers it whose words also start at an earlier place: in a
    smaller doc_id, or earlier in the same document. Windows are judged on the input. Words are split at ASCII white
    space and unchanged. Null and empty texts have no words; texts shorter than a window lose none. A null doc_id counts
    as smaller than all others. Rows that share a doc_id are places of one document: of two equal rows neither is
    earlier, so both stay. An empty table gives an empty result. The result is written to the shared folder.

    Windows are told apart by 96-bit hashes, and only those near a hit are sent. Whole copies of a text are found first
    and need no windows. window must be even and at least 4.
    """
    if window < 4 or window % 2:
        raise ValueError("window must be even and at least 4")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL)).alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    groups = max(1, n // GROUP_DOCS, size >> 22)  # a few hundred documents, or some 4 MB of text where they are long
    buckets = min(max(8, size >> 25), 1 << 16)  # of the table: some 32 MB of text each, and more where Spark allows no more buckets
    bits = max(6, (size >> 23).bit_length())  # of the hashes: some MB of keys a bucket
    name = f"docloom_substrings_{uuid.uuid4().hex}"
    # by text too, and by row where doc_ids are null: neither many rows without an id nor many texts of one make a large group
    spread = F.when(F.col("d") == _NULL, F.monotonically_increasing_id())
    grouped = rows.select(F.pmod(F.xxhash64("d", F.crc32(F.col("t").cast("binary")), spread), F.lit(groups)).alias("grp"), "d", "t", F.md5("t").alias("h"))
    grouped.write.bucketBy(int(buckets), "grp").option("compression", "zstd").saveAsTable(name)
    try:
        held = spark.table(name)
        least = held.groupBy("h").agg(F.min("d").alias("m"))
        copies = cut(held.select("grp", "d", "h").join(least, "h").where("d > m").select("grp", "d", "h").distinct(), "copies")
        at_home = held.groupBy("grp")
        probes = at_home.cogroup(copies.groupBy("grp")).applyInPandas(_probes(bits, window), "bucket int, grp bigint, keys binary, flags binary")
        hits = probes.groupBy("bucket").applyInPandas(_hits, "bucket int, grp bigint, keys binary")
        notes = copies.unionByName(hits, allowMissingColumns=True)
        windows = at_home.cogroup(notes.groupBy("grp")).applyInPandas(_windows(bits, window), "bucket int, grp bigint, a binary, b binary, doc binary, start binary")
        later = windows.groupBy("bucket").applyInPandas(_later, "grp bigint, a binary, b binary")
        notes = copies.unionByName(later, allowMissingColumns=True)
        step = (_digest if digest else _decoded)(_kept(window))
        out = at_home.cogroup(notes.groupBy("grp")).applyInPandas(step, "d bigint, n_words bigint, n_removed bigint, kept string")
        return cut(out.select(F.when(F.col("d") != _NULL, F.col("d")).alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256" if digest else "kept")), "substrings")
    finally:
        spark.sql(f"drop table if exists {name}")
