"""Phrase collocations: fixed phrases of two to four words, by counts of id n-grams.

Frequent words get 32-bit ids, and pieces break at all others: a phrase that occurs often enough has frequent words only.
N-grams of ids are packed into fixed-width keys of two 64-bit halves, radix-sorted and run-length counted in every chunk
of documents, cut at the bounds of key ranges, and merged range by range in the same way. Longer n-grams are only counted
where both shorter ones inside them are frequent; what says so is a bitmap of fixed size, whose false hits cost time and
change no count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, discard

#: Words of a chunk, keys that a merge holds before it sorts them, n-grams of a key range, and the most ranges.
CHUNK_WORDS, PENDING, RANGE_KEYS, RANGES = 4_000_000, 4_000_000, 2_000_000, 1 << 16
#: Bits of the map of frequent n-grams: 16 MB at any size of the corpus.
MAP_BITS = 27
_BREAK = b"\xff"  # no UTF-8 text has this byte
_TABLE = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, with _BREAK where a piece ends."""
    return (text or b"").translate(_TABLE).replace(_BREAK, b" \xff ").split()


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class _Words(dict):
    """word of one language -> its number in the chunk."""

    def __init__(self, lang: bytes, keys: list[bytes]):
        super().__init__({_BREAK: 0})
        self.lang, self.keys = lang, keys

    def __missing__(self, word: bytes) -> int:
        out = self[word] = len(self.keys)
        self.keys.append(self.lang + b" " + word)
        return out


CHUNKS = "chunk bigint, keys array<binary>, n array<bigint>, stream binary, langs array<binary>, totals array<bigint>"


def _chunked(room: int):
    """Chunks of whole documents (lang, text, both in UTF-8), words numbered within the chunk."""

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        keys, langs, parts, held = [b""], {}, [], 0

        def row() -> pa.RecordBatch:
            stream = np.concatenate(parts)
            n = np.bincount(stream, minlength=len(keys))
            n[0] = 0
            totals: dict[bytes, int] = {}
            for key, k in zip(keys[1:], n[1:].tolist(), strict=True):
                lang = key.rpartition(b" ")[0]
                totals[lang] = totals.get(lang, 0) + k
            columns = [[number], [keys], [n], [_pack(stream)], [list(totals)], [list(totals.values())]]
            kinds = [pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in CHUNKS.split(", ")])

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                words = words_of(text.as_py())
                if not words:
                    continue
                words.append(_BREAK)
                name = lang.as_py()
                look = langs.get(name)
                if look is None:
                    look = langs[name] = _Words(name, keys)
                parts.append(np.fromiter(map(look.__getitem__, words), np.uint32, len(words)))
                held += len(words)
                if held >= room:
                    yield row()
                    number, keys, langs, parts, held = number + 1, [b""], {}, [], 0
        if parts:
            yield row()

    return chunked


def numbered(df: DataFrame, tag: str) -> DataFrame:
    """df written down, with dense ids from 1 in `id`. What the driver gets is a count for each part that was written."""
    df = cut(df.withColumn("_at", F.monotonically_increasing_id()), tag)
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = sorted((r[0], r[1]) for r in df.groupBy(part.alias("part")).count().collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    if total >= 1 << 31:
        raise ValueError("more frequent words than ids")
    starts = df.sparkSession.createDataFrame(offsets, "_part bigint, _start bigint")
    out = df.join(F.broadcast(starts), part == F.col("_part")).withColumn("id", F.col("_start") + at + 1).drop("_part", "_start", "_at")
    out._docloom_folder = df._docloom_folder
    return out


def _encoded(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """A chunk in ids, 0 where a piece breaks, and some of its bigrams, evenly spaced in order."""
    if left.empty:
        return pd.DataFrame({"chunk": [], "ids": [], "marks": []})
    stream = _unpack(left["stream"].iloc[0], "<u4")
    table = np.zeros(int(stream.max()) + 1, np.uint32)
    table[right["at"].to_numpy(np.int64)] = right["id"].to_numpy(np.int64)
    ids = table[stream]
    keep = np.concatenate((ids[:-1] + ids[1:] > 0, ids[-1:] > 0))  # of several breaks the last
    ids = ids[keep]
    some = np.unique(_halves(ids, _starts(ids, 2), 2)[0])
    return pd.DataFrame({"chunk": left["chunk"].iloc[:1], "ids": [_pack(ids)], "marks": [some[:: max(1, len(some) // 64)].astype(np.int64)]})


def _starts(ids: np.ndarray, n: int) -> np.ndarray:
    """Where n-grams begin."""
    if len(ids) < n:
        return np.zeros(0, np.int64)
    ok = ids[: len(ids) - n + 1] > 0
    for k in range(1, n):
        ok &= ids[k : len(ids) - n + 1 + k] > 0
    return np.flatnonzero(ok)


def _halves(ids: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of n-grams: two ids to each half, zero beyond n."""
    word = lambda k: ids[at + k].astype(np.uint64) if k < n else np.zeros(len(at), np.uint64)
    return word(0) << np.uint64(32) | word(1), word(2) << np.uint64(32) | word(3)


def _bits(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """A key's place in the map."""
    x = high * np.uint64(0x9E3779B97F4A7C15) ^ (low + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def radix_order(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The stable order of keys: 16 bits at a time from the last, each by numpy's radix sort; digits all keys share are passed over."""
    order = None
    for half in (low, high):
        for shift in (0, 16, 32, 48):
            digit = (half >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                step = np.argsort(digit if order is None else digit[order], kind="stable")
                order = step if order is None else order[step]
    return np.arange(len(high)) if order is None else order


def run_lengths(high: np.ndarray, low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of n."""
    if not len(high):
        return high, low, n
    order = radix_order(high, low)
    high, low, n = high[order], low[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1]))))
    return high[first], low[first], np.add.reduceat(n, first)


def _counted(n: int, bounds: np.ndarray, frequent: Broadcast | None):
    """Counts of a chunk's n-grams, in order, a row for each key range."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = None if frequent is None else np.frombuffer(frequent.value, np.uint8)
        for frame in frames:
            for data in frame["ids"]:
                ids = _unpack(data, "<u4")
                if known is not None:  # the shorter n-grams that begin at a place and at the next
                    at = _starts(ids, n - 1)
                    bit = _bits(*_halves(ids, at, n - 1))
                    good = np.zeros(len(ids) + 1, bool)
                    good[at] = known[bit >> 3] >> (bit & 7).astype(np.uint8) & 1
                    at = np.flatnonzero(good[:-1] & good[1:])
                else:
                    at = _starts(ids, n)
                high, low, count = run_lengths(*_halves(ids, at, n), np.ones(len(at), np.int64))
                edges = np.concatenate(([0], np.searchsorted(high, bounds), [len(high)]))
                for part in np.flatnonzero(np.diff(edges)):
                    a, b = edges[part], edges[part + 1]
                    yield pd.DataFrame({"part": [part], "high": [_pack(np.diff(high[a:b], prepend=np.uint64(0)))], "low": [_pack(low[a:b])], "n": [_pack(count[a:b])]})

    return counted


def _merged(n: int, least: int):
    """Keys that occur at least so often, from the chunks' counts, which come range by range."""

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, waiting = None, [], 0

        def settle() -> None:
            nonlocal held, waiting
            held, waiting = [run_lengths(*(np.concatenate(x) for x in zip(*held, strict=True)))], 0

        def emit() -> pd.DataFrame:
            settle()
            high, low, total = (x[held[0][2] >= least] for x in held[0])
            words = np.stack((high >> np.uint64(32), high & np.uint64(0xFFFFFFFF), low >> np.uint64(32), low & np.uint64(0xFFFFFFFF)), axis=1)[:, :n].astype(">u4")
            return pd.DataFrame({"key": [w.tobytes() for w in words], "a": total, "bit": _bits(high, low)})

        for frame in frames:
            for row in frame.itertuples(index=False):
                if row.part != part:
                    if held:
                        yield emit()
                    part, held, waiting = row.part, [], 0
                held.append((np.cumsum(_unpack(row.high, "<u8"), dtype=np.uint64), _unpack(row.low, "<u8"), _unpack(row.n, "<i8")))
                waiting += len(held[-1][0])
                if waiting > PENDING:
                    settle()
        if held:
            yield emit()

    return merged


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(1 << 16, np.uint8)
    bits[frame["bit"].to_numpy(np.int64) & 0xFFFF] = 1
    return pd.DataFrame({"block": frame["block"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def _map_of(grams: DataFrame) -> Broadcast:
    """The bitmap of the keys' bits, made in blocks of 2^16."""
    rows = grams.select("bit").distinct().withColumn("block", F.shiftright("bit", 16)).groupBy("block").applyInPandas(_block, "block bigint, bits binary").collect()
    out = bytearray(1 << MAP_BITS - 3)
    for block, bits in rows:
        out[block << 13 : (block + 1) << 13] = bits
    return grams.sparkSession.sparkContext.broadcast(bytes(out))


def _part(key: str, start: int | str, length: int | str) -> Column:
    return F.expr(f"substring({key}, 4 * ({start}) + 1, 4 * ({length}))")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = 30, top: int = 2000, longest: int = 4, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Only A-Z are lower-cased; pieces end at . , ; : ! ? and line breaks, words at spaces and tabs. a, l and r are the
    occurrences, overlaps included, of the phrase, of its first words and of the rest, n those of all words of the
    language. Candidates are phrases of 2 to `longest` (4 at most) words with a >= min_count; their score is
    floor(2000000 a / (l + r)) at the cut where it is lowest, of equal ones the first. Candidates inside a longer one
    that has at least 80 % of their occurrences are dropped. Order: score, a (both descending), phrase (UTF-8). Null
    languages are `und`, null and empty texts have no words, repeated rows count each time, other columns are ignored,
    and an empty table gives an empty result. Counts are exact; products are decimals.

    A chunk sends each word and n-gram once with its count, so frequent ones make no large group.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).cast("binary").alias("lang"), F.col(text).cast("binary").alias("text"))
    chunks = cut(rows.mapInArrow(_chunked(chunk_words), CHUNKS), "chunks")
    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("keys", "n")).alias("at", "w")).select("chunk", "at", F.col("w.keys").alias("key"), F.col("w.n").alias("n")).where("n > 0")
    words = numbered(listed.groupBy("key").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count), "words")
    named = words.select("id", "a", "key", F.expr("unhex(lpad(hex(id), 8, '0'))").alias("gram"), F.expr("substring_index(cast(key as string), ' ', -1)").alias("word"))
    named = named.withColumn("lang", F.expr("substring(cast(key as string), 1, length(cast(key as string)) - length(word) - 1)"))
    local = listed.join(words.select("key", "id"), "key").select(F.col("chunk").alias("of"), "at", "id")
    encoded = cut(chunks.select("chunk", "stream").groupBy("chunk").cogroup(local.groupBy("of")).applyInPandas(_encoded, "chunk bigint, ids binary, marks array<bigint>"), "encoded")
    totals = cut(chunks.select(F.explode(F.arrays_zip("langs", "totals")).alias("t")).groupBy(F.col("t.langs").cast("string").alias("lang")).agg(F.sum("t.totals").alias("n")), "totals")
    held = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = max(1, min(RANGES, held // RANGE_KEYS))
    marks = encoded.select(F.explode("marks").alias("m"))
    some = sorted(r[0] for r in marks.sample(min(1.0, 20 * ranges / max(1, encoded.count() * 64)), 7).collect())
    bounds = np.array(sorted({some[len(some) * k // ranges] for k in range(1, ranges)}) if some else [], np.uint64)
    levels, frequent = [], None
    for n in range(2, longest + 1):
        counts = encoded.select("ids").mapInPandas(_counted(n, bounds, frequent), "part int, high binary, low binary, n binary")
        grams = cut(counts.repartition("part").sortWithinPartitions("part").mapInPandas(_merged(n, min_count), "key binary, a bigint, bit bigint"), "grams")
        levels.append(grams)
        if n < longest:
            frequent = _map_of(grams)
    found = levels[0]
    for more in levels[1:]:
        found = found.unionByName(more)
    found = found.select("key", "a", (F.length("key") / 4).cast("int").alias("len"))
    every = found.select("key", "a").unionByName(named.select(F.col("gram").alias("key"), "a"))
    # the cut at which a phrase scores lowest
    cuts = found.select("key", "a", "len", F.explode(F.expr("sequence(1, len - 1)")).alias("k")).withColumns({"first": _part("key", 0, "k"), "rest": _part("key", "k", "len - k")})
    cuts = cuts.join(every.select(F.col("key").alias("first"), F.col("a").alias("l")), "first").join(every.select(F.col("key").alias("rest"), F.col("a").alias("r")), "rest")
    score = F.expr("(cast(2000000 as decimal(38, 0)) * a) div (cast(l as decimal(38, 0)) + r)")
    best = cuts.groupBy("key", "a", "len").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    # phrases inside longer ones
    inner = F.expr("flatten(transform(sequence(0, len - 2), i -> transform(sequence(2, least(len - i, len - 1)), j -> substring(key, 4 * i + 1, 4 * j))))")
    longer = found.where("len > 2").select("a", F.explode(inner).alias("key")).groupBy("key").agg(F.max("a").alias("most"))
    left = best.join(longer, "key", "left").where("most is null or cast(100 as decimal(38, 0)) * most < cast(80 as decimal(38, 0)) * a")
    by_score = [F.desc("score"), F.desc("a")]
    scored = left.select("key", "a", "b.score", "b.l", "b.r", _part("key", 0, 1).alias("gram")).join(named.select("gram", "lang"), "gram").drop("gram")
    chosen = cut(scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*by_score))).where(F.col("place") <= top), "chosen")
    spelt = chosen.select("key", F.posexplode(F.expr("transform(sequence(0, cast(length(key) / 4 as int) - 1), i -> substring(key, 4 * i + 1, 4))")).alias("at", "gram"))
    spelt = spelt.join(named.select("gram", "word"), "gram").groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = chosen.join(spelt, "key").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by_score, "phrase")).cast("bigint")).where(F.col("rank") <= top)
    out = cut(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    discard(chunks, words, encoded, totals, chosen, *levels)
    return out


def oracle_sql(min_count: int = 30, top: int = 2000) -> str:
    """The same in DuckDB SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""with piece as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) as t from documents),
w as (select lang, regexp_extract_all(t, '[^\\x20\\x09]+') as w from piece), s as (select lang, w, unnest(generate_series(1, len(w))) as i from w where len(w) > 0),
f as (select lang, w[i:i + k - 1] as p, count(*) as a from s, (values (1), (2), (3), (4)) as t(k) where i + k - 1 <= len(w) group by all), n as (select lang, sum(a)::bigint as n from f where len(p) = 1 group by lang),
c as (select * from f where len(p) > 1 and a >= {min_count}), cuts as (select lang, p, a, unnest(range(1, len(p))) as k from c),
scored as (select u.*, x.a as l, y.a as r, ((2000000::hugeint * u.a) // (x.a + y.a))::bigint as score from cuts u join f x on x.lang = u.lang and x.p = u.p[1:k] join f y on y.lang = u.lang and y.p = u.p[k + 1:]),
best as (select lang, p, a, arg_min({{'score': score, 'l': l, 'r': r}}, (score, k)) as b from scored group by all),
inside as (select lang, p[i:j] as p, max(a) as most from (select lang, p, a, i, unnest(range(i + 1, len(p) + 1)) as j from (select *, unnest(range(1, len(p))) as i from c)) where j - i + 1 < len(p) group by all),
o as (select lang, array_to_string(p, ' ') as phrase, a, b.l as l, b.r as r, b.score as score from best left join inside using (lang, p) where most is null or 100::hugeint * most < 80::hugeint * a),
k as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from o)
select lang, rank, phrase, a, l, r, n, score from k join n using (lang) where rank <= {top}"""
