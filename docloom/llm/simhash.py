"""SimHash fingerprints and their near-duplicate groups by pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import begin, components, cut, discard, sieve

BITS = 64
SEED = 42
_SLAB = 1 << 16
#: Documents whose shingles are counted, and how many of the commonest shingles go last in a prefix. Any order gives the same links.
_COUNTED, _COMMON = 8_000, 200_000
#: Rounds in which each class meets some others of each of its shingles, and how many, before all pairs that are still open.
_ROUNDS, _SOME = 2, 8
#: Shingles before each one of a class that say whether a pair has met already.
_BEFORE = 4
#: Longs of the odd sketch of a shingle set [Mitzenmacher, Pagh, Pham 2014].
WIDE = 8


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    body = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    n, ones, digest = len(first), np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, _SLAB):
        hashes = np.array([digest(body[a:b], SEED) for a, b in zip(first[at : at + _SLAB], last[at : at + _SLAB], strict=True)], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def simhash(text: Column, words_per_shingle: int = 3) -> Column:
    """The fingerprint as a bigint of the same bits."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words_per_shingle) for t in texts], np.uint64).astype(np.int64))

    return hashed(text)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of max_bits + 1 segments, which lie in a ring."""
    edges = [round(BITS * k / (max_bits + 1)) for k in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _part(fp: str, segment: tuple[int, int]) -> str:
    offset, width = segment
    return f"(shiftrightunsigned({fp}, {offset}) & {(1 << width) - 1}L)" if width < BITS else fp


def near_pairs(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs of distinct fingerprints that differ in 1 to max_bits bits, as (a, b) with reps (rep_a, rep_b).

    prints: one row for each distinct fingerprint, (fp, rep). With m = max_bits + 1 segments in a ring, two fingerprints
    within the bound have a place from which every chain of l consecutive segments differs in at most l * max_bits / m,
    that is l - 1 bits. So the first segment is equal and the first two differ in one bit at most: both together are the
    join key. One side looks up its own key and those with one of the second segment's zero bits set; of two keys that
    differ in a bit, one has it zero, so either order is found once. Longer chains prune before the full check.
    """
    if not 1 <= max_bits <= 7:
        raise ValueError("max_bits must be 1 to 7")
    ring = _segments(max_bits)
    m = len(ring)

    def key(i: int, flip: str = "0L") -> str:
        return f"xxhash64({i}, {_part('fp', ring[i])}, {_part('fp', ring[(i + 1) % m])} | {flip})"

    index = prints.select("fp", "rep", F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.expr(key(i)).alias("key")) for i in range(m)])).alias("k"))
    index = index.select(F.col("k.key").alias("key"), F.col("k.at").alias("at"), F.col("fp").alias("b"), F.col("rep").alias("rep_b"))
    probes = []
    for i in range(m):
        second = ring[(i + 1) % m]
        flips = f"transform(filter(sequence(0, {second[1] - 1}), s -> shiftrightunsigned({_part('fp', second)}, s) & 1L = 0L), s -> struct({i} as at, {key(i, 'shiftleft(1L, s)')} as key, true as flipped))"
        probes.append(F.expr(f"concat(array(struct({i} as at, {key(i)} as key, false as flipped)), {flips})"))
    probe = prints.select("fp", "rep", F.explode(F.concat(*probes)).alias("k")).select(F.col("k.key").alias("key"), F.col("k.at").alias("at_a"), F.col("k.flipped").alias("flipped"), F.col("fp").alias("a"), F.col("rep").alias("rep_a"))
    chains = []
    for i in range(m):
        total, tests = "0", [f"at = {i}"]
        for length in range(1, m + 1):
            total += f" + bit_count({_part('(a ^ b)', ring[(i + length - 1) % m])})"
            tests.append(f"{total} <= {length - 1}")
        chains.append(f"({' and '.join(tests)})")
    found = probe.join(index, "key").where(f"at = at_a and (flipped or a < b) and ({' or '.join(chains)}) and bit_count(a ^ b) <= {max_bits}")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.expr("if(a < b, rep_a, rep_b)").alias("rep_a"), F.expr("if(a < b, rep_b, rep_a)").alias("rep_b")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_per_shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints within max_bits bits are linked; component_id is the smallest doc_id reachable by links. Rows with one
    fingerprint are grouped first, so copies are never paired. Null and blank texts have fingerprint zero and are linked
    like any other. Repeated rows stay and share their component. A null doc_id stays in the result but can't be a
    component_id, unless all of a component's are null. An empty table gives an empty result.
    """
    rows = cut(docs.select(F.col(doc_id).cast("long").alias("doc_id"), simhash(F.col(text), words_per_shingle).alias("fp")), "prints")
    prints = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    roots = components(near_pairs(prints, max_bits), "rep_a", "rep_b").select(F.col("node").alias("rep"), "root")
    groups = prints.join(roots, "rep", "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    return rows.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_set(text: str | None, words_per_shingle: int = 5) -> tuple[np.ndarray, list[bytes]]:
    """(sorted distinct 64-bit hashes of the shingles, words), words and short texts as for fingerprint()."""
    words = (text or "").encode().lower().split()
    k = min(words_per_shingle, len(words))
    hashes = {xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), SEED) for i in range(len(words) - k + 1)} if words else set()
    return np.sort(np.fromiter(hashes, np.uint64, len(hashes))), words


def _majority(hashes: np.ndarray) -> np.int64:
    """The bits that more than half of the hashes have."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _SLAB):
        ones += np.unpackbits(hashes[at : at + _SLAB].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0]


def _wide(shingles: np.ndarray) -> np.ndarray:
    """The odd sketch, as WIDE longs or a power of two more, so that a set has a bit for each shingle: bit b says whether
    an odd number of hashes falls to b. Shingles that two sets share cancel out, and each other flips one bit, so two
    sketches never differ in more bits than the sets differ in shingles."""
    bits = max(BITS * WIDE, 1 << (len(shingles) - 1).bit_length() if len(shingles) else 0)
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _narrow(wide: np.ndarray) -> np.ndarray:
    """The sketch of WIDE longs that a longer one folds to."""
    return np.bitwise_xor.reduce(wide.reshape(-1, WIDE), axis=0)


def _apart(w_a: str, w_b: str) -> str:
    """In how many bits two sketches differ; the longer is folded to the shorter's length. Similar sizes need one fold."""
    fold = lambda w: f"zip_with(slice({w}, 1, size({w}) div 2), slice({w}, size({w}) div 2 + 1, size({w}) div 2), (x, y) -> x ^ y)"
    a, b = f"if(size({w_a}) > size({w_b}), {fold(w_a)}, {w_a})", f"if(size({w_b}) > size({w_a}), {fold(w_b)}, {w_b})"
    return f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"


def _may_be(similarity: float, sketch: str = "w") -> str:
    """A condition on n_a, n_b and the sketches w_a and w_b that every pair of sets of that similarity meets: such sets
    differ in at most (1 - similarity) / (1 + similarity) * (n_a + n_b) shingles."""
    apart = _apart(f"{sketch}_a", f"{sketch}_b")
    return f"least(n_a, n_b) >= {similarity}D * greatest(n_a, n_b) - 1e-6D and {apart} * {1 + similarity}D <= {1 - similarity}D * (n_a + n_b) + 1e-6D"


def _reaches(similarity: float) -> str:
    """A condition on sizes n_a and n_b and the places at_a and at_b of a shared shingle that every pair of sets of that similarity meets at
    the first one they share: neither set is too small, and enough of both is left from there."""
    return f"least(n_a, n_b) >= {similarity}D * greatest(n_a, n_b) - 1e-6D and least(n_a - at_a, n_b - at_b) * {1 + similarity}D >= {similarity}D * (n_a + n_b) - 1e-6D"


def _common(docs: DataFrame, words_per_shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of the shingles that are commonest in some documents; _COMMON at most."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["text"]:
                yield pd.DataFrame({"h": shingle_set(text, words_per_shingle)[0].view(np.int64)})

    some = docs.select("text").sample(min(1.0, _COUNTED / max(1, docs.count())), SEED)
    rows = some.mapInPandas(hashed, "h bigint").groupBy("h").count().where("count > 2").orderBy(F.desc("count"), "h").limit(_COMMON).collect()
    hashes, counts = np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64)
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def _prefix(shingles: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles of a set in an order that holds for all sets, rare ones first: so many that two sets of that
    similarity share one of them [Chaudhuri, Ganti, Kaushik 2006]."""
    n, (hashes, counts) = len(shingles), common
    often = np.zeros(n, np.int64)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, shingles), len(hashes) - 1)
        often = np.where(hashes[at] == shingles, counts[at], 0)
    return shingles[np.lexsort((shingles, often))[: n - int(np.ceil(similarity * n - 1e-6)) + 1 if n else 0]].view(np.int64)


def _index_size(n: str, similarity: float) -> str:
    """How much of its prefix the smaller of two sets needs: with ceil(2 s / (1 + s) n) shingles in common at least, one of its first ones is
    in the other's prefix [Bayardo, Ma, Srikant 2007]."""
    return f"{n} - cast(ceil({2 * similarity / (1 + similarity)}D * {n} - 1e-6D) as int) + 1"


#: Bits of the map of shingles that several documents have in their prefixes: 16 MB at any size; keys that a packing step holds.
_MAP_BITS, _HELD = 27, 500_000


def _repeated(rows: DataFrame) -> Broadcast:
    """A bitmap of the prefix shingles that more than one row has. Each task sends its distinct ones once, sorted and packed, to
    the part that their leading bits name; other shingles' false hits only cost time."""
    bits = max(4, (rows.count() // 10_000).bit_length())

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("prefixes")
        held, size = [], 0

        def emit() -> Iterator[pd.DataFrame]:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            parts = (keys >> np.uint64(64 - bits)).astype(np.int64)
            edges = [*np.flatnonzero(np.diff(parts, prepend=-1)).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                deltas = np.diff(keys[a:b], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()
                yield pd.DataFrame({"part": [int(parts[a])], "keys": [zstandard.ZstdCompressor(level=1).compress(deltas)], "twice": [np.packbits(n[a:b] > 1).tobytes()]})

        for frame in frames:
            for prefix in frame["prefix"]:
                held.append(np.asarray(prefix, np.int64).view(np.uint64))
                size += len(held[-1])
                if size > _HELD:
                    yield from emit()
                    held, size = [], 0
        if size:
            yield from emit()

    def shared(frame: pd.DataFrame) -> pd.DataFrame:
        keys, twice = [], []
        for row in frame.itertuples(index=False):
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.keys), np.uint8).reshape(8, -1)
            keys.append(np.cumsum(np.ascontiguousarray(raw.T).view(np.uint64).reshape(-1), dtype=np.uint64))
            twice.append(np.unpackbits(np.frombuffer(row.twice, np.uint8), count=len(keys[-1])).astype(bool))
        keys, twice = np.concatenate(keys), np.concatenate(twice)
        order = np.argsort(keys, kind="stable")
        keys, twice = keys[order], twice[order]
        again = keys[1:][keys[1:] == keys[:-1]]
        places = np.unique(_places(np.concatenate((keys[twice], again))))
        blocks = places >> 16
        edges = [*np.flatnonzero(np.diff(blocks, prepend=-1)).tolist(), len(places)]
        return pd.DataFrame([(int(blocks[a]), (places[a:b] & 0xFFFF).astype("<u2").tobytes()) for a, b in zip(edges, edges[1:], strict=False)], columns=["block", "at"])

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << 16, np.uint8)
        for at in frame["at"]:
            bits[np.frombuffer(at, "<u2")] = 1
        return pd.DataFrame({"block": frame["block"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    found = rows.select("prefix").mapInPandas(packed, "part bigint, keys binary, twice binary").groupBy("part").applyInPandas(shared, "block bigint, at binary")
    out = bytearray(1 << _MAP_BITS - 3)
    for block, data in found.groupBy("block").applyInPandas(joined, "block bigint, bits binary").collect():
        out[block << 13 : (block + 1) << 13] = data
    return rows.sparkSession.sparkContext.broadcast(bytes(out))


def _places(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _MAP_BITS)).astype(np.int64)


def _kept_places(frequent: Broadcast):
    """(id, n, at, h) of the prefix shingles that the bitmap has."""

    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("places")
        bits = np.frombuffer(frequent.value, np.uint8)
        for frame in frames:
            sizes = frame["prefix"].map(len).to_numpy(np.int64)
            keys = np.concatenate([np.asarray(p, np.int64) for p in frame["prefix"]]) if sizes.sum() else np.zeros(0, np.int64)
            at = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            place = _places(keys.view(np.uint64))
            good = (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            yield pd.DataFrame({"id": np.repeat(frame["id"].to_numpy(np.int64), sizes)[good], "n": np.repeat(frame["n"].to_numpy(np.int32), sizes)[good], "at": at[good].astype(np.int32), "h": keys[good]})

    return kept


ROW = "id bigint, n int, fp bigint, odd array<bigint>, wide array<bigint>, prefix array<bigint>"
_SLICE = 500  # rows that a sketching or hashing step gives back at once


def _sketches(docs: DataFrame, words_per_shingle: int, similarity: float) -> DataFrame:
    """(doc_id, key: a hash of the text, id: one of the shingle set, its size n, fp: its SimHash, wide: its odd sketch, prefix)."""
    common = _common(docs, words_per_shingle)

    def sketched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("sketches")
        for frame in frames:
            for at in range(0, max(1, len(frame)), _SLICE):
                rows = []
                for doc_id, text, key in frame.iloc[at : at + _SLICE].itertuples(index=False):
                    s, _ = shingle_set(text, words_per_shingle)
                    digest, wide = xxhash.xxh3_64_intdigest(s.astype("<u8").tobytes()), _wide(s)
                    rows.append((doc_id, key, digest - (1 << 63), len(s), _majority(s), _narrow(wide), wide, _prefix(s, common, similarity)))
                yield pd.DataFrame(rows, columns=["doc_id", "key", "id", "n", "fp", "odd", "wide", "prefix"]).astype({"doc_id": "Int64"})

    return docs.mapInPandas(sketched, f"doc_id bigint, key bigint, {ROW}")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words_per_shingle: int, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) of classes whose shingle sets are that similar. Only texts that stand for a class in a pair are read again."""
    pairs = cut(pairs.select("a", "b").distinct(), "pairs")
    ends = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct()
    chosen = classes.join(ends, "id", "left_semi").select("id", F.col("first.doc_id").alias("d"), F.col("first.key").alias("k"))

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("sets")
        for frame in frames:
            for at in range(0, len(frame), _SLICE):
                part = frame.iloc[at : at + _SLICE]
                yield pd.DataFrame({"id": part["id"], "s": [shingle_set(t, words_per_shingle)[0].view(np.int64) for t in part["text"]]})

    chosen = cut(chosen, "chosen")  # written first: its size tells Spark whether to broadcast it, and texts stay where they are
    met = sieve(docs, F.xxhash64("doc_id", "key"), chosen.select(F.xxhash64("d", "k")))
    texts = met.join(chosen, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))).select("id", "text")
    sets = cut(texts.mapInPandas(hashed, "id bigint, s array<bigint>").dropDuplicates(["id"]), "sets")  # repeated rows have one set
    side = lambda x: sets.select(F.col("id").alias(x), F.col("s").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("s_a", "s_b"))
    found = cut(both.where(shared >= similarity * (F.size("s_a") + F.size("s_b") - shared)).select("a", "b"), "links")
    discard(pairs, sets, chosen)
    return found


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, key): key tells texts apart that share a doc_id; a null text has its own."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), _key(F.col(text)).alias("key"))


def _key(text: Column) -> Column:
    return F.xxhash64(text.isNull(), text)


def _similar(docs: DataFrame, words_per_shingle: int, similarity: float, max_bits: int) -> DataFrame:
    """(doc_id, key, id, component_id, first): the row's class, the smallest doc_id of its component, and that row's (doc_id, key)."""
    rows = cut(_sketches(docs, words_per_shingle, similarity), "sketches")
    own = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("order"), "doc_id", "key")
    classes = cut(rows.groupBy("id").agg(F.min(own).alias("first"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("odd").alias("odd"), F.first("wide").alias("wide")), "classes")
    side = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("wide").alias(f"w_{x}"))
    likely = lambda pairs: _verified(pairs.join(side("a"), "a").join(side("b"), "b").where(_may_be(similarity)), classes, docs, words_per_shingle, similarity)
    # fingerprints first: classes of one, and those of near ones
    prints = cut(classes.groupBy("fp").agg(F.min("id").alias("rep")), "prints")
    near = near_pairs(prints, max_bits).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    same = classes.join(prints, "fp").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    # then every class with the least one of each shingle of its prefix. Merge joins, so that the plan is one at any size
    # Shingles that one row alone has don't leave their task, nor do those that no set needs as the smaller one
    frequent = _repeated(rows)
    places = rows.select("id", "n", "prefix").mapInPandas(_kept_places(frequent), "id bigint, n int, at int, h bigint").withColumn("index", F.expr(f"at < {_index_size('n', similarity)}"))
    ends = [F.min("id").alias("low"), F.max("id").alias("high"), F.min(F.when(F.col("index"), F.struct("id", "n", "at"))).alias("lead")]
    several = places.groupBy("h").agg(*ends).where("low < high and lead is not null")
    shared = cut(places.join(several.hint("merge"), "h").distinct(), "shared")  # copies of a class make one row
    lead = shared.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), F.col("lead.id").alias("b"), F.col("lead.n").alias("n_b"), F.col("lead.at").alias("at_b"))
    lead = lead.where(f"a <> b and {_reaches(similarity)}").select("a", "b")
    links = likely(near.unionAll(same).unionAll(lead).distinct())
    # of a shingle of two classes that was the only pair; the others go on
    crowded = shared.where("id > low and id < high").select("h").distinct()
    crowd = cut(shared.drop("low", "high", "lead").join(crowded, "h", "left_semi"), "crowd")
    discard(shared)
    frequent.destroy()
    # then, where the classes of a shingle are in several groups, with some others of them in each round, and at last all that is open
    for turn in range(_ROUNDS + 1):
        roots = components(links, "a", "b").select(F.col("node").alias("id"), "root")
        rooted = cut(crowd.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "rooted")
        mixed = rooted.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h")
        still = cut(_with_earlier(rooted.join(mixed, "h").join(classes.select("id", "odd"), "id")), "open")
        more = likely(_open_pairs(still, similarity, turn if turn < _ROUNDS else None))
        discard(rooted, still)
        links = links.unionByName(more)
    roots = components(links, "a", "b").select(F.col("node").alias("id"), "root")
    named = cut(classes.select("id", "first").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "roots")
    discard(prints, crowd, classes)
    groups = named.join(named.groupBy("root").agg(F.min("first").alias("of")), "root").select("id", F.col("of").alias("first"))
    return rows.select("doc_id", "key", "id").join(groups, "id").withColumn("component_id", F.col("first.doc_id"))


def _with_earlier(places: DataFrame) -> DataFrame:
    """places with earlier: the last shingles that the same class has before each."""
    return places.withColumn("earlier", F.collect_list("h").over(Window.partitionBy("id").orderBy("at").rowsBetween(-_BEFORE, -1)))


def _open_pairs(still: DataFrame, similarity: float, turn: int | None) -> DataFrame:
    """Pairs (a, b) of classes in different groups that share a shingle h and that no bound rules out: each class with
    the _SOME that `turn` picks by hash for each of its shingles, so rows grow in proportion, or all of them if turn is None.

    A pair is made where no shingle just before this one has made it: what holds for it at one place holds at all earlier ones,
    so the first shared one makes it, and of the many others that near copies share few do.

    still: (h, id, n, at: the place of h in its prefix, index: whether that is in its index part, root, odd, earlier).
    """
    fields = ["id", "n", "at", "root", "odd", "index", "earlier"]
    end = lambda x: [F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in fields[1:]]]
    other = still
    if turn is not None:
        rank = F.row_number().over(Window.partitionBy("h").orderBy(F.xxhash64(F.lit(turn), "h", "id"), "id"))  # ranks beyond the bound don't leave their task
        other = _with_earlier(still.withColumn("rank", rank).where(f"rank <= {_SOME}").drop("rank", "earlier"))  # earlier ones that were picked, too
    both = (still if turn is not None else still.where("index")).select("h", *end("a")).join(other.select("h", *end("b")), "h")
    # the smaller set has the shingle in its index part, so what most sets share far back brings no pairs together
    is_open = f"root_a <> root_b and {_reaches(similarity)} and if(n_a < n_b or n_a = n_b and a < b, index_a, index_b) and {_may_be(similarity, 'odd')} and not arrays_overlap(earlier_a, earlier_b)"
    found = both.where(is_open if turn is not None else f"(n_a < n_b or n_a = n_b and a < b) and {is_open}")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_per_shingle: int = 5, similarity: float = 0.8, max_bits: int = 3) -> DataFrame:
    """One row for each document: doc_id, component_id, linked where sets of shingles have a Jaccard similarity of `similarity`.

    SimHash fingerprints of the sets give the first candidates, by pigeonring within max_bits bits. Sets at 0.8 differ in
    some ten of 64 bits, so an exact way finds the rest: candidates share a shingle of their prefixes, as all pairs of that
    similarity do, and no link is lost. Documents of one set are a class and never paired. Each class is held against
    those its fingerprint finds and the least one of each shingle of its prefix, then in rounds against some others of each
    shingle that are in another group by then, which joins large groups by few pairs; of all other candidate pairs only those
    that this leaves in different groups, and whose sizes, places of the shared shingle and odd sketches (bounds that
    every similar pair meets) don't rule them out, follow. Every link is verified by the exact sets, told apart by 64-bit
    hashes. Null and blank texts have the empty set and are one class; shorter texts than a shingle are one shingle. Rows
    that share a doc_id are rows of their own, each with its own text. A null doc_id comes last in its group and is its
    component_id only where all are null. An empty table gives an empty result.
    """
    return _similar(_rows(docs, doc_id, text), words_per_shingle, similarity, max_bits).select("doc_id", "component_id")


def one_of_each_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs, all columns, that stand for their group of similar_documents(): the one with the smallest doc_id,
    of several texts with that doc_id one. Rows are told apart by doc_id and text, so a text that merely shares its doc_id
    with a copy stays; of rows that are equal in both one stays. Rows with a null doc_id stay. Only texts that one bitmap
    has among those that go and another among those that stay wait for the list of what goes; no other text is shuffled.
    """
    found = _similar(_rows(docs, doc_id, text), **{"words_per_shingle": 5, "similarity": 0.8, "max_bits": 3} | options).where("doc_id is not null")
    found = cut(found.select("doc_id", "key", (F.struct("doc_id", "key") == F.struct("first.doc_id", "first.key")).alias("stays")), "groups")
    gone = found.where(~F.col("stays")).select("doc_id", "key").distinct()
    twice = found.where("stays").groupBy("doc_id", "key").count().where("count > 1").select("doc_id", "key")
    marks = cut(gone.withColumn("gone", F.lit(True)).unionByName(twice.withColumn("gone", F.lit(False))), "marks")
    code = F.xxhash64("doc_id", "key")
    # what a bitmap of the marked rows has and one of the others among them hasn't goes for certain; rows in both are looked up
    stay = cut(sieve(found.where("stays").select("doc_id", "key"), code, marks.select(code)), "kept")
    own = F.xxhash64(F.col(doc_id).cast("long"), _key(F.col(text)))
    flagged = sieve(sieve(docs.where(F.col(doc_id).isNotNull()), own, marks.select(code), "_marked"), own, stay.select(code), "_kept")
    marks = marks.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("gone").alias("_gone"))
    seen = flagged.where("_marked and _kept").drop("_marked", "_kept").join(marks, (F.col(doc_id).cast("long") == F.col("_d")) & (_key(F.col(text)) == F.col("_k")), "left")
    once = seen.where("not _gone").dropDuplicates(["_d", "_k"])  # repeated rows alone
    clear = docs.where(F.col(doc_id).isNull()).unionByName(flagged.where("not _marked").select(docs.columns))
    return clear.unionByName(seen.where("_gone is null").select(docs.columns)).unionByName(once.select(docs.columns))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs, all columns, that stand for their group of near_duplicates(): those with the smallest doc_id; a
    repeated doc_id stays once, whichever its text. Rows with a null doc_id stay."""
    groups = near_duplicates(docs, doc_id, text, **options)
    gone = cut(groups.where("doc_id <> component_id").select(F.col("doc_id").alias(doc_id)).distinct(), "copies")
    named = docs.where(F.col(doc_id).isNotNull()).join(gone, doc_id, "left_anti").dropDuplicates([doc_id])
    return named.select(docs.columns).unionByName(docs.where(F.col(doc_id).isNull()))
