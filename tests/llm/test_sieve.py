"""Bitmaps in place of shuffled texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.llm import shared, simhash


def test_sieve_holds_all_keys_and_few_others_where_the_rows_are(spark):
    rows = spark.range(100_000)
    keys = spark.range(500).select(F.xxhash64(F.col("id") * 3).alias("code"))
    mine = (F.col("id") % 3 == 0) & (F.col("id") < 1500)
    marked = shared.sieve(rows, F.xxhash64("id"), keys, "hit")
    assert marked.columns == ["id", "hit"]
    n, hits, lost = marked.select(F.count("*"), F.count_if("hit"), F.count_if(mine & ~F.col("hit"))).first()
    assert n == 100_000 and lost == 0 and 500 <= hits < 5_000
    assert shared.sieve(rows, F.xxhash64("id"), keys).count() == hits
    assert shared.sieve(rows, F.xxhash64("id"), keys.limit(0)).count() == 0


def test_texts_stay_where_they_are(spark, monkeypatch):
    """Only rows that the list of copies names, or seems to, meet it: here no text that stays does, whatever may be broadcast."""
    shared_words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{shared_words} {shared_words}") for i in range(5)] + [(None, shared_words)] + [(100 + i, " ".join(f"x{i}y{j}" for j in range(40))) for i in range(50)] + [(120, " ".join(f"x20y{j}" for j in range(40)))], "doc_id long, text string")
    sieved, real = [], simhash.sieve
    monkeypatch.setattr(simhash, "sieve", lambda *a: sieved.append(real(*a)) or sieved[-1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = sorted(r.doc_id if r.doc_id is not None else -1 for r in simhash.one_of_each_similar(docs).collect())
        flagged = sieved[-1]
        assert flagged.where("_marked and _kept").count() < 10 and flagged.where("_marked and not _kept").count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert kept == [-1, 0, *range(100, 150)]


def test_candidates_are_checked_without_sorting_their_words(monkeypatch):
    """Forty thousand candidates of 26 MB of text spent most of their time in sorts of twenty words each."""
    from docloom.llm import decontamination

    item = " ".join(f"w{i % 17}" for i in range(40))
    items = decontamination.Items([(1, item)])
    monkeypatch.setattr(decontamination.np, "isin", None)
    edited = " ".join("other" if i in (3, 20) else w for i, w in enumerate(item.split()))
    docs = [decontamination.codes(t) for t in (f"a b {item} c", edited, "w1 w2 w3 w4 w5")]
    assert items.matches(docs) == [(0, 0, 0, 2, 42), (1, 0, 2, 0, 40)]


def test_near_copies_meet_at_the_first_shingles_they_share(spark, monkeypatch):
    """Twenty classes with thirty shingles in common made each pair thirty times; pairs stay the same, and few are made again."""
    field = "h long, id long, n int, at int, index boolean, root long, odd array<long>, earlier array<long>"
    own = lambda i: i % 3 + 1  # noqa: E731  some have shingles of their own between the common ones
    places = [[h if h % 7 else 1000 * own(i) + h for h in range(1, 31)] for i in range(20)]
    frame = lambda before: spark.createDataFrame([(h, i, 400, at, True, i, [0] * 8, p[max(0, at - before) : at]) for i, p in enumerate(places) for at, h in enumerate(p)], field)
    monkeypatch.setattr(type(spark.range(0)), "distinct", lambda self: self)
    for turn, most in ((None, 190), (0, 1_000)):
        new, plain = (simhash._open_pairs(frame(before), 0.8, turn).collect() for before in (4, 0))
        assert set(new) == set(plain) and len(set(new)) <= 190
        assert len(set(new)) <= len(new) <= most
    assert len(simhash._open_pairs(frame(4), 0.8, None).collect()) == 190
