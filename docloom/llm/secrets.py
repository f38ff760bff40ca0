"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Every candidate value is hashed, and hashes are counted over the whole corpus by distinct repositories and owners. A
value that many owners carry is a copied example; one that a single owner carries looks live. The counts also find
secrets that no context gives away: long mixed tokens that one owner alone has (kind `owned`).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut

# The base patterns. Runs of hex under 16 characters are dropped either way, so the scan passes over them.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
OWNED = r"[A-Za-z0-9+/_-]{24,}={0,2}"
KINDS = ("assign", "access", "hex", "owned")

#: A code point that no pattern matches marks the matches; where a text has it, another such stands in.
MARK, OTHER = "￿", "￾"
SPAN = "struct<start:int,kind:int,end:int,hash:string>"


def _spans(text: Column, pattern: str, kind: int, value: Callable[[Column], Column], keep: Callable[[Column], Column]) -> Column:
    """Spans of the leftmost non-overlapping matches that pass keep.

    Each match is put between marks and the text split at them, so that every second part is a match; the lengths of the
    parts, in code points, add up to places.
    """
    parts = F.split(F.regexp_replace(F.translate(text, MARK, OTHER), pattern, f"{MARK}$0{MARK}"), MARK)
    none = F.array().cast(f"array<{SPAN}>")

    def step(a: Column, part: Column) -> Column:
        end = a["at"] + F.length(part)
        span = F.struct(a["at"].alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.md5(value(part)).alias("hash"))
        spans = F.when(a["inside"] & keep(part), F.concat(a["spans"], F.array(span))).otherwise(a["spans"])
        return F.struct(end.alias("at"), (~a["inside"]).alias("inside"), spans.alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), none.alias("spans"))
    return F.when(F.size(parts) > 1, F.aggregate(parts, zero, step, lambda a: a["spans"])).otherwise(none)


def _assigned(m: Column) -> Column:
    return F.regexp_extract(m, ASSIGN, 2)


def _mixed(m: Column) -> Column:
    return m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]") & (F.size(F.array_distinct(F.split(m, ""))) >= 12)


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def _base(body: Column) -> Column:
    return F.concat(
        _spans(body, ASSIGN, 0, _assigned, lambda m: F.length(_assigned(m)) >= 12),
        _spans(body, ACCESS, 1, lambda m: m, lambda m: F.length(m) >= 18),
        _spans(body, HEX, 2, lambda m: m, lambda m: F.lit(True)),
    )


def find_spans(docs: DataFrame, doc_id: str, text: str, owner: str) -> DataFrame:
    """(uid, doc_id, owner, base, extra): spans of the base kinds, and mixed tokens that touch none of them."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("doc_id"), F.col(owner).cast("string").alias("owner"), _base(body).alias("base"), _spans(body, OWNED, 3, lambda m: m, _mixed).alias("extra"))
    return rows.withColumn("extra", _apart())


def _apart() -> Column:
    """Those of extra that touch no span of base."""
    return F.filter("extra", lambda e: ~F.exists("base", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"])))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, repositories, owners): in how many documents a value is, and of how many owners. A document without an owner is one by itself."""
    hashes = F.array_distinct(F.transform(F.concat("base", "extra"), lambda s: s["hash"]))
    each = found.select(F.coalesce("owner", F.concat(F.lit("\0"), F.col("uid").cast("string"))).alias("owner"), F.explode(hashes).alias("hash"))
    return each.groupBy("hash", "owner").agg(F.count("*").alias("n")).groupBy("hash").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", example_owners: int = 3) -> DataFrame:
    """One row for each document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_live, n_example, all_spans.

    Base spans stay whatever their frequency; n_live counts those whose value a single owner has, n_example those that
    example_owners or more have. Kind `owned` is added for mixed tokens with a single owner. all_spans is the array
    behind the string. Null and empty texts have no span; a null owner makes a document its own owner. Repeated rows are
    rows of their own, told apart by a number, so doc_id may be null or repeated. An empty table gives an empty result.
    One scan of the texts is written; what is shuffled after it are hashes, combined by hash and owner before the
    exchange, and the join back to spans, which adaptive execution splits on hot hashes.
    """
    found = cut(find_spans(docs, doc_id, text, owner), "secrets")
    spans = found.select("uid", F.explode(F.concat("base", "extra")).alias("s"))
    known = spans.withColumn("hash", F.col("s.hash")).join(ownership(found), "hash")
    told = known.select("uid", "s", "owners").where((F.col("s.kind") < 3) | (F.col("owners") == 1))
    per_doc = told.groupBy("uid").agg(
        F.collect_list("s").alias("all_spans"),
        F.count_if((F.col("s.kind") < 3) & (F.col("owners") == 1)).alias("n_live"),
        F.count_if((F.col("s.kind") < 3) & (F.col("owners") >= example_owners)).alias("n_example"),
    )
    counts = {f"n_{k}": F.expr(f"cast(size(filter(all_spans, s -> s.kind = {i})) as bigint)") for i, k in enumerate(KINDS)}
    return (
        found.select("uid", "doc_id", "base").join(per_doc, "uid", "left")
        .withColumn("all_spans", F.coalesce("all_spans", F.array().cast(f"array<{SPAN}>")))
        .select("doc_id", counts["n_assign"].alias("n_assign"), counts["n_access"].alias("n_access"), counts["n_hex"].alias("n_hex"),
                F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("all_spans")).alias("spans"), counts["n_owned"].alias("n_owned"),
                F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"), F.array_sort("all_spans").alias("all_spans"))
    )


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """text with every span replaced by mask; overlapping spans are replaced once, by one mask."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        gap = F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(fresh, F.concat(a["out"], gap, F.lit(mask))).otherwise(a["out"]).alias("out"))

    done = F.aggregate(F.array_sort(spans), zero, step)
    return F.when(F.size(spans) > 0, F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))).otherwise(text)


def without_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", mask: str = "[secret]") -> DataFrame:
    """docs, all columns and rows, with every span of scan() replaced by mask; texts without one are unchanged.

    Every row is masked by its own spans, whatever its doc_id, which is not read. The rows are written once with their
    spans; a row without a mixed token is masked as it is read. Only rows with one wait for the owners of its hash, so of
    the texts only theirs are shuffled. Null texts stay null, a null owner is an owner by itself, and an empty table
    gives an empty result.
    """
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    body = F.coalesce(F.col(text), F.lit(""))
    held = docs.select(F.monotonically_increasing_id().alias("uid"), row, F.col(owner).cast("string").alias("owner"), _base(body).alias("base"), _spans(body, OWNED, 3, lambda m: m, _mixed).alias("extra"))
    held = cut(held.withColumn("extra", _apart()), "secrets")

    def masked(rows: DataFrame, spans: Column) -> DataFrame:
        return rows.select(*[redact(F.col("row")[c], spans, mask).alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])

    some = held.where(F.size("extra") > 0)
    spans = some.select("uid", F.explode("extra").alias("s")).withColumn("hash", F.col("s.hash"))
    single = ownership(held.select("uid", "owner", "base", "extra")).where("owners = 1").select("hash")
    live = spans.join(single, "hash", "left_semi").groupBy("uid").agg(F.collect_list("s").alias("live"))
    waited = some.join(live, "uid", "left").withColumn("live", F.coalesce("live", F.array().cast(f"array<{SPAN}>")))
    return masked(held.where(F.size("extra") == 0), F.col("base")).unionByName(masked(waited, F.concat("base", "live")))


def _duck_spans(kind: int, pattern: str, value: str, keep: str) -> str:
    parts = f"string_split(regexp_replace(translate(body, chr(65535), chr(65534)), '{pattern}', chr(65535) || '\\0' || chr(65535), 'g'), chr(65535))"
    return f"""(select doc_id, src, s.start as start, {kind} as kind, s.stop as stop, md5(s.v) as hash from (
        select doc_id, src, unnest(list_transform(range(2, len(p) + 1, 2), lambda i: {{'start': coalesce(list_sum(list_transform(p[1:i-1], lambda x: length(x))), 0)::int,
            'stop': list_sum(list_transform(p[1:i], lambda x: length(x)))::int, 'm': p[i], 'v': {value.format(m='p[i]')}}})) as s
        from (select doc_id, src, {parts} as p from docs)) where {keep.format(m='s.m', v='s.v')})"""


def oracle_sql() -> str:
    """DuckDB SQL for scan() over documents whose doc_ids are distinct, without all_spans."""
    q = lambda p: p.replace("'", "''")
    kinds = [
        _duck_spans(0, q(ASSIGN), f"regexp_extract({{m}}, '{q(ASSIGN)}', 2)", "length({v}) >= 12"),
        _duck_spans(1, q(ACCESS), "{m}", "length({m}) >= 18"),
        _duck_spans(2, q(HEX), "{m}", "true"),
        _duck_spans(3, q(OWNED), "{m}", "regexp_matches({m}, '[0-9]') and regexp_matches({m}, '[a-z]') and regexp_matches({m}, '[A-Z]') and len(list_distinct(string_split({m}, ''))) >= 12"),
    ]
    names = "['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop"
    return f"""
    with docs as (select doc_id, coalesce(source, chr(1) || doc_id) as src, coalesce(text, '') as body from documents),
    base as ({reduce(lambda a, b: f"{a} union all {b}", (f"select * from {k}" for k in kinds[:3]))}),
    extra as (select e.* from {kinds[3]} e where not exists (select 1 from base b where b.doc_id = e.doc_id and b.start < e.stop and e.start < b.stop)),
    every as (select * from base union all select * from extra),
    freq as (select hash, count(distinct src) as owners from every group by hash),
    told as (select e.*, owners from every e join freq using (hash) where kind < 3 or owners = 1),
    per_doc as (select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex, count(*) filter (kind = 3) as n_owned,
        count(*) filter (kind < 3 and owners = 1) as n_live, count(*) filter (kind < 3 and owners >= 3) as n_example,
        string_agg({names}, ',' order by start, kind) filter (kind < 3) as b, string_agg({names}, ',' order by start, kind) as spans from told group by doc_id)
    select docs.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(b, '')) as base_sha256,
        coalesce(spans, '') as spans, coalesce(n_owned, 0) as n_owned, coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example
    from docs left join per_doc using (doc_id)"""
