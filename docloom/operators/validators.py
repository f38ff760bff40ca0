"""Content validators: each rule is a Column of struct (valid, error), found by name in a registry."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES: dict[str, Callable[..., Column]] = {}


def rule(f: Callable[..., Column]) -> Callable[..., Column]:
    """Register a rule under its name; a plug-in decorates its own the same way."""
    RULES[f.__name__] = f
    return f


def verdict(ok: Column, error: str | Column) -> Column:
    ok = F.coalesce(ok, F.lit(False))
    return F.struct(ok.alias("valid"), F.when(~ok, error if isinstance(error, Column) else F.lit(error)).alias("error"))


@rule
def present(value: Column) -> Column:
    return verdict(value.isNotNull() & (F.trim(value.cast("string")) != ""), "missing")


@rule
def length_between(value: Column, least: int = 0, most: int | None = None) -> Column:
    n = F.length(value)
    return verdict((n >= least) & (F.lit(True) if most is None else n <= most), F.format_string(f"length %d is not in {least} to {most}", F.coalesce(n, F.lit(0))))


@rule
def matches(value: Column, pattern: str) -> Column:
    """The pattern has to match from the start."""
    return verdict(value.rlike(f"^(?:{pattern})"), f"doesn't match {pattern}")


@rule
def in_range(value: Column, least: float, most: float) -> Column:
    return verdict(value.between(least, most), f"not in {least} to {most}")


@rule
def one_of(value: Column, values: list) -> Column:
    return verdict(value.isin(*values), f"not one of {values}")


@rule
def words_in(value: Column, corpus: list[str]) -> Column:
    known = F.array(*[F.lit(w.lower()) for w in corpus])
    extra = F.array_except(F.filter(F.split(F.lower(value), r"\s+"), lambda w: w != ""), known)
    return verdict(F.size(extra) == 0, F.concat(F.lit("not in the corpus: "), F.array_join(extra, ", ")))


@rule
def content_quality(value: Column, least_words: int = 10, least_sentences: int = 1, most_repeated: float = 0.5) -> Column:
    """Enough words and sentences, and no word making up most of the text."""
    words = F.filter(F.split(F.lower(value), r"\s+"), lambda w: w != "")
    n = F.size(words)
    distinct = F.size(F.array_distinct(words))
    return verdict((n >= least_words) & (F.regexp_count(value, F.lit(r"[.!?]")) >= least_sentences) & (distinct >= (1 - most_repeated) * n * 0.5), "too short or repetitive")


@rule
def json_fields(value: Column, fields: list[str]) -> Column:
    """Valid JSON with all the fields."""
    lacking = F.array_except(F.array(*map(F.lit, fields)), F.coalesce(F.json_object_keys(value), F.array().cast("array<string>")))
    return verdict(F.try_parse_json(value).isNotNull() & (F.size(lacking) == 0), F.concat(F.lit("lacks "), F.array_join(lacking, ", ")))


@rule
def balanced_latex(value: Column) -> Column:
    count = lambda s: (F.length(value) - F.length(F.replace(value, F.lit(s), F.lit("")))) / len(s)
    return verdict((count("{") == count("}")) & (count("\\begin") == count("\\end")) & (count("$") % 2 == 0), "unbalanced")


@rule
def alt_text(value: Column, least: int = 10, most: int = 125) -> Column:
    return verdict(F.length(value).between(least, most) & ~F.lower(value).rlike(r"^(an? )?(image|picture|photo) of"), "length or phrasing")


@rule
def citation(value: Column) -> Column:
    return verdict(value.rlike(r"\[\d+(,\s*\d+)*\]|\([A-Z][A-Za-z]+( et al\.)?,? \d{4}\)"), "no citation")


def apply_rules(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rows with a struct for each named rule, and valid: whether all hold."""
    out = rows.withColumns(rules)
    return out.withColumn("valid", reduce(lambda a, b: a & b, (F.col(n)["valid"] for n in rules)))


def report(rows: DataFrame, rules: list[str]) -> DataFrame:
    """(rule, n, n_valid) over rows that apply_rules() gave."""
    each = rows.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n)["valid"].alias("ok")) for n in rules])).alias("r"))
    return each.groupBy("r.rule").agg(F.count("*").alias("n"), F.count_if("r.ok").alias("n_valid"))


# Acceptance of a model's rewrite: (old text, new text) to boolean.
ACCEPT: dict[str, Callable[[Column, Column], Column]] = {
    "complex_region": lambda old, new: ~F.lower(new).contains("no corrections") & (F.length(new) >= 0.5 * F.length(old)),
    "equation": lambda old, new: (F.length(new) > 0.3 * F.length(old)) & (F.regexp_count(new, F.lit("<math")) == F.regexp_count(new, F.lit("</math>"))),
    "form": lambda old, new: ~F.lower(new).contains("no corrections") & (F.length(new) >= 0.33 * F.length(old)),
    "handwriting": lambda old, new: F.length(new) >= 0.5 * F.length(old),
    "math_block": lambda old, new: ~F.lower(new).contains("no corrections needed") & (F.length(new) >= 0.6 * F.length(old)),
    "table": lambda old, new: new.endswith("</table>") & (F.length(F.regexp_replace(new, "<[^>]*>", "")) >= 0.5 * F.length(F.regexp_replace(old, "<[^>]*>", ""))),
    "image": lambda old, new: F.length(new) >= 10,
}


def rewrite(blocks: DataFrame, kind: str, select: Column, model: Callable[[Column], Column], text: str = "text") -> DataFrame:
    """blocks with texts that select picks replaced by the model's where its rule accepts them, and rejected marking the others.

    model takes the text Column and gives another: a pandas UDF around a service, or an expression in tests.
    """
    new = F.when(select, model(F.col(text)))
    out = blocks.withColumn("_new", new)
    ok = F.coalesce(ACCEPT[kind](F.col(text), F.col("_new")), F.lit(False))
    return out.withColumns({text: F.when(ok, F.col("_new")).otherwise(F.col(text)), "rejected": select & ~ok}).drop("_new")
