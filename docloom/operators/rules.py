"""Decisions by rule: document types, code and mathematics, routes, recommendations. Each is one Column expression."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that tell a document's type, in order of precedence.
DOCUMENT_TYPES = {
    "research_paper": ["abstract", "methodology", "conclusion", "references"],
    "invoice": ["invoice", "bill", "payment", "due date"],
    "legal_contract": ["contract", "agreement", "terms", "parties"],
    "business_report": ["report", "executive summary", "findings"],
    "technical_manual": ["manual", "installation", "troubleshooting"],
}

#: Patterns of programming languages: (language, weight, patterns). The share of patterns found, times the weight, is a score.
CODE_PATTERNS = [
    ("python", 1.0, [r"\bdef \w+\(", r"\bimport \w+", r"\bself\b", r":\s*$", r"\bclass \w+.*:", r"\bNone\b|\bTrue\b|\bFalse\b"]),
    ("java", 1.0, [r"\bpublic (class|static|void)\b", r"\bSystem\.out\b", r"\bnew \w+\(", r";\s*$", r"\bimport java"]),
    ("c", 0.9, [r"#include\s*<", r"\bint main\(", r"\bprintf\(", r"\bvoid\b", r";\s*$"]),
    ("go", 1.0, [r"\bfunc \w*\(", r"\bpackage \w+", r":=", r"\bfmt\.\w+"]),
    ("rust", 1.0, [r"\bfn \w+\(", r"\blet mut\b", r"->\s*\w+", r"\bimpl\b", r"println!"]),
]
SQL_WORDS = ["select", "from", "where", "insert", "update", "delete", "create", "join"]


def _any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))


def document_type(text: Column) -> Column:
    low = F.lower(text)
    out = F.lit("general_document")
    for name, words in reversed(DOCUMENT_TYPES.items()):
        out = F.when(_any(low, words), name).otherwise(out)
    return out


def code_language(text: Column) -> Column:
    """(language, confidence): sure signs first, in order, then the best share of a language's patterns; text where none has any."""
    low = F.lower(text)
    n_sql = reduce(add, (low.rlike(rf"\b{w}\b").cast("int") for w in SQL_WORDS))
    scores = []
    for name, weight, patterns in CODE_PATTERNS:
        share = reduce(add, (text.rlike(f"(?m){p}").cast("double") for p in patterns)) / len(patterns)
        scores.append(F.struct(F.least(F.lit(0.95), share * weight * F.when(share > 0.3, 1.2).otherwise(1.0)).alias("confidence"), F.lit(name).alias("language")))
    best = F.array_max(F.array(*scores))
    sure = lambda name, c: F.struct(F.lit(name).alias("language"), (F.lit(c) if not isinstance(c, Column) else c).cast("double").alias("confidence"))
    return (
        F.when(F.trim(text).rlike(r"^[\[{]") & F.try_parse_json(text).isNotNull(), sure("json", 0.9)).when(F.trim(text).rlike(r"^(<\?xml|<\w+[^>]*>)"), sure("xml", 0.9))
        .when(text.rlike(r"\bdef \w+\(.*\)\s*->") | text.rlike(r"\bfrom typing import\b"), sure("python", 0.95)).when(n_sql >= 2, sure("sql", F.least(F.lit(1.0), n_sql / 3)))
        .when(text.rlike(r"^#!.*\b(ba)?sh\b") | text.rlike(r"(?m)^\s*(echo|export|sudo) "), sure("bash", 0.85)).when(text.rlike(r"\binterface \w+\s*\{|: (string|number|boolean)\b"), sure("typescript", 0.85))
        .when(text.rlike(r"\b(const|let|var) \w+\s*=|=>|\bfunction\b"), sure("javascript", 0.85)).when(best["confidence"] > 0, F.struct(best["language"].alias("language"), best["confidence"].alias("confidence")))
        .otherwise(sure("text", 0.0))
    )


def flags_met(*flags: Column) -> Column:
    return reduce(add, (F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))


def region_type(base: Column, code_flags: list[Column], math_flags: list[Column]) -> Column:
    """code where two of its flags are set, else math where two of its are, else what the layout says."""
    return F.when(flags_met(*code_flags) >= 2, "code").when(flags_met(*math_flags) >= 2, "math").otherwise(base)


def math_complexity(text: Column, confidence: Column) -> Column:
    points = lambda test, p: F.when(test, F.lit(p)).otherwise(F.lit(0.0))
    score = (
        points(F.contains(text, F.lit("\n")), 0.3) + points(_any(text, ["\\begin{", "\\matrix", "\\array"]), 0.4) + points(_any(text, ["\\int", "\\sum", "\\prod"]), 0.3)
        + points(_any(text, ["\\newcommand", "\\def"]), 0.5) + points(confidence < 0.8, 0.3)
    )
    return F.least(F.lit(1.0), score)


def route(block_type: Column, complexity: Column, math: float = 0.7, table: float = 0.6, code: float = 0.5) -> Column:
    """Which processor takes a block: a model beyond its type's threshold, else the default."""
    return (
        F.when((block_type == "Equation") & (complexity >= math), "model").when((block_type == "Table") & (complexity >= table), "model")
        .when((block_type == "Code") & (complexity >= code), "model_iterative").otherwise("default")
    )


def table_image_complexity(width: Column, height: Column, n_cells: Column, has_spans: Column, has_nested: Column) -> Column:
    """Struct (score, factors, needs_model) of a table's picture: a model takes over beyond 0.3. What is null adds nothing."""
    tests = [("large_size", (height > 500) | (width > 800), 0.2), ("high_cell_count", n_cells > 30, 0.2), ("merged_cells", has_spans, 0.3), ("nested_structure", has_nested, 0.3)]
    score = F.round(reduce(add, (F.when(test, F.lit(points)).otherwise(F.lit(0.0)) for _, test, points in tests)), 6)
    factors = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test, _ in tests]))
    return F.struct(F.least(score, F.lit(1.0)).alias("score"), factors.alias("factors"), (score > 0.3).alias("needs_model"))


def recommended_config(available: Column, responsive: Column, memory_gb: Column, cores: Column, cpu_usage: Column, load: Column, disk_gb: Column) -> Column:
    """Which set of model features a machine should run."""
    return (
        F.when(~available | ~responsive | (memory_gb < 4), "disabled").when((memory_gb < 8) | (cores < 4), "minimal").when((cpu_usage > 80) | (load == "high"), "tables_only")
        .when(disk_gb < 2, "minimal").when((memory_gb >= 16) & (cores >= 8) & (cpu_usage < 50), "accuracy").when((memory_gb >= 12) & (cores >= 6), "tables_only").otherwise("minimal")
    )


def reward(accuracy: Column, seconds: Column, requirement: Column, resource: Column, coverage: Column | None = None) -> Column:
    """Weighted reward of a strategy's outcome, halved where it misses its requirement."""
    met = (accuracy >= requirement).cast("double")
    complete = F.coalesce(coverage, F.lit(0.8)) if coverage is not None else F.lit(0.8)
    whole = 0.35 * accuracy + 0.25 * (1 - F.least(F.lit(1.0), seconds / 10)) + 0.25 * met + 0.10 * (1 - resource) + 0.05 * complete
    return whole * F.when(met == 1, 1.0).otherwise(0.5)
