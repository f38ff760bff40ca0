"""Source code blocks: what Python code defines, whether it parses, and code gathered by language."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFINITIONS = "array<struct<kind:string,name:string,parent:string,parameters:array<string>,docstring:string,line:int>>"


def _definitions(code: str | None) -> list[dict] | None:
    try:
        found, todo = [], [(None, ast.parse(code or ""))]
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return None
    while todo:
        parent, node = todo.pop()
        for child in ast.iter_child_nodes(node):
            inner = parent
            if isinstance(child, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                is_class = isinstance(child, ast.ClassDef)
                a = None if is_class else child.args
                names = [] if a is None else [x.arg for x in (*a.posonlyargs, *a.args, *filter(None, [a.vararg]), *a.kwonlyargs, *filter(None, [a.kwarg]))]
                found.append({"kind": "class" if is_class else "function", "name": child.name, "parent": parent, "parameters": names, "docstring": ast.get_docstring(child), "line": child.lineno})
                inner = child.name
            todo.append((inner, child))
    return sorted(found, key=lambda d: d["line"])


def python_definitions(code: Column) -> Column:
    """Functions and classes of Python code in order of lines, with what encloses them, parameters and docstrings; null where it doesn't parse, and empty for null."""

    @F.pandas_udf(DEFINITIONS)
    def definitions(codes: pd.Series) -> pd.Series:
        return codes.map(_definitions)

    return definitions(code)


def _problem(code: str | None) -> str | None:
    try:
        ast.parse(code or "")
    except SyntaxError as e:
        return f"line {e.lineno}: {e.msg}"
    except (ValueError, RecursionError, MemoryError) as e:
        return str(e)
    return None


def python_error(code: Column) -> Column:
    """Why Python code doesn't parse, or null."""

    @F.pandas_udf("string")
    def problems(codes: pd.Series) -> pd.Series:
        return codes.map(_problem)

    return problems(code)


def by_language(blocks: DataFrame, doc: list[str], order: str = "block_ord") -> DataFrame:
    """(doc, language, n_blocks, code): a document's code blocks of each language, in order, between blank lines. No language counts as text."""
    code = blocks.where("block_type = 'Code'").withColumn("language", F.coalesce(F.nullif(F.col("language"), F.lit("")), F.lit("text")))
    texts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce("text", F.lit("")).alias("t")))), lambda r: r["t"])
    return code.groupBy(*doc, "language").agg(F.count("*").alias("n_blocks"), F.array_join(texts, "\n\n").alias("code"))
