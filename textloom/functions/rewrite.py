"""Rewrites of code as Columns: special tokens, normalisation for matching, function extraction."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, bind, matches, needed, strip

# fixed values: what each special token stands for, in the order in which texts are rewritten
SPECIAL = [
    ("<xml_tag>", r"<[^/\s][^>]*>"),
    ("</xml_tag>", r"</[^>]+>"),
    ("<xml_self>", r"<[^/>]+/>"),
    ("<js_func>", r"function\s+[\p{L}\p{N}_]+\s*\([^)]*\)\s*\{"),
    ("<js_var>", r"(?:var|let|const|const)\s+[\p{L}\p{N}_]+"),
    ("<code_string>", "[\"'`][^\"']*[\"'`]"),
    ("<code_comment>", r"(?://[^\n]*)|(/\*.*?\*/)"),
    ("<css_sel>", r"[.#]?[\p{L}\p{N}_-]+\s*\{"),
    ("<css_prop>", r"[\p{L}\p{N}_]+\s*:\s*[^;]+;"),
    ("<mdx_comp>", r"<[A-Z][a-zA-Z0-9_]*[^/>]*>"),
]
# fixed values: marks of code, which keeps its case
CODE = [r"function\s*\(", r"class\s+[\p{L}\p{N}_]+", r"\{[^}]*\}", r"</?[\p{L}\p{N}_]+[^>]*>", r"const\s+[\p{L}\p{N}_]+", r"let\s+[\p{L}\p{N}_]+", r"var\s+[\p{L}\p{N}_]+", r"import\s+", r"export\s+"]


def special_tokens(c: Column) -> Column:
    """PRJ12: each rewrite sees what the ones before it have put in, as the order says."""
    for token, pattern in SPECIAL:
        mark = needed(pattern) or {"<js_func>": "function", "<code_comment>": "/", "<js_var>": " "}.get(token, "")
        c = bind(c, _rewrite(pattern, f" {token} ", mark))
    return c


def _rewrite(pattern: str, by: str, mark: str) -> Callable[[Column], Column]:
    """Of a text with ``mark`` all matches replaced; others have none."""
    return lambda x: F.when(x.contains(mark), F.regexp_replace(x, f"(?d){pattern}", by)).otherwise(x)


def is_code(c: Column) -> Column:
    return matches(c, CODE) > 0


def normalised(c: Column, lower: bool = False) -> Column:
    """PRJ13: special tokens, one space; lower case where asked for and the text is no code."""
    bare = F.regexp_replace(special_tokens(c), f"{SPACE}+", " ")
    return strip(bind(bare, lambda x: F.when(is_code(x), x).otherwise(F.lower(x))) if lower else bare)


def renamed(c: Column) -> Column:
    """PRJ7: no comments, one space, identifiers as var_k by first occurrence, lower case."""
    c = F.regexp_replace(c, r"//.*?\n", "\n")
    c = F.regexp_replace(c, r"(?s)/\*.*?\*/", "")
    c = F.regexp_replace(c, f"{SPACE}+", " ")

    return F.lower(strip(F.pandas_udf(_numbered, "string")(c)))


IDENTIFIER = re.compile(r"\b[a-zA-Z_][a-zA-Z0-9_]*\b")


def _numbered(texts: pd.Series) -> pd.Series:
    """Identifiers by first occurrence, one dictionary a text: arrays in the JVM would be searched anew
    for every word, which long texts do not bear."""

    def number(text: str) -> str:
        known: dict[str, str] = {}
        return IDENTIFIER.sub(lambda m: known.setdefault(m[0], f"var_{len(known)}"), text)

    return pd.Series([None if t is None else number(t) for t in texts], dtype="object")


def extract_function(completion: str, entry_point: str) -> str:
    """PRJ19: the function of that name: in Python to where the indentation ends, in JavaScript to
    its last brace; the whole text where there is none."""
    name = re.escape(entry_point)
    if m := re.search(rf"def\s+{name}\s*\([^)]*\)\s*:", completion, re.IGNORECASE):
        first, *rest = completion[m.start() :].split("\n")
        indent, body = len(first) - len(first.lstrip()), []
        for line in rest:
            if line.strip() and len(line) - len(line.lstrip()) <= indent and not line.strip().startswith("def "):
                break
            body.append(line)
        return "\n".join([first, *body]) if body else first + "\n"
    for pattern in (rf"function\s+{name}\s*\([^)]*\)\s*\{{", rf"{name}\s*=\s*function\s*\([^)]*\)\s*\{{"):
        if m := re.search(pattern, completion, re.IGNORECASE):
            code, depth = completion[m.start() :], 0
            for b in re.finditer(r"[{}]", code):
                depth += 1 if b[0] == "{" else -1
                if depth == 0:
                    return code[: b.end()]
            return code
    return completion


def extracted(completion: Column, entry_point: Column) -> Column:
    """PRJ19 over Arrow batches; a null stays null."""

    def run(texts: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([None if t is None or n is None else extract_function(t, n) for t, n in zip(texts, names, strict=True)], dtype="object")

    return F.pandas_udf(run, "string")(completion, entry_point)
