"""Text primitives as Columns: counts, tokens, Python-compatible stripping.

Tokens are runs of letters, digits and underscores in any script, which Spark and DuckDB cut alike.
"""

from __future__ import annotations

import re
from functools import reduce
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{N}_]+"
SPACE = r"[\s\x1c-\x1f\x85\xa0]"
#: The same characters one by one, for trims, which read a text's ends only.
SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
#: No token character before, or after.
BEFORE, AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
NAME = BEFORE + r"[a-zA-Z_][a-zA-Z0-9_]*+" + AFTER


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def count(text: Column, part: str) -> Column:
    """How often ``part`` occurs, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def words(text: Column) -> Column:
    """Parts between white space."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def lines(text: Column) -> Column:
    """Stripped lines that are not blank."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")


def any_of(text: Column, parts: list[str]) -> Column:
    return reduce(Column.__or__, [text.contains(p) for p in parts])


def hits(text: Column, parts: list[str]) -> Column:
    """How many of ``parts`` the text contains."""
    return reduce(Column.__add__, [text.contains(p).cast("int") for p in parts])


def found(text: Column, pattern: str, needs: str = "") -> Column:
    """Whether ``pattern`` is found; texts without ``needs``, a part of every match, are not searched."""
    return text.contains(needs) & text.rlike(pattern) if needs else text.rlike(pattern)


def times(text: Column, pattern: str, *needs: str) -> Column:
    """How often ``pattern`` occurs; texts without any of ``needs`` are not searched."""
    n = F.regexp_count(text, F.lit(pattern))
    return F.when(any_of(text, list(needs)), n).otherwise(0) if needs else n


def matches(text: Column, patterns: list[str], flags: str = "") -> Column:
    """How many of ``patterns`` are found in the text."""
    return reduce(Column.__add__, [found(text, flags + p, needed(p, "i" in flags)).cast("int") for p in patterns])


def needed(pattern: str, any_case: bool = False) -> str:
    """The longest run of characters that stands in every match of a pattern, as far as its top
    level shows it; without letters where case does not count."""
    try:
        parts = _parser.parse(pattern)
    except re.error:  # written in a way that only Java reads
        return ""
    runs = [""]
    for kind, value in parts:
        literal = str(kind) == "LITERAL" and not (any_case and chr(value).isalpha())
        runs += [runs.pop() + chr(value)] if literal else [""]
    return max(runs, key=len)


def mean(*parts: Column) -> Column:
    return reduce(Column.__add__, [p.cast("double") for p in parts]) / len(parts)


def balanced(text: Column, a: str, b: str) -> Column:
    return count(text, a) == count(text, b)
