"""Checks that need a parser or a stack. Brackets are folded in the JVM; XML, HTML and Python
parsers of the standard library run over Arrow batches, on the rows that need them.

A null text gives null fields. A text that a parser refuses, for whatever reason, is not well
formed or not valid, with counts of 0; no input ends a task.
"""

from __future__ import annotations

import ast
import json
import warnings
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: tags that a page must have, and that it should not have
REQUIRED = ["html", "head", "title", "body"]
DEPRECATED = ["font", "center", "big", "blink"]

XML_SCHEMA = "well_formed boolean, elements int, depth int, attributes boolean, character_issues int"
HTML_SCHEMA = "valid boolean, tags int, has_head boolean, has_body boolean, missing array<string>, deprecated array<string>, compliant boolean"


def matched(c: Column) -> Column:
    """SCO22: every closing bracket closes the last open one. The open ones are a string, which is
    null from the first bracket on that does not match."""
    brackets = F.regexp_extract_all(c, F.lit(r"[()\[\]{}]"), F.lit(0))

    def step(held: Column, b: Column) -> Column:
        last = F.right(held, F.lit(1)) == F.translate(b, ")]}", "([{")
        return F.when(b.isin("(", "[", "{"), F.concat(held, b)).when(last, F.left(held, F.length(held) - 1))

    return F.when(c.isNotNull(), F.coalesce(F.aggregate(brackets, F.lit(""), step) == "", F.lit(False)))


def _tree(text: str) -> ElementTree.Element | None:
    """The root, None where the text is not well formed. Entities are not declared: they may explode."""
    try:
        return None if "<!ENTITY" in text else ElementTree.fromstring(text)
    except (ElementTree.ParseError, ValueError, RecursionError):
        return None


def xml_detail(text: str) -> tuple[bool, int, int, bool, int]:
    """SCO25: well formed, elements, depth below the root, whether the root has attributes, and
    elements whose text has control characters."""
    if (root := _tree(text)) is None:
        return False, 0, 0, False, 0
    n, depth, issues, level = 0, -1, 0, [root]
    while level:
        n, depth = n + len(level), depth + 1
        issues += sum(any(ord(k) < 32 and k not in "\t\n\r" for k in x.text or "") for x in level)
        level = [y for x in level for y in x]
    return True, n, depth, len(root.attrib) > 0, issues


class _Tags(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.tags: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags.append(tag)


def html_detail(text: str) -> tuple[bool, int, bool, bool, list[str], list[str], bool]:
    """SCO27: valid, tags, head and body, required tags that are missing, deprecated ones, compliant."""
    p = _Tags()
    try:
        p.feed(text)
        p.close()
    except (AssertionError, ValueError):
        return False, 0, False, False, [], [], False
    tags = set(p.tags)
    missing, old = [t for t in REQUIRED if t not in tags], [t for t in DEPRECATED if t in tags]
    return True, len(p.tags), "head" in tags, "body" in tags, missing, old, not missing and not old


def python_parses(text: str) -> bool:
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            ast.parse(text)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False
    return True


def json_parses(text: str) -> bool:
    try:
        json.loads(text)
    except (ValueError, RecursionError):
        return False
    return True


def _per_batch(function, schema: str, column: Column) -> Column:
    """A scalar Arrow UDF; it is made on use, for its schema is parsed by a session."""

    def flags(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else function(t)).astype("object")

    def structs(texts: pd.Series) -> pd.DataFrame:
        names = [f.strip().split()[0] for f in schema.split(",")]
        return pd.DataFrame([(None,) * len(names) if t is None else function(t) for t in texts], columns=names, dtype="object")

    return F.pandas_udf(flags if " " not in schema else structs, schema)(column)


def xml_details(c: Column) -> Column:
    return _per_batch(xml_detail, XML_SCHEMA, c)


def html_details(c: Column) -> Column:
    return _per_batch(html_detail, HTML_SCHEMA, c)


def parses_as(c: Column, kind: str) -> Column:
    """Whether the text parses as xml, python or json."""
    return _per_batch({"xml": lambda t: _tree(t) is not None, "python": python_parses, "json": json_parses}[kind], "boolean", c)


def parsed(df: DataFrame, content: str = "content", language: str = "found") -> DataFrame:
    """``df`` with well_formed: whether a text whose language is xml parses; null for others, whose
    texts do not go to Python."""
    return df.withColumn("well_formed", parses_as(F.when(F.col(language) == "xml", F.col(content)), "xml"))
