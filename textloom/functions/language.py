"""Language detection by voting and by rules, and the language filter banks.

The patterns are fixed values; braces are escaped so that Java and RE2 read them alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import any_of, matches, strip

# fixed values: voting patterns, in order of precedence
VOTES = {
    "typescript": [r"\binterface\b", r"\btype\s+[a-zA-Z]", r":\s*[a-zA-Z]"],
    "javascript": [r"\bfunction\b", r"\bconst\b", r"\blet\b", r"=>"],
    "xml": [r"<\?xml", r"<[a-zA-Z][^>]*>", r"</[a-zA-Z][^>]*>"],
    "html": [r"<!DOCTYPE", r"<html", r"<head", r"<body"],
    "css": [r"\{\s*", r"\}\s*", r"[a-zA-Z-]+\s*:\s*[^;]+;"],
    "mdx": [r"#{1,6}\s+", r"\*\*.*?\*\*", r"<[^>]+>"],
}

# fixed values: length bounds, required and exclusion patterns by language
BANK = {
    "javascript": (50, 50000, [r"\b(function|const|let|var|class|import|export)\b", r"[{}();]", r"[a-zA-Z_$][a-zA-Z0-9_$]*"], [r"console\.log\([^)]*\);?\s*$", r"//\s*$", r"/\*\s*\*/"]),
    "typescript": (50, 50000, [r"\b(function|const|let|var|class|interface|type|import|export)\b", r"[{}();:]", r"[a-zA-Z_$][a-zA-Z0-9_$<>,\[\]\s]*"], [r":\s*any\b", r"//\s*$"]),
    "xml": (30, 30000, [r"<\?xml[^>]*\?>", r"<[a-zA-Z][^>]*>", r"</[a-zA-Z][^>]*>", r"[a-zA-Z_][a-zA-Z0-9_\-]*="], [r"<[^>]*>[^<]*$", r">[^<]*<"]),
    "html": (
        100,
        40000,
        [r"<(!DOCTYPE|html|head|body|div|span|p|a|img|form|input)[^>]*>", r"</(html|head|body|div|span|p|a|img|form|input)[^>]*>", r"class\s*=\s*[\"'][^\"']*[\"']", r"id\s*=\s*[\"'][^\"']*[\"']"],
        [r"<[^>]*>[^<]*$", r"<[^>]*<[^>]*>"],
    ),
    "css": (50, 20000, [r"[a-zA-Z_-]+\s*\{", r"\}\s*[a-zA-Z_-]*\s*\{", r"[a-zA-Z-]+\s*:\s*[^;]+;", r"/*.*?\*/"], [r"\{\s*\}", r":\s*;"]),
    "mdx": (100, 30000, [r"#{1,6}\s+", r"\*\*.*?\*\*", r"\*.*?\*", r"```", r"<[^>]+>"], [r"^#{1,6}\s*$", r"```\s*$"]),
}
#: Exclusions that reject almost any markup; the corrected filter leaves them out.
OVERBROAD = {r"<[^>]*>[^<]*$", r">[^<]*<", r"```\s*$"}

COMPATIBLE = [("javascript", "typescript"), ("html", "xml"), ("js", "ts")]

# fixed values: the source filter's bank; size bounds are those of BANK
SOURCE_BANK = {
    "javascript": (BANK["javascript"][2], 3),
    "typescript": ([r"\b(function|const|let|var|class|interface|type|import|export)\b", r"[{}();:]", r"[a-zA-Z_$][a-zA-Z0-9_$<>,\s]*"], 4),
    "xml": (BANK["xml"][2], 3),
    "html": ([r"<(!DOCTYPE|html|head|body|div|span|p)[^>]*>", r"</(html|head|body|div|span|p|a|img|form|input)>", r"class\s*=\s*[\"'][^\"']*[\"']", r"id\s*=\s*[\"'][^\"']*[\"']"], 3),
    "css": (BANK["css"][2], 2),
}
LICENSES = ["mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "unlicense"]


def detect_language(content: Column, metadata: Column) -> Column:
    """PRJ2: the first language with two pattern votes, else the metadata's, else 'unknown'."""
    out = None
    for language, patterns in VOTES.items():
        voted = matches(content, patterns, "(?iu)") >= 2
        out = F.when(voted, language) if out is None else out.when(voted, language)
    return out.otherwise(F.coalesce(metadata, F.lit("unknown")))


def detect_by_rules(code: Column) -> Column:
    """PRJ3: substring rules of the synthetic generator."""
    bare = strip(code)
    return (
        F.when(any_of(code, ["interface", "type "]), "typescript")
        .when(any_of(code, ["function", "const "]), "javascript")
        .when(bare.startswith("<") & code.contains("</"), "html")
        .when(any_of(code, ["<?xml", "<configuration>"]), "xml")
        .otherwise("javascript")
    )


def compatible(a: Column, b: Column) -> Column:
    """PRJ4: the three compatible pairs, either way round."""
    pair = F.array_sort(F.array(a, b))
    return F.array_contains(F.array(*(F.array(*(F.lit(x) for x in sorted(p))) for p in COMPATIBLE)), pair)


def passes_filter(content: Column, language: Column, corrected: bool = False) -> Column:
    """FLT1: required patterns (70 % of them), no exclusion, length bounds; others pass."""
    out = None
    for name, (low, high, required, exclusions) in BANK.items():
        exclusions = [x for x in exclusions if not (corrected and x in OVERBROAD)]
        enough = matches(content, required) * 10 >= len(required) * 7
        clean = matches(content, exclusions, "(?m)(?d)") == 0 if exclusions else F.lit(True)
        ok = enough & clean & F.length(content).between(low, high)
        out = F.when(language == name, ok) if out is None else out.when(language == name, ok)
    return out.otherwise(F.lit(True))


def permissive(license: Column) -> Column:
    """FLT16."""
    return F.coalesce(F.lower(license).isin(LICENSES), F.lit(False))


def passes_source_filter(content: Column, language: Column, license: Column, size: Column) -> Column:
    """FLT2: length, license, enough patterns, size; languages without a bank pass."""
    out = None
    for name, (patterns, least) in SOURCE_BANK.items():
        low, high = BANK[name][:2]
        ok = F.length(content).between(low, high) & permissive(license) & (matches(content, patterns, "(?miu)(?d)") >= least) & (F.coalesce(size, F.lit(0)) <= high)
        out = F.when(language == name, ok) if out is None else out.when(language == name, ok)
    return out.otherwise(F.lit(True))
