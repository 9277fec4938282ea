"""DuckDB expressions that the oracles are put together from."""

from __future__ import annotations

TOKEN = r"[\p{L}\p{N}_]+"
SPACE = r"[\s\x1c-\x1f\x{85}\x{a0}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def count(x: str, part: str) -> str:
    return f"((length({x}) - length(replace({x}, {q(part)}, ''))) // {len(part)})"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{SPACE}+|{SPACE}+$')}, '', 'g')"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {q(TOKEN)})"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


def lines(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda r: {strip('r')}), lambda r: r <> '')"


def rlike(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def matches(x: str, patterns: list[str], flags: str = "") -> str:
    return "(" + " + ".join(f"{rlike(x, flags + p)}::INT" for p in patterns) + ")"


def hits(x: str, parts: list[str]) -> str:
    return "(" + " + ".join(f"contains({x}, {q(p)})::INT" for p in parts) + ")"


def any_of(x: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(p)})" for p in parts) + ")"


def one_of(x: str, words: list[str]) -> str:
    return f"{x} IN ({', '.join(map(q, words))})"


def size(x: str) -> str:
    return f"len({x})"


def balanced(x: str, a: str, b: str) -> str:
    return f"({count(x, a)} = {count(x, b)})"


def mean(*parts: str) -> str:
    return "((" + " + ".join(f"({p})::DOUBLE" for p in parts) + f") / {len(parts)})"


def case(*arms: tuple[str, str], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {a} THEN {b}" for a, b in arms) + f" ELSE {other} END"


def draw(*parts: str) -> str:
    """A uniform number from 0 to 1, from the md5 of the parts."""
    return f"(('0x' || substr(md5({' || '.join(parts)}), 1, 8))::UBIGINT::DOUBLE / 4294967296.0)"
