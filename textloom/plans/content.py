"""Queries of projections, filters and scores over contents, with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import language as L
from ..functions import scores as S
from ..operators.markup import parsed
from . import duck as D
from .inputs import CONTENTS, PAIRS, contents, pairs, parses

Query = Callable[[SparkSession, str], DataFrame]


def _votes() -> str:
    arms = [(f"{D.matches('content', ps, '(?i)')} >= 2", f"'{name}'") for name, ps in L.VOTES.items()]
    return D.case(*arms, other="language")


def _bank(corrected: bool) -> str:
    arms = []
    for name, (low, high, required, exclusions) in L.BANK.items():
        exclusions = [x for x in exclusions if not (corrected and x in L.OVERBROAD)]
        clean = f"{D.matches('content', exclusions, '(?m)')} = 0" if exclusions else "true"
        arms.append((f"found = '{name}'", f"({D.matches('content', required)} * 10 >= {7 * len(required)} AND {clean} AND length(content) BETWEEN {low} AND {high})"))
    return D.case(*arms, other="true")


def _source() -> str:
    arms = []
    for name, (patterns, least) in L.SOURCE_BANK.items():
        low, high = L.BANK[name][:2]
        arms.append((f"found = '{name}'", f"(length(content) BETWEEN {low} AND {high} AND lower(license) IN ({', '.join(map(D.q, L.LICENSES))}) AND {D.matches('content', patterns, '(?mi)')} >= {least} AND length(content) <= {high})"))
    return D.case(*arms, other="true")


C = "content"
_LOW = "lower(content)"
_IND = (
    f"({D.size(f'list_filter({D.tokens(C)}, lambda x: {D.one_of("x", ["function", "class", "for", "while"])})')} + {D.size(f'list_filter({D.tokens(C)}, lambda x: starts_with(x, {D.q("if")}))')}"
    f" + {D.size(f'list_filter({D.tokens(C)}, lambda x: ends_with(x, {D.q("case")}))')} + {D.count(C, 'else')} + {D.count(C, 'switch')})"
)
_NAME = r"^[a-zA-Z_][a-zA-Z0-9_]*$"


def _length() -> str:
    arm = lambda low, high: D.case((f"n BETWEEN {low} AND {high}", "1.0"), (f"n < {low}", f"n / {low}.0"), other=f"{high}.0 / n")
    return D.case((f"starts_with({D.strip(C)}, '<')", arm(100, 10000)), (D.any_of(C, ["function", "class"]), arm(100, 5000)), other=arm(50, 2000)).replace("n BETWEEN", "length(content) BETWEEN").replace("n <", "length(content) <").replace("THEN n /", "THEN length(content) /").replace("/ n ", "/ length(content) ")


def _structure() -> str:
    more = f"{D.hits(C, ['function', 'class'])}"
    markup = f"starts_with({D.strip(C)}, '<')"
    ok = " + ".join(f"{D.balanced(C, a, b)}::INT" for a, b in ("{}", "()", "[]"))
    return f"(({ok} + {more} + ({markup} AND contains(content, '>'))::INT)::DOUBLE / (3 + {more} + {markup}::INT))"


def _complexity() -> str:
    t = D.tokens(_LOW)
    waits = f"{D.size(f'list_filter({t}, lambda x: starts_with(x, {D.q("async")}))')} + {D.size(f'list_filter({t}, lambda x: ends_with(x, {D.q("promise")}))')} + {D.count(_LOW, 'await')}"
    n = f"({D.size(f'list_filter({D.tokens(C)}, lambda x: {D.rlike("x", _NAME)})')} + {_IND} + {waits})::DOUBLE"
    return D.case(("n = 0", "0.5"), ("n BETWEEN 5 AND 50", "1.0"), ("n < 5", "n / 5"), other="greatest(0.3, 50 / n)").replace("n ", f"({n}) ").replace("n)", f"({n}))")


def _consistency() -> str:
    pair = " OR ".join(f"(language = '{a}' AND found = '{b}') OR (language = '{b}' AND found = '{a}')" for a, b in L.COMPATIBLE)
    return D.case(("language = 'unknown'", "0.8"), ("language = found", "1.0"), (pair, "0.8"), other="0.3")


def _richness() -> str:
    bare = f"regexp_replace(regexp_replace(content, {D.q('[{}();,:=<>\"' + chr(39) + ']')}, ' ', 'g'), {D.q(r'[\p{L}\p{N}_]+\.([\p{L}\p{N}_]+|\*)')}, ' ', 'g')"
    t = D.tokens(f"lower({bare})")
    s = f"list_filter({t}, lambda x: NOT ({D.one_of('x', [*S.STOP_WORDS, *S.PROGRAM_WORDS])}))"
    return D.case((f"len({t}) < 3", "0.3"), (f"len({s}) < 3", "0.4"), other=f"(len(list_distinct({s}))::DOUBLE / len({s}) + len({s})::DOUBLE / len({t})) / 2")


def _js() -> str:
    weights = ((r"\bfunction\b.*\(.*\)\s*\{", 0.9), (r"const\s+\w+\s*=", 0.8), (r"=>\s*\{", 0.8), (r"class\s+\w+", 0.8))
    return f"({D.mean(*(D.balanced(C, a, b) + '::INT' for a, b in ('{}', '()', '[]')))} + least(1.0, {' + '.join(f'{D.rlike(C, p)}::INT * {w}' for p, w in weights)})::DOUBLE) / 2"


def _ts() -> str:
    notes = f"{D.matches(C, [r':\s*[a-zA-Z_$][a-zA-Z0-9_$<>,\[\]\s\|&]*', r':\s*\{[^}]*\}', r':\s*\[[^\]]*\]'])} > 0"
    checks = [("contains(content, 'interface')", D.rlike(C, r"interface\s+\w+\s*\{")), ("contains(content, 'type ')", D.rlike(C, r"type\s+\w+\s*=")), ("contains(content, ':')", notes)]
    n = " + ".join(f"{a}::INT" for a, _ in checks)
    k = " + ".join(f"({a} AND {b})::INT" for a, b in checks)
    return D.case((f"({n}) > 0", f"(({_js()}) + ({k})::DOUBLE / ({n})) / 2"), other=f"({_js()}) * 0.9")


_XML = D.mean(f"starts_with({D.strip(C)}, '<')::INT", D.balanced(C, "<", ">") + "::INT", f"(NOT {D.rlike(C, r'<[^>]*<[^>]*>')})::INT")
_HTML = D.mean(f"(starts_with({D.strip(C)}, '<!DOCTYPE') OR starts_with({D.strip(C)}, '<html'))::INT", D.balanced(C, "<", ">") + "::INT", D.rlike(C, "(?i)<html[^>]*>") + "::INT", D.rlike(C, "(?i)</html>") + "::INT")
_CSS = D.mean(D.balanced(C, "{", "}") + "::INT", D.rlike(C, r"[a-zA-Z_-]+\s*\{") + "::INT", D.rlike(C, r"[a-zA-Z-]+\s*:\s*[^;]+;") + "::INT")


def _syntax(parser: bool = False) -> str:
    xml = D.case((parses("xml"), "1.0"), other=_XML) if parser else _XML
    return D.case(("found = 'javascript'", _js()), ("found = 'typescript'", _ts()), ("found = 'xml'", xml), ("found = 'html'", _HTML), ("found = 'css'", _CSS), other="0.8")


def _flow() -> str:
    rows = D.lines(C)
    hit = f"list_transform({rows}, lambda x: {D.matches('x', ['^import|^from', '^const|^let|^var', '^function', r'^\s*\}'], '(?i)')} / 4.0)"
    return D.case((f"len({rows}) < 3", "0.5"), other=f"list_sum({hit}) / len({rows})")


def _naming() -> str:
    names = f"list_filter({D.tokens(C)}, lambda x: {D.rlike('x', _NAME)} AND NOT ({D.one_of('lower(x)', S.NAMING_KEYWORDS)}) AND length(x) > 2)"
    good = f"list_transform({names}, lambda x: {D.rlike('x', '^[a-z]+([A-Z][a-z]*)*$')}::INT + (contains(x, '_') AND x = lower(x) AND {D.rlike('x', '[a-z]')})::INT)"
    return D.case((f"len({names}) < 3", "0.5"), other=f"list_sum({good})::DOUBLE / len({names})")


def _indent() -> str:
    rows = f"list_filter(string_split(content, chr(10)), lambda x: {D.strip('x')} <> '')"
    depths = f"list_distinct(list_transform({rows}, lambda x: length(x) - length(regexp_replace(x, {D.q(f'^{D.SPACE}+')}, ''))))"
    return D.case((f"len({rows}) < 3", "0.5"), (f"len({depths}) <= 4", "1.0"), (f"len({depths}) <= 8", "0.7"), other="0.4")


def _group() -> str:
    density = f"(({D.count(C, '{')} + {D.count(C, '}')} + len(regexp_extract_all(content, {D.q('(?m);\\s*$')})))::DOUBLE / (nullif(length(content), 0) / 100.0))"
    return D.case(("length(content) = 0", "0.5"), (f"{density} BETWEEN 2 AND 20", "1.0"), (f"{density} < 2", "0.6"), other="0.7")


def _rationality() -> str:
    return D.mean(_indent(), D.balanced(C, "{", "}") + "::INT", _group())


def _vcoherence() -> str:
    rows = D.lines(C)
    return D.case((f"len({rows}) < 2", "0.7"), other=f"least(len(list_filter({rows}, lambda x: {D.any_of('lower(x)', S.FLOW_WORDS)}))::DOUBLE / len({rows}), 1.0) + 0.1")


def _vcomplexity() -> str:
    t = D.tokens(_LOW)
    waits = f"{D.size(f'list_filter({t}, lambda x: starts_with(x, {D.q("async")}))')} + {D.size(f'list_filter({t}, lambda x: ends_with(x, {D.q("await")}))')}"
    return f"least(({_IND} + {waits}) / 20.0, 1.0)"


def _quality() -> str:
    return D.mean(_length(), _structure(), _complexity(), _consistency(), _richness())


def _coherence() -> str:
    return D.mean(_flow(), _naming(), _rationality())


_FOUND = f"f AS (SELECT *, {_votes()} AS found FROM c)"

# name: column of (content, metadata language), DuckDB expression over f
SCORES: dict[str, tuple[Callable[[Column, Column, Column], Column], str]] = {
    "sco1_content_quality": (S.content_quality, _quality()),
    "sco2_length_quality": (lambda c, m, f: S.length_quality(c), _length()),
    "sco3_structure_quality": (lambda c, m, f: S.structure_quality(c), _structure()),
    "sco4_complexity_quality": (lambda c, m, f: S.complexity_quality(c), _complexity()),
    "sco5_language_consistency": (lambda c, m, f: S.language_consistency(m, f), _consistency()),
    "sco6_semantic_richness": (lambda c, m, f: S.semantic_richness(c), _richness()),
    "sco7a_js_syntax": (lambda c, m, f: S.js_syntax(c), _js()),
    "sco7b_ts_syntax": (lambda c, m, f: S.ts_syntax(c), _ts()),
    "sco7c_xml_shape": (lambda c, m, f: S.xml_shape(c), _XML),
    "sco7d_html_syntax": (lambda c, m, f: S.html_syntax(c), _HTML),
    "sco7e_css_syntax": (lambda c, m, f: S.css_syntax(c), _CSS),
    "sco8_coherence": (lambda c, m, f: S.coherence(c), _coherence()),
    "sco8a_logical_flow": (lambda c, m, f: S.logical_flow(c), _flow()),
    "sco8b_naming_consistency": (lambda c, m, f: S.naming_consistency(c), _naming()),
    "sco8c_structure_rationality": (lambda c, m, f: S.structure_rationality(c), _rationality()),
    "sco8d_indentation": (lambda c, m, f: S.indentation(c), _indent()),
    "sco8e_grouping": (lambda c, m, f: S.grouping(c), _group()),
    "sco10d_html_patterns": (lambda c, m, f: S.html_patterns(c), f"{D.matches(C, ['<!DOCTYPE[^>]*>', '<html[^>]*>', '</html>', '<head[^>]*>', '</head>', '<body[^>]*>', '</body>'], '(?i)')} / 7.0"),
    "sco16_validator_syntax": (
        lambda c, m, f: S.validator_syntax(c, f),
        D.case(("found = 'javascript'", D.case((f"{D.balanced(C, '{', '}')} AND {D.balanced(C, '(', ')')}", "1.0"), other="0.7")), ("found = 'xml'", D.case((D.balanced(C, "<", ">"), "1.0"), other="0.6")), other="0.8"),
    ),
    "sco17_validator_coherence": (lambda c, m, f: S.validator_coherence(c), _vcoherence()),
    "sco18_validator_complexity": (lambda c, m, f: S.validator_complexity(c), _vcomplexity()),
    "sco19_task_completion": (
        lambda c, m, f: S.task_completion(c),
        D.case(("contains(content, 'function') AND contains(content, 'return')", "0.9"), ("contains(content, 'class') AND contains(content, '{')", "0.85"), ("contains(content, 'interface') AND contains(content, '{')", "0.8"), other="0.6"),
    ),
    "sco20_keyword_coverage": (lambda c, m, f: S.keyword_coverage(c), f"{D.hits(_LOW, S.COVERAGE_KEYWORDS)} / 16.0"),
    "sco21_cyclomatic": (lambda c, m, f: S.cyclomatic(c), f"1 + {D.count(C, 'if')} + 2 * ({D.count(C, 'for')} + {D.count(C, 'while')}) + {D.count(C, 'switch')} + {D.count(C, '&&')} + {D.count(C, '||')}"),
}


def detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contents with the detected language, computed once a row; unused, it is pruned."""
    return contents(spark, sf_dir).withColumn("found", L.detect_language(F.col("content"), F.col("language")))


def _score_query(column: Callable[[Column, Column, Column], Column]) -> Query:
    return lambda spark, sf_dir: detected(spark, sf_dir).select("src", "id", F.round(column(*map(F.col, ("content", "language", "found"))).cast("double"), 6).alias("score"))


def _labels_query(name: str, column: Callable[[Column, Column, Column], Column]) -> Query:
    return lambda spark, sf_dir: detected(spark, sf_dir).select("src", "id", column(*map(F.col, ("content", "language", "found"))).alias(name))


LABELS: dict[str, tuple[str, Callable[[Column, Column, Column], Column], str]] = {
    "prj2_detect_language": ("found", lambda c, m, f: f, "found"),
    "prj3_detect_language_rule": (
        "found",
        lambda c, m, f: L.detect_by_rules(c),
        D.case((D.any_of(C, ["interface", "type "]), "'typescript'"), (D.any_of(C, ["function", "const "]), "'javascript'"), (f"starts_with({D.strip(C)}, '<') AND contains(content, '</')", "'html'"), (D.any_of(C, ["<?xml", "<configuration>"]), "'xml'"), other="'javascript'"),
    ),
    "flt1_language_filter": ("passes", lambda c, m, f: L.passes_filter(c, f), _bank(False)),
    "flt1_language_filter_corrected": ("passes", lambda c, m, f: L.passes_filter(c, f, corrected=True), _bank(True)),
}


def sco7_syntax_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = S.syntax_validity(F.col("content"), F.col("found"), F.col("well_formed"))
    return parsed(detected(spark, sf_dir)).select("src", "id", F.round(score.cast("double"), 6).alias("score"))


def flt2_source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detected(spark, sf_dir).withColumn("license", F.element_at(F.array(*map(F.lit, ["MIT", "GPL-3.0", "Apache-2.0", None])), (F.col("id") % 4 + 1).cast("int")))
    return rows.select("src", "id", L.passes_source_filter(F.col("content"), F.col("found"), F.col("license"), F.length("content")).alias("passes"), L.permissive(F.col("license")).alias("permissive"))


FLT2 = f"""WITH {CONTENTS}, {_FOUND}, l AS (SELECT *, CASE id % 4 WHEN 0 THEN 'MIT' WHEN 1 THEN 'GPL-3.0' WHEN 2 THEN 'Apache-2.0' END AS license FROM f)
SELECT src, id, coalesce({_source()}, false) AS passes, coalesce(lower(license) IN ({', '.join(map(D.q, L.LICENSES))}), false) AS permissive FROM l"""

PAIR_SCORES: dict[str, tuple[Callable[[Column, Column], Column], str]] = {
    "sco9_term_jaccard": (
        S.term_jaccard,
        (lambda x, y: f"CASE WHEN len(list_distinct(list_concat({x}, {y}))) = 0 THEN 0.0 ELSE len(list_intersect({x}, {y}))::DOUBLE / len(list_distinct(list_concat({x}, {y}))) END")(f"list_distinct({D.tokens('lower(instruction)')})", f"list_distinct({D.tokens('lower(output)')})"),
    ),
    "sco10a_readability": (
        lambda a, b: S.readability(a),
        (lambda per: D.case((f"{per} BETWEEN 10 AND 20", "1.0"), (f"{per} < 10", f"{per} / 10"), other=f"20 / {per}"))(f"(len({D.words('instruction')})::DOUBLE / greatest(len(regexp_extract_all(instruction, '[.!?]+')), 1))"),
    ),
    "sco10b_completeness": (lambda a, b: S.completeness(b), D.case((f"{D.strip('output')} = ''", "0.0"), other=f"(least(length(output) / 50.0, 1.0) + {D.hits('output', S.STRUCTURES)} / 8.0) / 2")),
    "sco10h_quick_quality": (lambda a, b: S.quick_quality(a, b), f"least(1.0, (length(output) / 1000.0 + len({D.words('instruction')}) / 20.0 + CASE WHEN contains(lower(output), 'function') THEN 0.8 ELSE 0.5 END) / 3)"),
    "sco24_codebleu_lite": (
        S.codebleu_lite,
        (lambda g, r: f"CASE WHEN len(list_intersect({g}, {r})) = 0 THEN 0.0 ELSE least(1.0, 0.7 * 2 * len(list_intersect({g}, {r}))::DOUBLE / (len({g}) + len({r})) + 0.3 * least(length(instruction), length(output)) / greatest(length(instruction), length(output))) END")(
            f"list_distinct({D.words('instruction')})", f"list_distinct({D.words('output')})"
        ),
    ),
}


def _pair_query(column: Callable[[Column, Column], Column]) -> Query:
    return lambda spark, sf_dir: pairs(spark, sf_dir).select("conv_id", "turn", F.round(column(F.col("instruction"), F.col("output")).cast("double"), 6).alias("score"))


def sco10g_difficulty_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs(spark, sf_dir).select("conv_id", "turn", S.difficulty_label(F.col("instruction")).alias("difficulty"), "instruction", "output")
    task = F.element_at(F.array(*map(F.lit, [*S.TASK_KEYWORDS, "other"])), (F.col("conv_id") % 5 + 1).cast("int"))
    return rows.select("conv_id", "turn", "difficulty", F.round(S.difficulty_fit(F.col("difficulty"), F.col("output")), 6).alias("fit"), F.round(S.task_relevance(F.col("instruction"), task), 6).alias("relevance"))


def _by_key(key: str, words: dict[str, list[str]], text: str) -> str:
    return D.case(*((f"{key} = '{k}'", f"{D.hits(text, v)} / {len(v)}.0") for k, v in words.items()), other="0.5")


SCO10G = f"""WITH {PAIRS}, d AS (SELECT *, {D.case(*((D.any_of('lower(instruction)', v), D.q(k)) for k, v in S.DIFFICULTY_WORDS.items()), other="'intermediate'")} AS difficulty,
  CASE conv_id % 5 {' '.join(f"WHEN {k} THEN '{t}'" for k, t in enumerate([*S.TASK_KEYWORDS, 'other']))} END AS task FROM q)
SELECT conv_id, turn, difficulty, round({_by_key('difficulty', S.DIFFICULTY_MARKS, 'lower(output)')}, 6) AS fit, round({_by_key('task', S.TASK_KEYWORDS, 'lower(instruction)')}, 6) AS relevance FROM d"""


def queries() -> dict[str, Query]:
    return (
        {k: _score_query(f) for k, (f, _) in SCORES.items()}
        | {k: _labels_query(n, f) for k, (n, f, _) in LABELS.items()}
        | {k: _pair_query(f) for k, (f, _) in PAIR_SCORES.items()}
        | {"flt2_source_filter": flt2_source_filter, "sco10g_difficulty_label": sco10g_difficulty_label, "sco7_syntax_validity": sco7_syntax_validity}
    )


def oracle_sql() -> dict[str, str]:
    return (
        {k: f"WITH {CONTENTS}, {_FOUND} SELECT src, id, round(({e})::DOUBLE, 6) AS score FROM f" for k, (_, e) in SCORES.items()}
        | {k: f"WITH {CONTENTS}, {_FOUND} SELECT src, id, {e} AS {n} FROM f" for k, (n, _, e) in LABELS.items()}
        | {k: f"WITH {PAIRS} SELECT conv_id, turn, round(({e})::DOUBLE, 6) AS score FROM q" for k, (_, e) in PAIR_SCORES.items()}
        | {"flt2_source_filter": FLT2, "sco10g_difficulty_label": SCO10G, "sco7_syntax_validity": f"WITH {CONTENTS}, {_FOUND} SELECT src, id, round(({_syntax(True)})::DOUBLE, 6) AS score FROM f"}
    )
