"""Queries of code checks, web rubrics and rewrites, with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rewrite as R
from ..functions import scores as S
from ..functions import webdev as W
from ..operators import generate, markup
from . import duck as D
from .content import _FOUND, PAIR_SCORES, _by_key, detected
from .inputs import CONTENTS, PAIRS, contents, pairs, parses

Query = Callable[[SparkSession, str], DataFrame]

C, _LOW = "content", "lower(content)"
JS_TASKS = ["Create a responsive navbar", "Build a form validation", "React component for a list", "Load async data", "DOM manipulation", "anything else"]
CSS_KINDS = [*W.CSS_KINDS, "other"]
_WORD = r"[\p{L}\p{N}_]"


def _pick(values: list[str], spark: bool):
    if spark:
        return F.element_at(F.array(*map(F.lit, values)), (F.col("id") % len(values) + 1).cast("int"))
    return f"CASE id % {len(values)} {' '.join(f'WHEN {k} THEN {D.q(v)}' for k, v in enumerate(values))} END"


def _if(cond: str, v: float) -> str:
    return f"(CASE WHEN {cond} THEN {v} ELSE 0.0 END)"


def _share(x: str, parts: list[str], weight: float = 1.0) -> str:
    return f"({D.hits(x, parts)} / {len(parts)}.0 * {weight})"


def _has(*parts: str) -> str:
    return "(" + " AND ".join(f"contains(content, {D.q(p)})" for p in parts) + ")"


def _by(arms: list[tuple[str, str]], other: float) -> str:
    return D.case(*arms, other=str(other))


_B, _P = D.balanced(C, "{", "}"), D.balanced(C, "(", ")")
_NAMED = D.rlike(C, rf"(^|[^\p{{L}}\p{{N}}_])[a-z][a-zA-Z0-9]*([^\p{{L}}\p{{N}}_]|$)")

# name: column of (content, id's task, id's css kind), DuckDB expression
RUBRICS: dict[str, tuple[Callable[[Column, Column, Column], Column], str]] = {
    "sco10c_js_weights": (
        lambda c, t, k: W.js_weight_score(c),
        "least(1.0, " + " + ".join(_if(D.rlike(C, p), w) for p, w in W.JS_WEIGHTS) + ")",
    ),
    "sco33_js_quality": (
        lambda c, t, k: W.js_quality(c, t),
        f"least(1.0, {_if('length(content) > 50', 0.1)} + {_by([(f'contains(lower(task), {D.q(n)})', _share(_LOW, v, 0.4)) for n, v in W.JS_TASKS.items()], 0.0)} + {_share(C, W.JS_WORDS, 0.2)} + {_if(_B, 0.1)} + {_if(_P, 0.1)})",
    ),
    "sco33_js_features": (lambda c, t, k: W.js_features(c, t), _by([(f"contains(lower(task), {D.q(n)})", _share(_LOW, v)) for n, v in W.JS_EXPECTED.items()], 0.5)),
    "sco33_js_style": (
        lambda c, t, k: W.js_style(c),
        f"least(1.0, {_share(C, W.JS_MODERN, 0.4)} + {_if(_NAMED, 0.2)} + {_if(D.any_of(C, ['//', '/*']), 0.2)} + {_if(D.any_of(C, ['try', 'catch']) + ' OR contains(lower(content), ' + D.q('error') + ')', 0.2)})",
    ),
    "sco34_react_component": (
        lambda c, t, k: W.react_component(c, "Button"),
        f"least(1.0, {_if('contains(lower(content), ' + D.q('react') + ')', 0.2)} + {_if(' OR '.join(D.rlike(C, p) for p in (r'function\s+Button\s*\(', r'const\s+Button\s*=', r'class\s+Button\s+extends')), 0.3)}"
        f" + {_share(C, W.JSX_MARKS, 0.2)} + {_if(D.any_of(C, ['className', 'style']), 0.2)} + {_if(D.any_of(C, ['props', '}']), 0.1)})",
    ),
    "sco34_structure": (lambda c, t, k: W.component_structure(c), f"{_if(_has('return'), 0.3)} + {_if(_has('<', '>'), 0.3)} + {_if(_has('export'), 0.2)} + {_if(D.any_of(C, ['function', 'const']), 0.2)}"),
    "sco34_props": (lambda c, t, k: W.prop_usage(c), f"{_if(_has('props'), 0.5)} + {_if(_has('{', '}'), 0.3)} + {_if(D.rlike(C, rf'{_WORD}\.{_WORD}'), 0.2)}"),
    "sco35_xml_content": (
        lambda c, t, k: W.config_content(c),
        f"least(1.0, {_if('length(content) > 50', 0.1)} + {_if(D.balanced(C, '<', '>'), 0.3)} + {_if(D.count(C, '{') + ' <= ' + D.count(C, '}'), 0.2)} + {_share(_LOW, W.CONFIG_WORDS, 0.3)})",
    ),
    "sco35_xml_structure": (lambda c, t, k: W.config_structure(c, json=False), f"{_if(_has('<', '>'), 0.5)} + {_if(_has('<?xml'), 0.2)} + {_if(_has('</'), 0.3)}"),
    "sco35_json_structure": (
        lambda c, t, k: W.config_structure(c, json=True, package=True),
        f"{_if(_has('{', '}'), 0.3)} + {_if(_has(chr(34)), 0.3)} + {_if(_has(':'), 0.2)} + {_if(D.any_of(C, ['dependencies', 'devDependencies']), 0.2)}",
    ),
    "sco36_mdx_content": (
        lambda c, t, k: W.mdx_content(c, "Button"),
        f"least(1.0, {_if(_has('#'), 0.2)} + {_if(_has('```'), 0.2)} + {_if(_has('[', ']'), 0.2)} + {_if('len(string_split(content, chr(10))) > 3', 0.1)} + {_if('contains(lower(content), ' + D.q('button') + ')', 0.3)})",
    ),
    "sco36_markdown_valid": (lambda c, t, k: W.markdown_valid(c).cast("int"), f"({D.balanced(C, '[', ']')} AND {D.count(C, '```')} % 2 = 0)::INT"),
    "sco36_completeness": (lambda c, t, k: W.mdx_completeness(c, "Button"), f"{_share(_LOW, W.DOC_WORDS, 0.6)} + {_if(_has('#'), 0.2)} + {_if('contains(lower(content), ' + D.q('button') + ')', 0.2)}"),
    "sco37_css_quality": (
        lambda c, t, k: W.css_quality(c, k),
        f"least(1.0, {_if('length(content) > 30', 0.1)} + {_by([(f'kind = {D.q(n)}', _share(_LOW, v, 0.4)) for n, v in W.CSS_KINDS.items()], 0.0)} + {_share(C, W.CSS_MARKS, 0.2)} + {_share(C, W.CSS_MODERN, 0.2)})",
    ),
    "sco37_css_valid": (
        lambda c, t, k: W.css_valid(c).cast("int"),
        f"({_B} AND {_has(':', ';')} AND len(list_filter(string_split(content, ';'), lambda p: contains(p, ':') AND {D.strip('p')} <> '')) > 0)::INT",
    ),
    "sco37_css_modern": (
        lambda c, t, k: W.css_modern(c, k),
        f"least(1.0, {_share(C, W.CSS_USED, 0.7)} + CASE kind WHEN 'responsive_design' THEN {_if(_has('@media'), 0.3)} WHEN 'animations' THEN {_if(D.any_of(C, ['@keyframes', 'animation:']), 0.3)} ELSE 0.0 END)",
    ),
}

_ROWS = f"WITH {CONTENTS}, r AS (SELECT *, {_pick(JS_TASKS, False)} AS task, {_pick(CSS_KINDS, False)} AS kind FROM c)"


def _rubric(column) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = contents(spark, sf_dir).withColumn("task", _pick(JS_TASKS, True)).withColumn("kind", _pick(CSS_KINDS, True))
        return rows.select("src", "id", F.round(column(*map(F.col, ("content", "task", "kind"))).cast("double"), 6).alias("score"))

    return run


def sco23(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, f = F.col("content"), F.col("found")
    rows = markup.parsed(detected(spark, sf_dir)).withColumn("python_ok", markup.parses_as(F.when(f == "python", c), "python"))
    return rows.select("src", "id", W.code_valid(c, f, markup.matched(c), F.col("well_formed"), F.col("python_ok")).alias("valid"))


#: The brackets of a text one after the other: each takes the last open one away, or ends the fold.
_FOLD = (
    "list_reduce(list_prepend('', regexp_extract_all(content, '[()\\[\\]{}]')), lambda a, b: CASE WHEN a = 'x' THEN 'x' WHEN b IN ('(', '[', '{') THEN a || b "
    "WHEN right(a, 1) = translate(b, ')]}', '([{') THEN left(a, length(a) - 1) ELSE 'x' END) = ''"
)
_N = f"length({D.strip(C)})"
SCO23 = f"""WITH {CONTENTS}, {_FOUND} SELECT src, id, {_N} >= 5 AND {D.case(
    ("found IN ('javascript', 'typescript')", f"{_FOLD} AND ({D.any_of(C, ['function', '=>', 'class', 'const', 'let'])} OR {_N} > 20)"),
    ("found = 'html'", f"{D.balanced(C, '<', '>')} AND ({D.any_of(C, ['/>', '</'])} OR {_N} > 10)"),
    ("found = 'css'", f"{_B} AND contains(content, ':') AND ({D.any_of(C, ['.', '#'])} OR {D.rlike(C, r'[a-zA-Z]+\s*\{')} OR {_N} > 15)"),
    ("found = 'xml'", parses('xml')), ("found = 'python'", parses('python')),
    other=f"{_P} AND {_B} AND {D.balanced(C, '[', ']')} AND {_N} > 20",
)} AS valid FROM f"""  # fmt: skip


def sco25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents(spark, sf_dir).select("src", "id", markup.xml_details(F.col("content")).alias("x")).select("src", "id", "x.*")


#: By hand: elements, depth and attributes of the samples that are well formed.
SCO25 = f"""WITH {CONTENTS}, k AS (SELECT * FROM (VALUES (3, 3, 1, true), (4, 5, 2, true), (17, 2, 1, true)) AS v(k, elements, depth, attributes))
SELECT src, id, k IS NOT NULL AS well_formed, coalesce(elements, 0) AS elements, coalesce(depth, 0) AS depth, coalesce(attributes, false) AS attributes, 0 AS character_issues FROM c LEFT JOIN k ON src = 's' AND id = k"""


def sco27(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = contents(spark, sf_dir).select("src", "id", markup.html_details(F.col("content")).alias("x")).select("src", "id", "x.*")
    return x.withColumn("missing", F.array_join("missing", ",")).withColumn("deprecated", F.array_join("deprecated", ","))


_BARE = f"regexp_replace(regexp_replace(regexp_replace(content, {D.q(r'(?s)<!\[CDATA\[.*?\]\]>')}, '', 'g'), {D.q(r'(?s)<!--.*?-->')}, '', 'g'), {D.q(r'(?is)(<(?:script|style)[^>]*>).*?(</(?:script|style)>)')}, {D.q(chr(92) + '1' + chr(92) + '2')}, 'g')"
_TAG = lambda t: f"list_contains(t, {D.q(t)})"
SCO27 = f"""WITH {CONTENTS}, t AS (SELECT src, id, list_transform(regexp_extract_all({_BARE}, {D.q('<([a-zA-Z][^ ' + chr(92) + 't' + chr(92) + 'r' + chr(92) + 'n' + chr(92) + 'f/>]*)[^>]*>')}, 1), lambda x: lower(x)) AS t FROM c),
m AS (SELECT *, array_to_string(list_filter({markup.REQUIRED!r}, lambda x: NOT list_contains(t, x)), ',') AS missing, array_to_string(list_filter({markup.DEPRECATED!r}, lambda x: list_contains(t, x)), ',') AS deprecated FROM t)
SELECT src, id, true AS valid, len(t)::INT AS tags, {_TAG('head')} AS has_head, {_TAG('body')} AS has_body, missing, deprecated, missing = '' AND deprecated = '' AS compliant FROM m"""


def sco29(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, prompt = F.col("output"), F.col("instruction")
    rows = pairs(spark, sf_dir).withColumn("python_ok", markup.parses_as(out, "python"))
    n = W.output_checks(out, prompt, generate.repetitive(out), F.col("python_ok"))
    return rows.select("conv_id", "turn", n.alias("checks"), (n >= 3).alias("passed"))


SCO29 = f"""WITH {PAIRS}, w AS (SELECT *, {D.words('output')} AS w FROM q),
r AS (SELECT conv_id, turn, output AS t, unnest(list_transform(range(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) >= 10),
f AS (SELECT DISTINCT conv_id, turn FROM r WHERE (length(t) - length(replace(t, s, ''))) // length(s) > 2),
n AS (SELECT q.conv_id, q.turn, (f.conv_id IS NULL)::INT + (length(output) BETWEEN 20 AND 200)::INT + regexp_full_match(output, {D.q(r'\s*(?:[\p{L}_][\p{L}\p{N}_]*)?\s*')})::INT
  + (length({D.strip('output')}) > length(instruction))::INT + {D.any_of('lower(output)', W.OUTPUT_WORDS)}::INT AS checks FROM q LEFT JOIN f ON q.conv_id = f.conv_id AND q.turn = f.turn)
SELECT conv_id, turn, checks, checks >= 3 AS passed FROM n"""


def sco35_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("content")
    return contents(spark, sf_dir).select("src", "id", W.config_valid(markup.parses_as(c, "xml"), markup.parses_as(c, "json")).alias("valid"))


def flt3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detected(spark, sf_dir).select("src", "id", W.passes_strict_source(F.col("content"), F.col("found")).alias("passes"))


FLT3 = f"""WITH {CONTENTS}, {_FOUND} SELECT src, id, {D.case(
    ("found = 'xml'", f"length(content) BETWEEN 30 AND 30000 AND {D.rlike(C, r'<\?xml[^>]*\?>')} AND {D.rlike(C, '<[a-zA-Z][^>]*>')} AND {D.rlike(C, '</[a-zA-Z][^>]*>')}"),
    ("found = 'html'", "length(content) BETWEEN 100 AND 40000"), other="false")} AS passes FROM f"""  # fmt: skip


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair with its six metrics: the language is JavaScript, the task goes by conv_id."""
    i, o = F.col("instruction"), F.col("output")
    task = F.element_at(F.array(*map(F.lit, [*S.TASK_KEYWORDS, "other"])), (F.col("conv_id") % 5 + 1).cast("int"))
    rows = pairs(spark, sf_dir).withColumn("label", S.difficulty_label(i))
    parts = {"clarity": S.readability(i), "completeness": S.completeness(o), "similarity": S.term_jaccard(i, o), "syntax": W.js_weight_score(o), "relevance": S.task_relevance(i, task), "difficulty": S.difficulty_fit(F.col("label"), o)}
    return rows.select("conv_id", "turn", *(F.round(v.cast("double"), 6).alias(k) for k, v in parts.items()))


def flt7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _metrics(spark, sf_dir)
    return rows.withColumn("quality", F.round(W.passes_instruction({k: F.col(k) for k in W.INSTRUCTION_LEAST}), 6))


_JSW = RUBRICS["sco10c_js_weights"][1].replace("content", "output")
FLT7 = f"""WITH {PAIRS}, d AS (SELECT *, {D.case(*((D.any_of('lower(instruction)', v), D.q(k)) for k, v in S.DIFFICULTY_WORDS.items()), other="'intermediate'")} AS label,
  CASE conv_id % 5 {' '.join(f"WHEN {k} THEN '{t}'" for k, t in enumerate([*S.TASK_KEYWORDS, 'other']))} END AS task FROM q),
m AS (SELECT conv_id, turn, round(({PAIR_SCORES['sco10a_readability'][1]})::DOUBLE, 6) AS clarity, round(({PAIR_SCORES['sco10b_completeness'][1]})::DOUBLE, 6) AS completeness, round(({PAIR_SCORES['sco9_term_jaccard'][1]})::DOUBLE, 6) AS similarity,
  round(({_JSW})::DOUBLE, 6) AS syntax, round(({_by_key('task', S.TASK_KEYWORDS, 'lower(instruction)')})::DOUBLE, 6) AS relevance, round(({_by_key('label', S.DIFFICULTY_MARKS, 'lower(output)')})::DOUBLE, 6) AS difficulty FROM d)
SELECT *, CASE WHEN {' AND '.join(f'{k} >= {v}' for k, v in W.INSTRUCTION_LEAST.items())} THEN round(({' + '.join(W.INSTRUCTION_LEAST)}) / 6, 6) END AS quality FROM m"""

_QUICK = PAIR_SCORES["sco10h_quick_quality"][1]


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).withColumn("score", F.round(S.quick_quality(F.col("instruction"), F.col("output")), 6))


def flt9(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return _gated(spark, sf_dir).select("conv_id", "turn", generate.unit_gate(F.col("score"), key).alias("passed"))


def prj11(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, o = F.col("instruction"), F.col("output")
    return pairs(spark, sf_dir).withColumn("similarity", F.round(S.term_jaccard(i, o), 6)).select("conv_id", "turn", "similarity", W.passes_pair_gate(i, o, F.col("similarity")).alias("passes"))


def prj19(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.element_at(F.array(F.lit("add"), F.lit("area"), F.lit("load")), (F.col("id") % 3 + 1).cast("int"))
    rows = contents(spark, sf_dir).withColumn("name", name)
    return rows.select("src", "id", F.sha2(R.extracted(F.col("content"), F.col("name")), 256).alias("function"))


#: By hand: what is a function of the asked name in the samples; other texts stay whole.
_FUNCTIONS = {15: "def area(w, h):\n    # of a box\n    return w * h\n"}
PRJ19 = f"""WITH {CONTENTS} SELECT src, id, sha256(CASE {' '.join(f"WHEN src = 's' AND id = {k} AND id % 3 = {n} THEN {D.q(v)}" for k, v, n in ((15, _FUNCTIONS[15], 1),))} ELSE content END) AS function FROM c"""


def _special(x: str) -> str:
    for token, pattern in R.SPECIAL:
        x = f"regexp_replace({x}, {D.q(pattern)}, {D.q(f' {token} ')}, 'g')"
    return x


_RENAMED = f"""WITH {CONTENTS}, a AS (SELECT src, id, regexp_replace(regexp_replace(regexp_replace(content, {D.q('//.*?' + chr(92) + 'n')}, chr(10), 'g'), {D.q(r'(?s)/\*.*?\*/')}, '', 'g'), {D.q(D.SPACE + '+')}, ' ', 'g') AS x FROM c),
b AS (SELECT src, id, x, {D.tokens('x')} AS t, string_split_regex(x, {D.q(D.TOKEN)}) AS gaps FROM a),
u AS (SELECT src, id, unnest(t) AS y, unnest(range(1, len(t) + 1)) AS i, unnest(gaps[2:]) AS gap FROM b),
f AS (SELECT *, regexp_full_match(y, '[a-zA-Z_][a-zA-Z0-9_]*') AS own, min(i) OVER (PARTITION BY src, id, y) AS first FROM u),
k AS (SELECT *, CASE WHEN own THEN 'var_' || (dense_rank() OVER (PARTITION BY src, id, own ORDER BY first) - 1) ELSE y END AS z FROM f),
j AS (SELECT src, id, string_agg(z || gap, '' ORDER BY i) AS s FROM k GROUP BY src, id)
SELECT b.src, b.id, sha256(lower({D.strip("gaps[1] || coalesce(s, '')")})) AS renamed FROM b LEFT JOIN j ON b.src = j.src AND b.id = j.id"""


def queries() -> dict[str, Query]:
    c = F.col
    return {k: _rubric(f) for k, (f, _) in RUBRICS.items()} | {
        "sco10d_xml_parse": lambda s, d: contents(s, d).select("src", "id", markup.parses_as(c("content"), "xml").cast("int").alias("score")),
        "sco22_bracket_stack": lambda s, d: contents(s, d).select("src", "id", markup.matched(c("content")).alias("matched")),
        "sco23_code_valid": sco23,
        "sco25_xml_detail": sco25,
        "sco27_html_detail": sco27,
        "sco29_output_checks": sco29,
        "sco34_jsx_valid": lambda s, d: contents(s, d).select("src", "id", W.jsx_valid(c("content")).alias("valid")),
        "sco35_valid": sco35_valid,
        "sco35_json_content": lambda s, d: contents(s, d).select("src", "id", F.round(W.config_content(c("content"), markup.parses_as(c("content"), "json")), 6).alias("score")),
        "flt3_strict_source": flt3,
        "flt7_instruction_metrics": flt7,
        "flt8_generation_quality": lambda s, d: _gated(s, d).where("score >= 0.75").select("conv_id", "turn", "score"),
        "flt9_unit_gate": flt9,
        "prj7_renamed": lambda s, d: contents(s, d).select("src", "id", F.sha2(R.renamed(c("content")), 256).alias("renamed")),
        "prj11_pair_gate": prj11,
        "prj12_special_tokens": lambda s, d: contents(s, d).select("src", "id", F.sha2(R.special_tokens(c("content")), 256).alias("rewritten")),
        "prj13_normalised": lambda s, d: contents(s, d).select("src", "id", F.sha2(R.normalised(c("content"), lower=True), 256).alias("normalised")),
        "prj19_function": prj19,
    }


_TOP = "string_split(s, chr(2))[-2]"
#: The stack is a text here: every open tag's name and a mark after it.
SCO34_JSX = f"""WITH {CONTENTS}, b AS (SELECT src, id, regexp_replace(regexp_replace(content, {D.q(r'(?s)//.*?' + chr(92) + r'n|/\*.*?\*/')}, '', 'g'), {D.q(chr(34) + '[^' + chr(34) + ']*' + chr(34) + '|' + chr(39) + '[^' + chr(39) + ']*' + chr(39))}, '', 'g') AS t FROM c),
p AS (SELECT *, string_split(t, '<') AS parts FROM b), l AS (SELECT *, coalesce(list_max(list_filter(range(len(parts)), lambda i: contains(parts[i + 1], ' '))), -1) AS blank FROM p),
e AS (SELECT *, list_transform(range(1, len(parts)), lambda i: CASE WHEN i <= blank THEN '1' ELSE '0' END || parts[i + 1]) AS tags FROM l),
f AS (SELECT *, list_reduce(list_prepend('', tags), lambda s, x: CASE
  WHEN x[2:2] = '/' THEN CASE WHEN contains(x, '>') AND coalesce({_TOP} = trim(split_part(x[2:], '>', 1)[2:], ' '), false) THEN left(s, length(s) - length({_TOP}) - 1) ELSE s END
  ELSE s || coalesce(nullif(replace(trim(CASE WHEN contains(x, ' ') THEN split_part(x[2:], ' ', 1) WHEN x[1:1] = '1' THEN x[2:] || '<' WHEN contains(x, '>') THEN split_part(x[2:], '>', 1) ELSE '' END, ' '), '/', ''), '') || chr(2), '') END) AS stack FROM e)
SELECT src, id, regexp_matches(t, '<[^>]+/>') OR len(parts) < 2 OR stack = '' AS valid FROM f"""


def oracle_sql() -> dict[str, str]:
    gate = f"WITH {PAIRS}, g AS (SELECT *, round(({_QUICK})::DOUBLE, 6) AS score FROM q)"
    space = f"regexp_replace(x, {D.q(D.SPACE + '+')}, ' ', 'g')"
    json = parses("json")
    return {k: f"{_ROWS} SELECT src, id, round(({x})::DOUBLE, 6) AS score FROM r" for k, (_, x) in RUBRICS.items()} | {
        "sco10d_xml_parse": f"WITH {CONTENTS} SELECT src, id, {parses('xml')}::INT AS score FROM c",
        "sco22_bracket_stack": f"WITH {CONTENTS} SELECT src, id, {_FOLD} AS matched FROM c",
        "sco23_code_valid": SCO23,
        "sco25_xml_detail": SCO25,
        "sco27_html_detail": SCO27,
        "sco29_output_checks": SCO29,
        "sco34_jsx_valid": SCO34_JSX,
        "sco35_valid": f"WITH {CONTENTS} SELECT src, id, {parses('xml')} OR {json} AS valid FROM c",
        "sco35_json_content": f"WITH {CONTENTS} SELECT src, id, round(least(1.0, {_if('length(content) > 50', 0.1)} + CASE WHEN {json} THEN 0.5 ELSE 0.2 END + {_share(_LOW, W.CONFIG_WORDS, 0.3)})::DOUBLE, 6) AS score FROM c",
        "flt3_strict_source": FLT3,
        "flt7_instruction_metrics": FLT7,
        "flt8_generation_quality": f"{gate} SELECT conv_id, turn, score FROM g WHERE score >= 0.75",
        "flt9_unit_gate": f"{gate} SELECT conv_id, turn, score > 0.8 OR {D.draw('conv_id::VARCHAR', D.q('-'), 'turn::VARCHAR', D.q(':unit'))} < 0.75 AS passed FROM g",
        "prj7_renamed": _RENAMED,
        "prj11_pair_gate": f"WITH {PAIRS}, s AS (SELECT *, round(({PAIR_SCORES['sco9_term_jaccard'][1]})::DOUBLE, 6) AS similarity FROM q) SELECT conv_id, turn, similarity, length(instruction) BETWEEN 50 AND 2000 AND length(output) BETWEEN 100 AND 10000 AND similarity > 0.6 AS passes FROM s",
        "prj12_special_tokens": f"WITH {CONTENTS} SELECT src, id, sha256({_special('content')}) AS rewritten FROM c",
        "prj13_normalised": f"WITH {CONTENTS}, a AS (SELECT src, id, {_special('content')} AS x FROM c), b AS (SELECT src, id, {space} AS x FROM a) SELECT src, id, sha256({D.strip(f'CASE WHEN {D.matches("x", R.CODE)} > 0 THEN x ELSE lower(x) END')}) AS normalised FROM b",
        "prj19_function": PRJ19,
    }


