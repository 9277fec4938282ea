"""Queries of the generated-code and rubric scores, with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rubrics as R
from ..functions.language import detect_language
from . import duck as D
from .content import _FOUND
from .inputs import CONTENTS, contents

Query = Callable[[SparkSession, str], DataFrame]

C, _LOW = "content", "lower(content)"
METHODS = [*R.METHOD_SCORES, "other"]
TASKS = [*R.STYLE_TASKS, *R.SCRIPT_TASKS, "python script", "js tool", "css page", "html form"]


def _pick(values: list[str], spark: bool):
    if spark:
        return F.element_at(F.array(*map(F.lit, values)), (F.col("id") % len(values) + 1).cast("int"))
    return f"CASE id % {len(values)} {' '.join(f'WHEN {k} THEN {D.q(v)}' for k, v in enumerate(values))} END"


def _range(low: int, high: int) -> str:
    return D.case((f"length(content) BETWEEN {low} AND {high}", "1.0"), (f"length(content) < {low}", f"length(content) / {low}.0"), other=f"greatest(0.5, {high}.0 / length(content))")


def _add(cond: str, v: float) -> str:
    return f"(CASE WHEN {cond} THEN {v} ELSE 0.0 END)"


_SYNTAX = D.case(
    (f"found = 'javascript' AND {D.rlike(C, r'\bfunction\b|\bconst\b|\blet\b')}", "0.9"), (f"found = 'typescript' AND {D.rlike(C, r'\binterface\b|\btype\b|\bclass\b')}", "0.9"),
    (f"found IN ('xml', 'html') AND starts_with({D.strip(C)}, '<') AND ends_with({D.strip(C)}, '>')", "0.9"), other="0.7",
)
_FIT = D.case(*((f"found = '{k}'", f"{D.matches(C, v)} / {len(v)}.0") for k, v in R.LANGUAGE_MARKS.items()), other="0.8")
_WEB = f"least({D.hits(_LOW, R.WEB_WORDS)} / 3.0, 1.0)"
_METHOD = D.case(*((f"method = '{k}'", str(v)) for k, v in R.METHOD_SCORES.items()), other="0.7")
_BRACES, _PARENS = D.balanced(C, "{", "}"), D.balanced(C, "(", ")")
_CODE = "least(1.0, " + D.mean(
    _range(50, 5000),
    D.case(("found = 'javascript'", D.case((f"contains(content, 'function') AND {D.any_of(C, ['return', '{'])}", "0.9"), other="0.7")), ("found = 'typescript'", D.case((D.any_of(C, ["interface", "type"]), "0.9"), other="0.7")), other="0.8"),
    D.case((_BRACES, "0.9"), other="0.6"),
) + ")"
_DOMAIN = D.mean(_range(200, 10000), D.case(("found = 'mdx'", D.case(("contains(content, '#') AND contains(content, 'import')", "0.9"), other="0.7")), other="0.8"))


def _share(k: str) -> str:
    return f"{D.hits(C, R.TASK_WORDS[k])} / {len(R.TASK_WORDS[k])}.0 * 0.4"


_TASK = D.case(
    (f"length({D.strip(C)}) < 10", "0.0"),
    other=f"least(1.0, {_add('length(content) > 50', 0.2)} + {D.case(('contains(lower(task), ' + D.q('python') + ')', _share('python')), (D.any_of('lower(task)', ['javascript', 'js']), _share('javascript')), ('contains(lower(task), ' + D.q('css') + ')', _share('css')), ('contains(lower(task), ' + D.q('html') + ')', _share('html')), other='0.0')} + {_add(_BRACES, 0.2)} + {_add(_PARENS, 0.2)})",
)
_EXTRA = D.case(*((f"task = '{k}'", _add(D.any_of(_LOW, v), 0.3)) for k, v in R.EXTRA_WORDS.items()), other="0.0")
_ORCHESTRATED = (
    f"least(1.0, {_add('length(content) > 50', 0.2)} + CASE WHEN {D.one_of('task', R.STYLE_TASKS)} THEN {_add(D.any_of(_LOW, R.STYLE_WORDS), 0.3)} + {_add('contains(content, ' + D.q('<') + ') AND contains(content, ' + D.q('>') + ')', 0.3)} "
    f"WHEN {D.one_of('task', R.SCRIPT_TASKS)} THEN {_add(D.any_of(_LOW, R.SCRIPT_WORDS), 0.3)} + {_EXTRA} ELSE 0.0 END + {_add(_BRACES, 0.1)} + {_add(_PARENS, 0.1)})"
)
_BASIC = f"(length({D.strip(C)}) >= 5 AND {_PARENS} AND {_BRACES} AND ({D.any_of(C, ['def ', 'function', 'class ', 'const ', 'let '])} OR length({D.strip(C)}) > 20))::INT"

SCORES: dict[str, tuple[Callable[[Column, Column, Column, Column], Column], str]] = {
    "sco11_synthetic_quality": (lambda c, f, m, t: R.synthetic_quality(c, f, m), D.mean(_range(100, 5000), _SYNTAX, _FIT, _WEB, _METHOD)),
    "sco11b_synthetic_syntax": (lambda c, f, m, t: R.synthetic_syntax(c, f), _SYNTAX),
    "sco11c_language_fit": (lambda c, f, m, t: R.language_fit(c, f), _FIT),
    "sco11d_web_relevance": (lambda c, f, m, t: R.web_relevance(c), _WEB),
    "sco12_code_quality": (lambda c, f, m, t: R.code_quality(c, f), _CODE),
    "sco13_domain_quality": (lambda c, f, m, t: R.domain_quality(c, f), _DOMAIN),
    "sco30_generated": (lambda c, f, m, t: R.generated(c, 40).cast("int"), f"(length({D.strip(C)}) > 40 AND {D.any_of(_LOW, ['def ', 'class ', 'function'])})::INT"),
    "sco31_basic_syntax": (lambda c, f, m, t: R.basic_syntax(c).cast("int"), _BASIC),
    "sco32_task_quality": (lambda c, f, m, t: R.task_quality(c, t), _TASK),
    "sco38_orchestrated_quality": (lambda c, f, m, t: R.orchestrated_quality(c, t), _ORCHESTRATED),
}


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents(spark, sf_dir).withColumn("found", detect_language(F.col("content"), F.col("language"))).withColumn("method", _pick(METHODS, True)).withColumn("task", _pick(TASKS, True))


_ROWS = f"WITH {CONTENTS}, {_FOUND}, r AS (SELECT *, {_pick(METHODS, False)} AS method, {_pick(TASKS, False)} AS task FROM f)"


def _query(column) -> Query:
    return lambda spark, sf_dir: _rows(spark, sf_dir).select("src", "id", F.round(column(*map(F.col, ("content", "found", "method", "task"))).cast("double"), 6).alias("score"))


def _n(x: str, *words: str) -> str:
    return f"len(list_filter({D.tokens(x)}, lambda t: {D.one_of('t', list(words))}))"


def queries() -> dict[str, Query]:
    return {k: _query(f) for k, (f, _) in SCORES.items()} | {
        "flt10_synthetic_filter": lambda s, d: _rows(s, d).where(F.round(R.synthetic_quality(*map(F.col, ("content", "found", "method"))), 9) >= 0.75).select("src", "id"),
        "sco14_code_difficulty": lambda s, d: contents(s, d).select("src", "id", R.code_difficulty(F.col("content")).alias("difficulty")),
        "sco15_complexity": lambda s, d: contents(s, d).select("src", "id", *(v.cast("double" if "score" in k else "long").alias(k) for k, v in R.complexity_counts(F.col("content")).items())),
        "sco26_mdx_counts": lambda s, d: contents(s, d).select("src", "id", *(v.alias(k) for k, v in R.mdx_counts(F.col("content")).items())),
    }


def oracle_sql() -> dict[str, str]:
    f, k, a, e = _n(C, "function"), _n(C, "class"), _n(C, "async"), _n(_LOW, "try", "catch", "error")
    count = lambda p: f"len(regexp_extract_all(content, {D.q(p)}))"
    return {n: f"{_ROWS} SELECT src, id, round(({x})::DOUBLE, 6) AS score FROM r" for n, (_, x) in SCORES.items()} | {
        "flt10_synthetic_filter": f"{_ROWS} SELECT src, id FROM r WHERE round(({SCORES['sco11_synthetic_quality'][1]})::DOUBLE, 9) >= 0.75",
        "sco14_code_difficulty": f"WITH {CONTENTS} SELECT src, id, {D.case(*((f'{D.hits(_LOW, v)} >= 2', D.q(n)) for n, v in R.CODE_MARKS.items()), other=D.q('intermediate'))} AS difficulty FROM c",
        "sco15_complexity": f"WITH {CONTENTS} SELECT src, id, {f} AS function_count, {k} AS class_count, {a} AS async_count, {e} AS error_handling_count, ({f} + 2 * {k} + 1.5 * {a} + {e})::DOUBLE AS complexity_score FROM c",
        "sco26_mdx_counts": f"WITH {CONTENTS} SELECT src, id, {count('<[A-Za-z][^>/]*>')} AS opened, {count('</[A-Za-z][^>]*>')} AS closed, {count('<[A-Za-z][^>]*/>')} AS self_closed, {D.count(C, '{')} - {D.count(C, '}')} AS braces FROM c",
    }
