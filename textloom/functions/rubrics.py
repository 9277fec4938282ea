"""Scores of generated code and rubric checks as Columns. The keyword lists are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import any_of, balanced, count, hits, matches, mean, strip, tokens

WEB_WORDS = ["react", "component", "hook", "api", "fetch", "component", "http", "server", "client", "browser", "javascript", "html", "css", "xml", "web", "frontend", "backend", "framework"]
LANGUAGE_MARKS = {
    "javascript": [r"\bfunction\b", r"\bconst\b", r"\blet\b", "=>", r"console\.log"],
    "typescript": [r"\binterface\b", r"\btype\b", ":", "<.*>"],
    "xml": [r"<\?xml", "<[a-zA-Z]", "</[a-zA-Z]"],
    "html": ["<!DOCTYPE", "<html", "<head", "<body"],
    "mdx": ["#", r"\*\*.*\*\*", "<[^>]+>", "```"],
}
METHOD_SCORES = {"self_instruct": 0.8, "evol_instruct": 0.75, "ast_mutation": 0.7, "domain_specific": 0.85}
CODE_MARKS = {"beginner": ["function", "console.log", "return"], "intermediate": ["class", "async", "try", "catch", "interface"], "advanced": ["generic", "complex", "optimization", "advanced"]}
TASK_WORDS = {"python": ["def ", "class ", "import ", "return "], "javascript": ["function", "const", "let", "=>", "return"], "css": ["{", "}", ":", ";", ".", "#"], "html": ["<", ">", "form", "input"]}
STYLE_TASKS, SCRIPT_TASKS = ["responsive navbar", "CSS Grid layout"], ["Form validation", "DOM manipulation", "API integration"]
STYLE_WORDS, SCRIPT_WORDS = ["css", "style", "responsive", "grid", "flex"], ["function", "const", "let", "var", "async", "await", "fetch"]
#: Mixed-case words never occur in a lower-cased text; they stay, as does their effect.
EXTRA_WORDS = {
    "Form validation": ["validate", "required", "pattern", "addEventListener"],
    "DOM manipulation": ["getElementById", "querySelector", "appendChild", "innerHTML"],
    "API integration": ["fetch", "async", "await", "json"],
}


def _in_range(c: Column, low: int, high: int, floor: float = 0.5) -> Column:
    n = F.length(c).cast("double")
    return F.when(n.between(low, high), 1.0).when(n < low, n / low).otherwise(F.greatest(F.lit(floor), high / F.nullif(n, F.lit(0.0))))


def synthetic_syntax(c: Column, language: Column) -> Column:
    """SCO11b."""
    bare = strip(c)
    ok = (
        F.when(language == "javascript", c.rlike(r"\bfunction\b|\bconst\b|\blet\b"))
        .when(language == "typescript", c.rlike(r"\binterface\b|\btype\b|\bclass\b"))
        .when(language.isin("xml", "html"), bare.startswith("<") & bare.endswith(">"))
        .otherwise(False)
    )
    return F.when(ok, 0.9).otherwise(0.7)


def language_fit(c: Column, language: Column) -> Column:
    """SCO11c."""
    out = None
    for name, patterns in LANGUAGE_MARKS.items():
        score = matches(c, patterns) / len(patterns)
        out = F.when(language == name, score) if out is None else out.when(language == name, score)
    return out.otherwise(0.8)


def web_relevance(c: Column) -> Column:
    """SCO11d; one word stands twice in the list and counts twice."""
    return F.least(hits(F.lower(c), WEB_WORDS) / 3, F.lit(1.0))


def method_prior(method: Column) -> Column:
    """SCO11e."""
    out = None
    for name, score in METHOD_SCORES.items():
        out = F.when(method == name, score) if out is None else out.when(method == name, score)
    return out.otherwise(0.7)


def synthetic_quality(c: Column, language: Column, method: Column) -> Column:
    """SCO11 (SCO11a is its length part)."""
    return mean(_in_range(c, 100, 5000), synthetic_syntax(c, language), language_fit(c, language), web_relevance(c), method_prior(method))


def code_quality(c: Column, language: Column) -> Column:
    """SCO12."""
    js = c.contains("function") & any_of(c, ["return", "{"])
    kind = F.when(language == "javascript", F.when(js, 0.9).otherwise(0.7)).when(language == "typescript", F.when(any_of(c, ["interface", "type"]), 0.9).otherwise(0.7)).otherwise(0.8)
    return F.least(F.lit(1.0), mean(_in_range(c, 50, 5000), kind, F.when(balanced(c, "{", "}"), 0.9).otherwise(0.6)))


def domain_quality(c: Column, language: Column) -> Column:
    """SCO13."""
    mdx, vue = c.contains("#") & c.contains("import"), c.contains("<template>") & c.contains("<script>")
    kind = F.when(language == "mdx", F.when(mdx, 0.9).otherwise(0.7)).when(language == "vue", F.when(vue, 0.9).otherwise(0.7)).otherwise(0.8)
    return mean(_in_range(c, 200, 10000), kind)


def code_difficulty(c: Column) -> Column:
    """SCO14: the first level with two marks."""
    out, low = None, F.lower(c)
    for name, parts in CODE_MARKS.items():
        out = F.when(hits(low, parts) >= 2, name) if out is None else out.when(hits(low, parts) >= 2, name)
    return out.otherwise("intermediate")


def complexity_counts(c: Column) -> dict[str, Column]:
    """SCO15."""
    n = lambda x, *w: F.size(F.filter(tokens(x), lambda t: t.isin(list(w))))
    out = {"function_count": n(c, "function"), "class_count": n(c, "class"), "async_count": n(c, "async"), "error_handling_count": n(F.lower(c), "try", "catch", "error")}
    out = {k: v.cast("long") for k, v in out.items()}
    return out | {"complexity_score": out["function_count"] + 2 * out["class_count"] + 1.5 * out["async_count"] + out["error_handling_count"]}


def generated(c: Column, prompt_length: int) -> Column:
    """SCO30: more than the prompt, and a keyword."""
    return (F.length(strip(c)) > prompt_length) & any_of(F.lower(c), ["def ", "class ", "function"])


def basic_syntax(c: Column) -> Column:
    """SCO31."""
    bare = F.length(strip(c))
    return (bare >= 5) & balanced(c, "(", ")") & balanced(c, "{", "}") & (any_of(c, ["def ", "function", "class ", "const ", "let "]) | (bare > 20))


def task_quality(c: Column, task: Column) -> Column:
    """SCO32."""
    low, share = F.lower(task), lambda k: hits(c, TASK_WORDS[k]) / len(TASK_WORDS[k]) * 0.4
    words = F.when(low.contains("python"), share("python")).when(any_of(low, ["javascript", "js"]), share("javascript")).when(low.contains("css"), share("css")).when(low.contains("html"), share("html")).otherwise(0.0)
    score = F.when(F.length(c) > 50, 0.2).otherwise(0.0) + words + F.when(balanced(c, "{", "}"), 0.2).otherwise(0.0) + F.when(balanced(c, "(", ")"), 0.2).otherwise(0.0)
    return F.when(F.length(strip(c)) < 10, 0.0).otherwise(F.least(score, F.lit(1.0)))


def orchestrated_quality(c: Column, task: Column) -> Column:
    """SCO38."""
    low, add = F.lower(c), lambda cond, v: F.when(cond, v).otherwise(0.0)
    extra = None
    for name, parts in EXTRA_WORDS.items():
        extra = F.when(task == name, add(any_of(low, parts), 0.3)) if extra is None else extra.when(task == name, add(any_of(low, parts), 0.3))
    style = add(any_of(low, STYLE_WORDS), 0.3) + add(c.contains("<") & c.contains(">"), 0.3)
    kind = F.when(task.isin(STYLE_TASKS), style).when(task.isin(SCRIPT_TASKS), add(any_of(low, SCRIPT_WORDS), 0.3) + extra).otherwise(0.0)
    return F.least(F.lit(1.0), add(F.length(c) > 50, 0.2) + kind + add(balanced(c, "{", "}"), 0.1) + add(balanced(c, "(", ")"), 0.1))


def mdx_counts(c: Column) -> dict[str, Column]:
    """SCO26: tags opened, closed and closed by themselves, as counts."""
    n = lambda p: F.regexp_count(c, F.lit(p)).cast("long")
    return {"opened": n("<[A-Za-z][^>/]*>"), "closed": n("</[A-Za-z][^>]*>"), "self_closed": n("<[A-Za-z][^>]*/>"), "braces": (count(c, "{") - count(c, "}")).cast("long")}
