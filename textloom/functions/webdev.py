"""Rubrics of web code as Columns (SCO33 to SCO37). The keyword lists are fixed values; words with
capitals never occur in a lower-cased text, and stay in the lists, as does their effect.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import any_of, balanced, bind, count, found, hits, strip

# fixed values: keywords by a part of the task's name, in order of precedence
JS_TASKS = {
    "responsive navbar": ["responsive", "navbar", "nav", "menu", "hamburger", "flex", "grid"],
    "form validation": ["validate", "required", "pattern", "addEventListener", "form", "input"],
    "react component": ["react", "component", "function", "useState", "useEffect", "jsx"],
    "async data": ["async", "await", "fetch", "api", "promise", "axios"],
    "dom manipulation": ["getElementById", "querySelector", "appendChild", "innerHTML", "addEventListener"],
}
JS_EXPECTED = {
    "responsive navbar": ["responsive", "media", "hamburger", "nav", "flex"],
    "form validation": ["validate", "required", "pattern", "error"],
    "react component": ["react", "jsx", "component", "function"],
}
JS_WORDS = ["const", "let", "arrow", "function", "class", "async", "await", "=>"]
JS_MODERN = ["const", "let", "arrow", "=>", "template", "spread"]
JSX_MARKS = ["<", ">", "/>", "</", "jsx"]
STYLED = ["button", "modal", "form"]
CONFIG_WORDS = ["config", "setting", "property", "value"]
DOC_WORDS = ["example", "usage", "props", "description", "parameter"]
CSS_KINDS = {
    "responsive_design": ["@media", "responsive", "flex", "grid", "viewport"],
    "animations": ["@keyframes", "animation", "transform", "transition"],
    "layout_systems": ["flex", "grid", "display", "position", "float"],
}
CSS_MARKS = ["{", "}", ";", ":", ".class", "#id"]
CSS_MODERN = ["var(", "calc(", "clamp(", "min(", "max("]
CSS_USED = ["display: flex", "display: grid", "var(", "calc(", "@media"]


def _if(cond: Column, v: float) -> Column:
    return F.when(cond, v).otherwise(0.0)


def _share(text: Column, parts: list[str], weight: float = 1.0) -> Column:
    return hits(text, parts) / len(parts) * weight


def _by(conditions: list[tuple[Column, Column]], other: float) -> Column:
    out = None
    for cond, value in conditions:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(other)


def _capped(score: Column) -> Column:
    return F.least(score, F.lit(1.0))


def js_quality(c: Column, task: Column) -> Column:
    """SCO33, quality."""
    own = bind(F.lower(c), lambda low: _by([(F.lower(task).contains(k), _share(low, v, 0.4)) for k, v in JS_TASKS.items()], 0.0))
    return _capped(_if(F.length(c) > 50, 0.1) + own + _share(c, JS_WORDS, 0.2) + _if(balanced(c, "{", "}"), 0.1) + _if(balanced(c, "(", ")"), 0.1))


def js_features(c: Column, task: Column) -> Column:
    """SCO33, features."""
    return bind(F.lower(c), lambda low: _by([(F.lower(task).contains(k), _share(low, v)) for k, v in JS_EXPECTED.items()], 0.5))


def js_style(c: Column) -> Column:
    """SCO33, style."""
    named = found(c, r"(?<![\p{L}\p{N}_])[a-z][a-zA-Z0-9]*+(?![\p{L}\p{N}_])")
    caught = any_of(c, ["try", "catch"]) | F.lower(c).contains("error")
    return _capped(_share(c, JS_MODERN, 0.4) + _if(named, 0.2) + _if(any_of(c, ["//", "/*"]), 0.2) + _if(caught, 0.2))


def react_component(c: Column, name: str) -> Column:
    """SCO34, component. name: the component's, letters and digits only."""
    defined = found(c, rf"function\s+{name}\s*\(", name) | found(c, rf"const\s+{name}\s*=", name) | found(c, rf"class\s+{name}\s+extends", name)
    styled = _if(any_of(c, ["className", "style"]), 0.2) if name.lower() in STYLED else F.lit(0.0)
    return _capped(_if(F.lower(c).contains("react"), 0.2) + _if(defined, 0.3) + _share(c, JSX_MARKS, 0.2) + styled + _if(any_of(c, ["props", "}"]), 0.1))


def component_structure(c: Column) -> Column:
    """SCO34, structure."""
    return _if(c.contains("return"), 0.3) + _if(c.contains("<") & c.contains(">"), 0.3) + _if(c.contains("export"), 0.2) + _if(any_of(c, ["function", "const"]), 0.2)


def prop_usage(c: Column) -> Column:
    """SCO34, props."""
    member = r"(?<![\p{L}\p{N}_])[\p{L}\p{N}_]++\.[\p{L}\p{N}_]"
    return _if(c.contains("props"), 0.5) + _if(c.contains("{") & c.contains("}"), 0.3) + _if(found(c, member, "."), 0.2)


def jsx_valid(c: Column) -> Column:
    """SCO34, jsx: a self-closing tag, or every opened tag closed in order. Tags end at the next
    blank, or at ``>`` where no blank follows; a closing tag that does not match is passed over."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?s)//.*?\n|/\*.*?\*/", ""), "\"[^\"]*\"|'[^']*'", "")

    def fold(t: Column) -> Column:
        parts = F.split(t, "<", -1)
        from_end = F.array_position(F.transform(F.reverse(parts), lambda p: p.contains(" ")), True)
        last_blank = F.when(from_end > 0, F.size(parts) - from_end).otherwise(-1)
        more = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.struct(F.get(parts, i).alias("p"), i.alias("i")))

        def step(stack: Column, x: Column) -> Column:
            p, blank_ahead = x["p"], x["i"] <= last_blank
            closing = F.trim(F.substring_index(p, ">", 1).substr(F.lit(2), F.length(p)))
            popped = F.when(F.size(stack) > 0, F.slice(stack, 1, F.size(stack) - 1)).otherwise(stack)
            closed = F.when(p.contains(">") & (F.get(stack, F.size(stack) - 1) == closing), popped).otherwise(stack)
            # a tag without a blank of its own runs on to a blank in a later part; its name is then more than a name
            whole = F.when(p.contains(" "), F.substring_index(p, " ", 1)).when(blank_ahead, F.concat(p, F.lit("<"))).when(p.contains(">"), F.substring_index(p, ">", 1))
            name = F.replace(F.trim(whole), F.lit("/"), F.lit(""))
            return F.when(p.startswith("/"), closed).when(F.coalesce(name, F.lit("")) != "", F.concat(stack, F.array(name))).otherwise(stack)

        return F.when(F.size(parts) < 2, F.lit(True)).otherwise(F.size(F.aggregate(more, F.array().cast("array<string>"), step)) == 0)

    return bind(bare, lambda t: found(t, r"<[^>]+/>", "/>") | fold(t))


def config_content(c: Column, json_ok: Column | None = None) -> Column:
    """SCO35, content. json_ok: of a .json file, whether it parses; None for XML files."""
    if json_ok is None:
        kind = _if(balanced(c, "<", ">"), 0.3) + _if(count(c, "{") <= count(c, "}"), 0.2)
    else:
        kind = F.when(json_ok, 0.5).otherwise(0.2)
    return _capped(_if(F.length(c) > 50, 0.1) + kind + _share(F.lower(c), CONFIG_WORDS, 0.3))


def config_structure(c: Column, json: bool, package: bool = False) -> Column:
    """SCO35, structure."""
    if not json:
        return _if(c.contains("<") & c.contains(">"), 0.5) + _if(c.contains("<?xml"), 0.2) + _if(c.contains("</"), 0.3)
    named = _if(any_of(c, ["dependencies", "devDependencies"]), 0.2) if package else F.lit(0.0)
    return _if(c.contains("{") & c.contains("}"), 0.3) + _if(c.contains('"'), 0.3) + _if(c.contains(":"), 0.2) + named


def config_valid(well_formed: Column, json_ok: Column) -> Column:
    """SCO35, parse."""
    return well_formed | json_ok


def mdx_content(c: Column, component: str) -> Column:
    """SCO36, content."""
    marks = _if(c.contains("#"), 0.2) + _if(c.contains("```"), 0.2) + _if(c.contains("[") & c.contains("]"), 0.2)
    return _capped(marks + _if(count(c, "\n") > 2, 0.1) + _if(F.lower(c).contains(component.lower()), 0.3))


def markdown_valid(c: Column) -> Column:
    """SCO36, balance."""
    return balanced(c, "[", "]") & (count(c, "```") % 2 == 0)


def mdx_completeness(c: Column, component: str) -> Column:
    """SCO36, completeness."""
    return _share(F.lower(c), DOC_WORDS, 0.6) + _if(c.contains("#"), 0.2) + _if(F.lower(c).contains(component.lower()), 0.2)


def css_quality(c: Column, kind: Column) -> Column:
    """SCO37, quality."""
    own = bind(F.lower(c), lambda low: _by([(kind == k, _share(low, v, 0.4)) for k, v in CSS_KINDS.items()], 0.0))
    return _capped(_if(F.length(c) > 30, 0.1) + own + _share(c, CSS_MARKS, 0.2) + _share(c, CSS_MODERN, 0.2))


def css_valid(c: Column) -> Column:
    """SCO37, declarations."""
    return balanced(c, "{", "}") & c.contains(":") & c.contains(";") & F.exists(F.split(c, ";"), lambda p: p.contains(":"))


def css_modern(c: Column, kind: Column) -> Column:
    """SCO37, modern features."""
    own = F.when(kind == "responsive_design", _if(c.contains("@media"), 0.3)).when(kind == "animations", _if(any_of(c, ["@keyframes", "animation:"]), 0.3)).otherwise(0.0)
    return _capped(_share(c, CSS_USED, 0.7) + own)


# --- validity of code (SCO10c, SCO23, SCO29)

# fixed values: patterns and what each adds
JS_WEIGHTS = [(r"\bfunction\b", 0.2), (r"[{}]", 0.2), (r"(?m)//.*$", 0.1), (r"/\*.*?\*/", 0.1), (r"\b(return|if|else|for|while)\b", 0.2), (r"[a-zA-Z_$][a-zA-Z0-9_$]*\s*\(", 0.2)]
OUTPUT_WORDS = ["def ", "class ", "import ", "for ", "while ", "#"]


def js_weight_score(c: Column) -> Column:
    """SCO10c."""
    needs = ["function", "", "//", "/*", "", "("]
    return _capped(sum((_if(found(c, p, n), w) for (p, w), n in zip(JS_WEIGHTS, needs, strict=True)), F.lit(0.0)))


def code_valid(c: Column, language: Column, matched: Column, well_formed: Column, python_ok: Column) -> Column:
    """SCO23. matched: SCO22; well_formed, python_ok: whether xml or python texts parse."""
    n = F.length(strip(c))
    js = matched & (any_of(c, ["function", "=>", "class", "const", "let"]) | (n > 20))
    html = balanced(c, "<", ">") & (any_of(c, ["/>", "</"]) | (n > 10))
    css = balanced(c, "{", "}") & c.contains(":") & (any_of(c, [".", "#"]) | found(c, r"[a-zA-Z]+\s*\{", "{") | (n > 15))
    other = balanced(c, "(", ")") & balanced(c, "{", "}") & balanced(c, "[", "]") & (n > 20)
    kind = F.when(language.isin("javascript", "typescript"), js).when(language == "html", html).when(language == "css", css)
    kind = kind.when(language == "xml", F.coalesce(well_formed, F.lit(False))).when(language == "python", F.coalesce(python_ok, F.lit(False))).otherwise(other)
    return F.when(c.isNull(), F.lit(False)).otherwise((n >= 5) & kind)


def output_checks(text: Column, prompt: Column, repetitive: Column, python_ok: Column) -> Column:
    """SCO29: how many of five checks hold; three are enough."""
    parts = [~repetitive, F.length(text).between(20, 200), python_ok, F.length(strip(text)) > F.length(prompt), any_of(F.lower(text), OUTPUT_WORDS)]
    return sum((F.coalesce(p, F.lit(False)).cast("int") for p in parts), F.lit(0))


# fixed values: languages that the strict source filter knows, with their length bounds
SOURCE_LENGTHS = {"javascript": (50, 50000), "typescript": (50, 50000), "xml": (30, 30000), "html": (100, 40000)}
# fixed values: thresholds of the six metrics of an instruction
INSTRUCTION_LEAST = {"clarity": 0.8, "completeness": 0.85, "similarity": 0.7, "syntax": 0.9, "relevance": 0.8, "difficulty": 0.75}


def passes_strict_source(c: Column, language: Column) -> Column:
    """FLT3: unknown languages fail; of JavaScript and TypeScript four of three patterns are asked
    for, so they fail too; xml needs its three patterns, html its length."""
    low = F.lower(language)
    xml = found(c, r"<\?xml[^>]*\?>", "<?xml") & found(c, "<[a-zA-Z][^>]*>", "<") & found(c, "</[a-zA-Z][^>]*>", "</")
    inside = _by([(low == k, F.length(c).between(*v)) for k, v in SOURCE_LENGTHS.items()], False)
    return F.coalesce(inside & F.when(low == "xml", xml).otherwise(~low.isin("javascript", "typescript")), F.lit(False))


def passes_instruction(scores: dict[str, Column]) -> Column:
    """FLT7: the mean of the six metrics where each reaches its threshold, else null."""
    ok = F.lit(True)
    for name, least in INSTRUCTION_LEAST.items():
        ok &= F.round(scores[name], 9) >= least
    return F.when(ok, sum((scores[n].cast("double") for n in INSTRUCTION_LEAST), F.lit(0.0)) / len(INSTRUCTION_LEAST))


def passes_pair_gate(doc: Column, code: Column, similarity: Column) -> Column:
    """PRJ11: lengths of documentation and code, and a similarity above 0.6."""
    return F.length(doc).between(50, 2000) & F.length(code).between(100, 10000) & (similarity > 0.6)


