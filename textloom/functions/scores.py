"""

What several scores of a row need (the detected language) is a parameter, and what one score needs
several times (token arrays) is bound once; counts of words are regular expressions over the text,
searched only where the word occurs at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .language import compatible
from .text import AFTER, BEFORE, NAME, SPACES, any_of, balanced, bind, count, found, hits, lines, matches, mean, strip, times, tokens, words

# fixed values: word lists
STOP_WORDS = "the a an and or but in on at to for of with by is are was were be been have has had do does did will would could should may might can this that these those".split()
PROGRAM_WORDS = "function var let const class return if else for while new this true false null undefined try catch throw".split()
NAMING_KEYWORDS = "function class const let var if else for while return new this true false null undefined try catch".split()
COVERAGE_KEYWORDS = "function const let var class if else for while return try catch async await import export".split()
FLOW_WORDS = "function class if else for while return try catch".split()
STRUCTURES = ["{", "}", "function", "class", "interface", "var", "let", "const"]
TASK_KEYWORDS = {
    "function_creation": ["function", "create", "implement", "write"],
    "component_creation": ["component", "create", "react", "jsx"],
    "api_integration": ["api", "integration", "fetch", "http"],
    "configuration": ["config", "setup", "deploy", "xml"],
}
DIFFICULTY_MARKS = {"beginner": ["function", "simple", "basic"], "intermediate": ["class", "async", "error", "validation"], "advanced": ["interface", "generic", "optimize", "complex"]}
DIFFICULTY_WORDS = {
    "advanced": ["optimize", "performance", "scalable", "enterprise", "architect"],
    "intermediate": ["api", "error", "validation", "async", "component"],
    "beginner": ["simple", "basic", "create", "display", "show"],
}


def _one_of(value: Column, words: list[str]) -> Column:
    return value.isin(words)


def length_quality(c: Column) -> Column:
    """SCO2."""
    n = F.length(c).cast("double")
    scored = lambda low, high: F.when(n.between(low, high), 1.0).when(n < low, n / low).otherwise(high / F.nullif(n, F.lit(0.0)))
    return F.when(strip(c).startswith("<"), scored(100, 10000)).when(any_of(c, ["function", "class"]), scored(100, 5000)).otherwise(scored(50, 2000))


def structure_quality(c: Column) -> Column:
    """SCO3: three balances and up to three further checks, of those that apply."""
    markup = strip(c).startswith("<")
    more = c.contains("function").cast("int") + c.contains("class").cast("int")
    passed = sum((balanced(c, a, b).cast("int") for a, b in ("{}", "()", "[]")), F.lit(0)) + more + (markup & c.contains(">")).cast("int")
    return passed.cast("double") / (3 + more + markup.cast("int"))


def _indicators(c: Column) -> Column:
    """Functions, classes, loops and conditions, as the complexity scores count them."""
    exact = times(c, f"{BEFORE}(?:function|class|for|while){AFTER}", "function", "class", "for", "while")
    return exact + times(c, f"{BEFORE}if", "if") + times(c, f"case{AFTER}", "case") + count(c, "else") + count(c, "switch")


def _waits(low: Column, last: str) -> Column:
    return times(low, f"{BEFORE}async", "async") + times(low, f"{last}{AFTER}", last)


def complexity_quality(c: Column) -> Column:
    """SCO4."""
    n = bind(F.lower(c), lambda low: F.regexp_count(c, F.lit(NAME)) + _indicators(c) + _waits(low, "promise") + count(low, "await")).cast("double")
    return bind(n, lambda n: F.when(n == 0, 0.5).when(n.between(5, 50), 1.0).when(n < 5, n / 5).otherwise(F.greatest(F.lit(0.3), 50 / n)))


def language_consistency(metadata: Column, found: Column) -> Column:
    """SCO5. found: the detected language."""
    return F.when(metadata == "unknown", 0.8).when(metadata == found, 1.0).when(compatible(metadata, found), 0.8).otherwise(0.3)


def semantic_richness(c: Column) -> Column:
    """SCO6; the reference's short list of stop words, which it takes where no larger one is installed."""
    bare = F.regexp_replace(F.regexp_replace(c, r"[{}();,:=<>\"']", " "), BEFORE + r"[\p{L}\p{N}_]++\.([\p{L}\p{N}_]+|\*)", " ")

    def score(t: Column) -> Column:
        n = F.size(t).cast("double")
        rich = lambda s: F.when(F.size(s) < 3, 0.4).otherwise((F.size(F.array_distinct(s)) / F.size(s) + F.size(s) / n) / 2)
        return F.when(n < 3, 0.3).otherwise(bind(F.filter(t, lambda x: ~_one_of(x, [*STOP_WORDS, *PROGRAM_WORDS])), rich))

    return bind(tokens(F.lower(bare)), score)


def content_quality(c: Column, metadata: Column, found: Column) -> Column:
    """SCO1."""
    return mean(length_quality(c), structure_quality(c), complexity_quality(c), language_consistency(metadata, found), semantic_richness(c))


def _balances(c: Column) -> Column:
    return mean(*(balanced(c, a, b).cast("int") for a, b in ("{}", "()", "[]")))


def js_syntax(c: Column) -> Column:
    """SCO7a."""
    weights = ((r"\bfunction\b.*\(.*\)\s*\{", 0.9), (r"const\s+\w+\s*=", 0.8), (r"=>\s*\{", 0.8), (r"class\s+\w+", 0.8))
    score = sum((c.rlike(p).cast("double") * w for p, w in weights), F.lit(0.0))
    return (_balances(c) + F.least(F.lit(1.0), score)) / 2


def ts_syntax(c: Column) -> Column:
    """SCO7b: checks that apply, averaged with the JavaScript score; else 0.9 of it."""
    notes = matches(c, [r":\s*[a-zA-Z_$][a-zA-Z0-9_$<>,\[\]\s\|&]*", r":\s*\{[^}]*\}", r":\s*\[[^\]]*\]"]) > 0
    checks = [(c.contains("interface"), c.rlike(r"interface\s+\w+\s*\{")), (c.contains("type "), c.rlike(r"type\s+\w+\s*=")), (c.contains(":"), notes)]
    n = sum((a.cast("int") for a, _ in checks), F.lit(0))
    k = sum(((a & b).cast("int") for a, b in checks), F.lit(0))
    js = js_syntax(c)
    return F.when(n > 0, (js + k / n) / 2).otherwise(js * 0.9)


def xml_shape(c: Column) -> Column:
    """SCO7c where the text is not well formed: three heuristics."""
    return mean(strip(c).startswith("<").cast("int"), balanced(c, "<", ">").cast("int"), (~c.rlike(r"<[^>]*<[^>]*>")).cast("int"))


def html_syntax(c: Column) -> Column:
    """SCO7d."""
    bare = strip(c)
    return mean((bare.startswith("<!DOCTYPE") | bare.startswith("<html")).cast("int"), balanced(c, "<", ">").cast("int"), c.rlike(r"(?i)<html[^>]*>").cast("int"), c.rlike("(?i)</html>").cast("int"))


def css_syntax(c: Column) -> Column:
    """SCO7e."""
    return mean(balanced(c, "{", "}").cast("int"), c.rlike(r"[a-zA-Z_-]+\s*\{").cast("int"), c.rlike(r"[a-zA-Z-]+\s*:\s*[^;]+;").cast("int"))


def logical_flow(c: Column) -> Column:
    """SCO8a."""
    hit = lambda x: matches(x, ["^import|^from", "^const|^let|^var", "^function", r"^\s*\}"], "(?i)") / 4
    return bind(lines(c), lambda rows: F.when(F.size(rows) < 3, 0.5).otherwise(F.aggregate(F.transform(rows, hit), F.lit(0.0), lambda a, x: a + x) / F.size(rows)))


def naming_consistency(c: Column) -> Column:
    """SCO8b."""
    names = F.filter(F.regexp_extract_all(c, F.lit(BEFORE + r"[a-zA-Z_][a-zA-Z0-9_]{2,}+" + AFTER), F.lit(0)), lambda x: ~_one_of(F.lower(x), NAMING_KEYWORDS))
    snake = lambda x: x.contains("_") & (x == F.lower(x)) & x.rlike("[a-z]")
    good = lambda xs: F.size(F.filter(xs, lambda x: x.rlike("^[a-z]+([A-Z][a-z]*)*$"))) + F.when(c.contains("_"), F.size(F.filter(xs, snake))).otherwise(0)
    return bind(names, lambda xs: F.when(F.size(xs) < 3, 0.5).otherwise(good(xs) / F.size(xs)))


def indentation(c: Column) -> Column:
    """SCO8d."""
    rows = F.filter(F.split(c, "\n"), lambda x: strip(x) != "")
    depths = lambda xs: F.array_distinct(F.transform(xs, lambda x: F.length(x) - F.length(F.ltrim(x, F.lit(SPACES)))))
    return bind(rows, lambda xs: F.when(F.size(xs) < 3, 0.5).otherwise(bind(F.size(depths(xs)), lambda k: F.when(k <= 4, 1.0).when(k <= 8, 0.7).otherwise(0.4))))


def grouping(c: Column) -> Column:
    """SCO8e: block marks for every hundred characters."""
    n = count(c, "{") + count(c, "}") + times(c, r"(?m)(?d);\s*$", ";")
    density = n / (F.nullif(F.length(c), F.lit(0)) / 100)
    return F.when(F.length(c) == 0, 0.5).otherwise(bind(density, lambda d: F.when(d.between(2, 20), 1.0).when(d < 2, 0.6).otherwise(0.7)))


def structure_rationality(c: Column) -> Column:
    """SCO8c."""
    return mean(indentation(c), balanced(c, "{", "}").cast("int"), grouping(c))


def coherence(c: Column) -> Column:
    """SCO8."""
    return mean(logical_flow(c), naming_consistency(c), structure_rationality(c))


def syntax_validity(c: Column, found: Column, well_formed: Column | None = None) -> Column:
    """SCO7 by the detected language. well_formed: whether the text parses as XML (of
    ``operators.markup``); without it the xml branch is its heuristics alone."""
    shape = xml_shape(c) if well_formed is None else F.when(well_formed, 1.0).otherwise(xml_shape(c))
    return F.when(found == "javascript", js_syntax(c)).when(found == "typescript", ts_syntax(c)).when(found == "xml", shape).when(found == "html", html_syntax(c)).when(found == "css", css_syntax(c)).otherwise(0.8)


def term_jaccard(a: Column, b: Column) -> Column:
    """SCO9."""
    x, y = F.array_distinct(tokens(F.lower(a))), F.array_distinct(tokens(F.lower(b)))
    of = lambda x, y: bind(F.size(F.array_union(x, y)), lambda n: F.when(n == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / n))
    return bind(x, lambda x: bind(y, lambda y: of(x, y)))


def readability(text: Column) -> Column:
    """SCO10a."""
    per = F.size(words(text)) / F.greatest(F.regexp_count(text, F.lit("[.!?]+")), F.lit(1))
    return F.when(per.between(10, 20), 1.0).when(per < 10, per / 10).otherwise(20 / per)


def completeness(output: Column) -> Column:
    """SCO10b."""
    return F.when(strip(output) == "", 0.0).otherwise((F.least(F.length(output) / 50, F.lit(1.0)) + hits(output, STRUCTURES) / len(STRUCTURES)) / 2)


def html_patterns(code: Column) -> Column:
    """SCO10d, the HTML part."""
    return matches(code, ["<!DOCTYPE[^>]*>", "<html[^>]*>", "</html>", "<head[^>]*>", "</head>", "<body[^>]*>", "</body>"], "(?i)") / 7


def _by_key(key: Column, table: dict[str, list[str]], text: Column) -> Column:
    out, low = None, F.lower(text)
    for name, parts in table.items():
        score = hits(low, parts) / len(parts)
        out = F.when(key == name, score) if out is None else out.when(key == name, score)
    return out.otherwise(0.5)


def task_relevance(instruction: Column, task: Column) -> Column:
    """SCO10e."""
    return _by_key(task, TASK_KEYWORDS, instruction)


def difficulty_fit(difficulty: Column, output: Column) -> Column:
    """SCO10f."""
    return _by_key(difficulty, DIFFICULTY_MARKS, output)


def difficulty_label(instruction: Column) -> Column:
    """SCO10g."""
    out, low = None, F.lower(instruction)
    for name, parts in DIFFICULTY_WORDS.items():
        out = F.when(any_of(low, parts), name) if out is None else out.when(any_of(low, parts), name)
    return out.otherwise("intermediate")


def quick_quality(instruction: Column, output: Column) -> Column:
    """SCO10h."""
    return F.least(F.lit(1.0), (F.length(output) / 1000 + F.size(words(instruction)) / 20 + F.when(F.lower(output).contains("function"), 0.8).otherwise(0.5)) / 3)


def validator_syntax(c: Column, language: Column) -> Column:
    """SCO16."""
    js = balanced(c, "{", "}") & balanced(c, "(", ")")
    return F.when(language == "javascript", F.when(js, 1.0).otherwise(0.7)).when(language == "xml", F.when(balanced(c, "<", ">"), 1.0).otherwise(0.6)).otherwise(0.8)


def validator_coherence(c: Column) -> Column:
    """SCO17; up to 1.1."""
    n = lambda rows: F.size(F.filter(rows, lambda x: bind(F.lower(x), lambda low: any_of(low, FLOW_WORDS))))
    return bind(lines(c), lambda rows: F.when(F.size(rows) < 2, 0.7).otherwise(F.least(n(rows) / F.size(rows), F.lit(1.0)) + 0.1))


def validator_complexity(c: Column) -> Column:
    """SCO18."""
    return F.least((_indicators(c) + bind(F.lower(c), lambda low: _waits(low, "await"))) / 20, F.lit(1.0))


def task_completion(c: Column) -> Column:
    """SCO19."""
    return (
        F.when(c.contains("function") & c.contains("return"), 0.9)
        .when(c.contains("class") & c.contains("{"), 0.85)
        .when(c.contains("interface") & c.contains("{"), 0.8)
        .otherwise(0.6)
    )


def keyword_coverage(c: Column) -> Column:
    """SCO20."""
    return hits(F.lower(c), COVERAGE_KEYWORDS) / len(COVERAGE_KEYWORDS)


def cyclomatic(c: Column) -> Column:
    """SCO21."""
    return 1 + count(c, "if") + 2 * (count(c, "for") + count(c, "while")) + count(c, "switch") + count(c, "&&") + count(c, "||")


def codebleu_lite(generated: Column, reference: Column) -> Column:
    """SCO24: 0.7 F1 of word sets and 0.3 length ratio, at most 1; 0 without common words."""
    g, r = F.array_distinct(words(generated)), F.array_distinct(words(reference))
    both = F.size(F.array_intersect(g, r))
    precision, recall = both / F.nullif(F.size(g), F.lit(0)), both / F.nullif(F.size(r), F.lit(0))
    ratio = F.least(F.length(generated), F.length(reference)) / F.nullif(F.greatest(F.length(generated), F.length(reference)), F.lit(0))
    return F.when(both == 0, 0.0).otherwise(F.least(F.lit(1.0), 0.7 * (2 * precision * recall / (precision + recall)) + 0.3 * ratio))
