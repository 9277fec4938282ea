"""Queries of evaluation, validation, synthesis and near duplicates over the tables, with their
oracles. Where the tables have no such rows, a stand-in is cut from them by ``*_rows`` (and by the
SQL of the same name for the oracle), so every operator reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import language as L
from ..functions import scores as S
from ..operators import evaluation as E
from ..operators import generate, minhash, synthesis, validation
from ..session import table
from ..sources.mock import mock_rows
from . import duck as D
from .content import _FOUND, PAIR_SCORES, _quality, _vcoherence, detected
from .inputs import CONTENTS, PAIRS, contents, pairs
from .pipelines import _ID, _KEYED, _keyed

Query = Callable[[SparkSession, str], DataFrame]
METRICS = ["accuracy", "pass_at_1", "tokens_per_second", "syntax_validity", "latency_ms", "memory_gb", "codebleu_score"]
EXPECTED = {"xml": 0.3, "unknown": 0.1, "en": 0.4, "fr": 0.1, "de": 0.05, "it": 0.05}


def _named(names: list[str], x: Column) -> Column:
    return F.get(F.array(*map(F.lit, names)), (x % len(names)).cast("int"))


def _names(names: list[str], x: str) -> str:
    return f"CASE {x} % {len(names)} {' '.join(f'WHEN {k} THEN {D.q(n)}' for k, n in enumerate(names))} END"


def completions(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "lineitem")
    valid = F.col("l_quantity") > 5
    return t.select(F.col("l_orderkey").cast("string").alias("problem"), F.col("l_linenumber").alias("i"), valid.alias("valid"), (valid & (F.col("l_returnflag") == "N")).alias("passed"))


COMPLETIONS = "p AS (SELECT l_orderkey::VARCHAR AS problem, l_linenumber AS i, l_quantity > 5 AS valid, l_quantity > 5 AND l_returnflag = 'N' AS passed FROM lineitem)"


def predictions(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").select(F.col("l_orderkey").alias("q"), F.col("l_linenumber").alias("i"), F.concat(F.lit(" "), "l_returnflag").alias("p"), _named(["a", "n", "r "], F.col("l_orderkey")).alias("r"))


PREDICTIONS = f"p AS (SELECT l_orderkey AS q, l_linenumber AS i, ' ' || l_returnflag AS p, {_names(['a', 'n', 'r '], 'l_orderkey')} AS r FROM lineitem)"


def answers(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer").select(F.col("c_mktsegment").alias("domain"), F.col("c_name").alias("question"), F.nullif(F.col("c_custkey") % 5, F.lit(4)).alias("picked"), (F.col("c_nationkey") % 4).alias("answer"))


ANSWERS = "m AS (SELECT c_mktsegment AS domain, c_name AS question, nullif(c_custkey % 5, 4) AS picked, c_nationkey % 4 AS answer FROM customer)"


def _metric(s: SparkSession, d: str, late: bool, name: str) -> DataFrame:
    t = table(s, d, "events").withColumn("metric", _named(METRICS, F.col("user_id")))
    return t.where((F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")) == late).groupBy("metric").agg(F.avg("value").alias(name))


METRIC = f"m AS (SELECT {_names(METRICS, 'user_id')} AS metric, ts >= TIMESTAMP '2024-01-16' AS late, event_type, value FROM events), cur AS (SELECT metric, avg(value) AS current FROM m WHERE late GROUP BY metric), base AS (SELECT metric, avg(value) AS baseline FROM m WHERE NOT late GROUP BY metric), \
bb AS (SELECT metric, current, baseline, CASE WHEN baseline = 0 THEN 0 ELSE 100.0 * (current - baseline) / baseline END AS pct FROM cur JOIN base USING (metric))"


def _baselines(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "events").withColumn("metric", _named(METRICS, F.col("user_id")))
    return t.groupBy(F.col("event_type").alias("name"), "metric").agg(F.avg("value").alias("baseline"))


def runs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select(F.col("o_orderkey").alias("run"), (F.col("o_orderstatus") != "P").alias("success"), F.col("o_totalprice").alias("best_metric"), F.col("o_custkey").alias("best_step"), (F.col("o_orderkey") % 1000 + F.lit(0.5)).alias("duration"))


RUNS = "r AS (SELECT o_orderkey AS run, o_orderstatus <> 'P' AS success, o_totalprice AS best_metric, o_custkey AS best_step, o_orderkey % 1000 + 0.5::DOUBLE AS duration FROM orders)"


def versions(s: SparkSession, d: str) -> DataFrame:
    k, text = F.col("p_partkey"), lambda c: c.cast("string")
    v = F.concat(text(F.col("p_size") % 4), F.lit("."), text(k % 12), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("."), text(k % 7))), F.when(k % 4 == 0, F.concat(F.lit("-beta."), text(k % 3))).when(k % 4 == 1, "-rc1").otherwise(""), F.when(k % 5 == 0, F.concat(F.lit("+b"), text(k % 10))).otherwise(""))
    return table(s, d, "part").select(v.alias("version"))


VERSIONS = """v AS (SELECT (p_size % 4) || '.' || (p_partkey % 12) || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '.' || (p_partkey % 7) END || CASE p_partkey % 4 WHEN 0 THEN '-beta.' || (p_partkey % 3) WHEN 1 THEN '-rc1' ELSE '' END || CASE WHEN p_partkey % 5 = 0 THEN '+b' || (p_partkey % 10) ELSE '' END AS version FROM part),
s AS (SELECT version, regexp_extract(version, '^(\\d+)', 1)::INT AS major, regexp_extract(version, '^\\d+\\.(\\d+)', 1)::INT AS minor, coalesce(nullif(regexp_extract(version, '^\\d+\\.\\d+\\.(\\d+)', 1), ''), '0')::INT AS patch,
  nullif(regexp_extract(version, '^[^-+]*-([^+]*)', 1), '') AS prerelease, nullif(regexp_extract(version, '\\+(.*)$', 1), '') AS build FROM v)"""


def gates(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(s, d, "supplier").select(k.alias("position"), F.concat(F.lit("test_"), F.col("s_nationkey").cast("string")).alias("test"), (k % 4 != 0).alias("required"), F.when((k % 4 == 0) | (k % 19 == 18), "failed").otherwise("passed").alias("status"))


GATES = "g AS (SELECT s_suppkey AS position, 'test_' || s_nationkey AS test, s_suppkey % 4 <> 0 AS required, CASE WHEN s_suppkey % 4 = 0 OR s_suppkey % 19 = 18 THEN 'failed' ELSE 'passed' END AS status FROM supplier)"
GATE_METRICS = ["avg_inference_time", "memory_usage_peak", "success_rate", "other"]


def examples(s: SparkSession, d: str) -> DataFrame:
    """The contents with detected language, labelled quality (0.5 without a label), and samples as instructions."""
    q = table(s, d, "labels").where("quality IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").cast("double").alias("quality")).withColumn("src", F.lit("d"))
    return detected(s, d).join(q, ["src", "id"], "left").withColumn("quality", F.coalesce("quality", F.lit(0.5))).withColumn("instruction", F.col("src") == "s")


EXAMPLES = f"{CONTENTS}, {_FOUND}, e AS (SELECT f.*, coalesce(q.quality, 0.5)::DOUBLE AS quality, f.src = 's' AS instruction FROM f LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) q ON f.src = 'd' AND f.id = q.doc_id)"
_EXPECTED = f"x AS (SELECT * FROM (VALUES {', '.join(f'({D.q(k)}, {v}::DOUBLE)' for k, v in EXPECTED.items())}) AS t(language, expected))"
_ACTUAL = "a AS (SELECT found AS language, count(*)::DOUBLE / sum(count(*)) OVER () AS actual FROM e GROUP BY found)"
_VSYNTAX = D.case(("lang = 'javascript'", D.case((f"{D.balanced('content', '{', '}')} AND {D.balanced('content', '(', ')')}", "1.0"), other="0.7")), ("lang = 'xml'", D.case((D.balanced("content", "<", ">"), "1.0"), other="0.6")), other="0.8")
_COMPLETED = D.case(("contains(content, 'function') AND contains(content, 'return')", "0.9"), ("contains(content, 'class') AND contains(content, '{')", "0.85"), ("contains(content, 'interface') AND contains(content, '{')", "0.8"), other="0.6")
_MARKS = ["contains(content, 'function')", "contains(content, 'return')", "(contains(content, '{') AND contains(content, '}'))", "length(content) > 50", D.balanced("content", "(", ")")]
_HUMANEVAL = f"coalesce(avg(CASE WHEN {D.count('content', chr(10))} > 5 THEN ({' + '.join(f'({m})::INT' for m in _MARKS)}) / 5.0 END), 0.5)"
_CODEBLEU = f"coalesce(avg(CASE WHEN {D.strip('content')} <> '' THEN ({D.hits('lower(content)', S.COVERAGE_KEYWORDS)} / 16.0 + {D.case((D.balanced('content', '{', '}') + ' AND ' + D.balanced('content', '(', ')'), '1.0'), other='0.7')} + least(length(content) / 1000.0, 1.0)) / 3 END), 0.5)"
_CONCEPTS = [["variable", "let ", "const "], ["function"], ["class"], ["if", "for", "while"], ["array", "object", "list"]]
_MMLU = " + ".join(f"avg({D.any_of('lower(content)', p)}::INT)" for p in _CONCEPTS)
SUITE = f"""WITH {EXAMPLES}, {_EXPECTED}, {_ACTUAL},
k AS (SELECT avg(rate) AS consistency FROM (SELECT avg((found = language)::INT) AS rate FROM e GROUP BY language)),
d AS (SELECT sum(coalesce(actual, 0) * coalesce(expected, 0)) / (sqrt(sum(coalesce(actual, 0) ** 2)) * sqrt(sum(coalesce(expected, 0) ** 2))) AS cosine FROM a FULL JOIN x USING (language)),
t AS (SELECT avg((({_VSYNTAX.replace('lang =', 'found =')}) >= 0.8)::INT) AS syntax, avg({_vcoherence()}) AS coherence, coalesce(avg(CASE WHEN instruction THEN (({_COMPLETED}) >= 0.8)::INT END), 1.0) AS completion, avg(quality) AS quality, stddev_pop(quality) AS quality_std,
  avg(length(content)) AS length, stddev_pop(length(content)) AS length_std, {_HUMANEVAL} AS humaneval, {_CODEBLEU} AS codebleu, ({_MMLU}) / 5 AS mmlu FROM e),
s AS (SELECT *, length BETWEEN 100 AND 10000 AND length_std <= 5000 AS sized FROM t, k, d),
r AS (SELECT 1 AS i, 'syntax_validity' AS test, 0.3 AS w, syntax AS score, syntax >= 0.9 AS passed FROM s UNION ALL SELECT 2, 'semantic_coherence', 0.3, coherence, coherence >= 0.75 FROM s UNION ALL SELECT 3, 'task_completion', 0.2, completion, completion >= 0.85 FROM s
  UNION ALL SELECT 4, 'language_consistency', 0.1, (consistency + cosine) / 2, consistency >= 0.8 AND cosine >= 0.7 FROM s UNION ALL SELECT 5, 'quality_distribution', 0.1, quality, quality >= 0.75 AND 1 - quality_std / quality >= 0.8 FROM s
  UNION ALL SELECT 6, 'statistical_properties', 0.1, CASE WHEN sized THEN 1.0 ELSE 0.5 END, sized FROM s UNION ALL SELECT 7, 'performance_benchmarks', 0.2, (humaneval + codebleu + mmlu) / 3, humaneval >= 0.603 AND codebleu >= 0.585 AND mmlu >= 0.54 FROM s),
o AS (SELECT i, test, score, passed FROM r UNION ALL SELECT 8, 'overall', sum(w * score) / sum(w), sum(w * score) / sum(w) >= 0.8 FROM r)"""


def gated_pairs(s: SparkSession, d: str) -> DataFrame:
    rows = pairs(s, d).withColumn("score", F.round(S.quick_quality(F.col("instruction"), F.col("output")), 6))
    return rows.withColumn("unit", generate.unit_gate(F.col("score"), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))))


GATED = f"{PAIRS}, g AS (SELECT *, round(({PAIR_SCORES['sco10h_quick_quality'][1]})::DOUBLE, 6) AS score FROM q), u AS (SELECT *, score > 0.8 OR {D.draw('conv_id::VARCHAR', D.q('-'), 'turn::VARCHAR', D.q(':unit'))} < 0.75 AS unit FROM g)"


def rpt12(s: SparkSession, d: str) -> DataFrame:
    t = gated_pairs(s, d).agg(F.count("*").alias("n"), E.rate(F.col("unit")).alias("u"), F.avg("score").alias("q"))
    parts = {"has_rows": F.col("n") > 0, "unit_pass": F.coalesce(F.col("u") >= 0.7, F.lit(False)), "quality_pass": F.coalesce(F.round("q", 9) >= 0.75, F.lit(False))}
    return t.select("n", F.round("u", 6).alias("unit_rate"), F.round("q", 6).alias("quality"), *(v.alias(k) for k, v in parts.items()), (parts["has_rows"] & parts["unit_pass"] & parts["quality_pass"]).alias("passed"))


def dup4(s: SparkSession, d: str) -> DataFrame:
    from ..operators.dedup import keep_best

    scored = _keyed(s, d).withColumn("found", L.detect_language(F.col("content"), F.col("language"))).withColumn("score", F.round(S.content_quality(*map(F.col, ("content", "language", "found"))), 6))
    return keep_best(scored, "score")


DUP4 = f"WITH {_KEYED.replace('SELECT ' + _ID + ' AS id, content,', 'SELECT ' + _ID + ' AS id, content, language,')}, {_FOUND.replace('FROM c', 'FROM k')}, z AS (SELECT id, key, round(({_quality()})::DOUBLE, 6) AS score FROM f) SELECT id, score FROM z QUALIFY row_number() OVER (PARTITION BY key ORDER BY score DESC, id) = 1"


def jon6(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "documents").select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n"))
    b = table(s, d, "pages").select("page_id", F.length(F.coalesce("html", F.lit(""))).alias("n"))
    return E.zipped(a.withColumnRenamed("doc_id", "id"), b.withColumnRenamed("page_id", "id"), "id").select("place", "id", "ref_id", (F.col("n") - F.col("ref_n")).alias("difference"))


def jon10(s: SparkSession, d: str) -> DataFrame:
    """Documents that hold a run of 13 words of a benchmark item, and how many such runs."""
    grams = lambda t, i, x: table(s, d, t).select(F.col(i), F.explode(minhash.shingles(F.col(x), 13)).alias("g"))
    items = grams("benchmark", "item_id", "text").select("g").distinct()
    return grams("documents", "doc_id", "text").join(items, "g", "left_semi").groupBy("doc_id").agg(F.count("*").alias("runs"))


def _grams(t: str, i: str, n: int) -> str:
    w = f"{D.words('lower(coalesce(text, ' + D.q('') + '))')}"
    return f"SELECT DISTINCT {i}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {n} + 2), lambda k: array_to_string(w[k:k + {n - 1}], ' ')) END) AS g FROM (SELECT {i}, {w} AS w FROM {t}) z"


_H = "('0x' || substr(md5(g), 1, 8))::BIGINT"
_PERM = lambda j: f"((1 + ((band * 8 + {j}) * 829348951 + 40503) % 1073741789) * h + ((band * 8 + {j}) * 40503 + 12345)) % 4294967291"
JON5 = f"""WITH g AS ({_grams('documents', 'doc_id', 5)}), h AS (SELECT doc_id, {_H} AS h FROM g), b AS (SELECT doc_id AS doc, band, concat_ws('-', {', '.join(f'min({_PERM(j)})' for j in range(8))}) AS key FROM h, range(16) r(band) GROUP BY doc_id, band),
f AS (SELECT band, key, min(doc) AS first FROM b GROUP BY band, key) SELECT doc, min(first) AS first FROM b JOIN f USING (band, key) GROUP BY doc"""


def win2(s: SparkSession, d: str, every: int = 100) -> DataFrame:
    """WIN2: the share of duplicates among the rows so far, after every ``every`` rows (and the first):
    events in order of time, a duplicate being a (user, type, hour) seen before. Places come from
    counts of ranges, running sums from one row a step."""
    t = table(s, d, "events").select("event_id", "user_id", "event_type", F.date_trunc("hour", "ts").alias("hour"))
    group = ["user_id", "event_type", "hour"]
    again = t.join(t.groupBy(group).agg(F.min("event_id").alias("first")), group).select("event_id", (F.col("event_id") != F.col("first")).cast("int").alias("dup"))
    placed = E._placed(again, "event_id")
    steps = placed.groupBy(F.ceil(F.col("place") / every).cast("long").alias("step")).agg(F.sum("dup").alias("d"), F.count("*").alias("n"), F.max("place").alias("place"))
    so_far = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)  # a row a step
    out = steps.select("place", F.round(F.sum("d").over(so_far) / F.sum("n").over(so_far), 6).alias("rate"))
    return out.where(F.col("place") % every == 0)


WIN2 = """WITH t AS (SELECT event_id, (event_id <> min(event_id) OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts)))::INT AS dup FROM events),
r AS (SELECT row_number() OVER w - 1 AS place, sum(dup) OVER w AS d, row_number() OVER w AS n FROM t WINDOW w AS (ORDER BY event_id))
SELECT place, round(d::DOUBLE / n, 6) AS rate FROM r WHERE place % 100 = 0"""


def rpt10(s: SparkSession, d: str) -> DataFrame:
    speed, size = F.col("c_acctbal") / 200, (F.col("c_custkey") % 70 * 100).cast("double")
    g = E.benchmark_grades(speed, size)
    return table(s, d, "customer").select("c_custkey", F.round(g["score"], 6).alias("score"), *(g[k].alias(k) for k in ("performance", "memory", "accelerate", "quantise")), E.speed_grade(speed).alias("grade"))


RPT10 = """WITH m AS (SELECT c_custkey, c_acctbal / 200 AS speed, least(100.0, c_acctbal / 200 / 10 * 50) AS v, greatest(0.0, 100 - (c_custkey % 70 * 100) / 3000.0 * 50) AS w FROM customer), s AS (SELECT *, (v + w) / 2 AS score FROM m)
SELECT c_custkey, round(score::DOUBLE, 6) AS score, CASE WHEN score >= 80 THEN 'Excellent' WHEN score >= 60 THEN 'Good' WHEN score >= 40 THEN 'Fair' ELSE 'Poor' END AS performance, CASE WHEN w >= 60 THEN 'Good' ELSE 'Fair' END AS memory, v < 40 AS accelerate, w < 40 AS quantise,
  CASE WHEN speed > 50 THEN 'A' WHEN speed > 30 THEN 'B' ELSE 'C' END AS grade FROM s"""


def _daily(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy("event_type", F.col("ts").cast("date").alias("d")).agg(F.avg("value").alias("v"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*(F.round(F.col(c), 6).alias(c) if c in columns else F.col(c) for c in df.columns))


_OPS = lambda names: "list_filter([" + ", ".join(f"CASE WHEN {D.draw('i::VARCHAR', D.q(':' + n))} < 0.3 THEN {D.q(n)} END" for n in names) + "], lambda x: x IS NOT NULL)"
_PICK = lambda values, salt: f"([{', '.join(map(D.q, values))}])[(floor({D.draw('i::VARCHAR', D.q(':' + salt))} * {len(values)}))::INT + 1]"
_FUN = lambda x: f"contains({x}, 'function')"
_C0, _C1, _K0, _K1 = (D.q(x) for x in (*synthesis.COMPLEX, *synthesis.CONSTRAINED))
GEN2 = f"""WITH a AS (SELECT i, {_names(synthesis.EVOLVED, 'i')} AS base, {_OPS(synthesis.EVOLUTIONS)} AS ops FROM (SELECT doc_id AS i FROM documents) r),
b AS (SELECT *, CASE WHEN list_contains(ops, 'instruction_complexity_increase') AND {_FUN('base')} THEN {_C0} || trim(base) || {_C1} ELSE base END AS x FROM a),
c AS (SELECT *, CASE WHEN list_contains(ops, 'output_elaboration') THEN array_to_string(list_transform(string_split(x, chr(10)), lambda l: CASE WHEN contains(l, 'return') THEN {D.q(synthesis.LOGGED)} || chr(10) || l ELSE l END), chr(10)) ELSE x END AS y FROM b),
d AS (SELECT *, CASE WHEN list_contains(ops, 'task_clarification') AND {_FUN('y')} THEN {D.q(synthesis.CLARIFIED)} || y ELSE y END AS z FROM c)
SELECT i AS id, base, array_to_string(ops, ',') AS operations, sha256(CASE WHEN list_contains(ops, 'constraint_addition') AND {_FUN('z')} THEN {_K0} || trim(replace(z, 'function', '')) || {_K1} ELSE z END) AS content FROM d"""


def _renamed(x: str, k: int) -> str:
    n = f"names[{k + 1}]"
    return f"CASE WHEN length({n}) > 2 AND {n} NOT IN ({', '.join(map(D.q, synthesis.KEPT))}) THEN regexp_replace({x}, '\\b' || {n} || '\\b', left({n}, 1) || left(md5({n}), 4), 'g') ELSE {x} END"


GEN3 = f"""WITH a AS (SELECT i, {_PICK(list(synthesis.MUTATED), 'language')} AS language, {_OPS(synthesis.MUTATIONS)} AS ops, {_PICK(synthesis.MUTATED['javascript'], 'seed')} AS js, {_PICK(synthesis.MUTATED['typescript'], 'seed')} AS ts FROM (SELECT doc_id AS i FROM documents) r),
b AS (SELECT *, CASE language WHEN 'javascript' THEN js ELSE ts END AS base FROM a), n AS (SELECT *, regexp_extract_all(base, '\\b[a-zA-Z_][a-zA-Z0-9_]*\\b') AS names FROM b),
n0 AS (SELECT *, {_renamed('base', 0)} AS r0 FROM n), n1 AS (SELECT *, {_renamed('r0', 1)} AS r1 FROM n0), n2 AS (SELECT *, {_renamed('r1', 2)} AS r2 FROM n1),
c AS (SELECT *, CASE WHEN list_contains(ops, 'variable_renaming') THEN r2 ELSE base END AS x FROM n2),
d AS (SELECT *, CASE WHEN list_contains(ops, 'function_modification') AND {_FUN('x')} AND contains(x, '(') THEN replace(x, '(', '(options = {{}}, ') ELSE x END AS y FROM c),
e AS (SELECT *, CASE WHEN list_contains(ops, 'syntax_variation') THEN regexp_replace(y, 'function\\s+(\\w+)\\s*\\([^)]*\\)\\s*\\{{', 'const \\1 = (\\1) => {{', 'g') ELSE y END AS z FROM d)
SELECT i AS id, language, base, array_to_string(ops, ',') AS operations, sha256(CASE WHEN list_contains(ops, 'logic_optimization') THEN replace(z, 'for (', 'for (let i = 0; i < ') ELSE z END) AS content FROM e"""
_DOMAIN = D.case(*((f"u < {t}", D.q(k)) for k, t in (("xml_configuration", 0.4), ("mdx_components", 0.7), ("react_hooks", 0.9))), other="'vue_templates'")
GEN4 = f"""WITH a AS (SELECT i, {D.draw('i::VARCHAR', D.q(':domain'))} AS u FROM (SELECT doc_id AS i FROM documents) r), b AS (SELECT *, {_DOMAIN} AS domain FROM a),
c AS (SELECT *, CASE domain {' '.join(f'WHEN {D.q(k)} THEN {_PICK(list(v[4]), "template")}' for k, v in synthesis.DOMAINS.items())} END AS template FROM b)
SELECT i AS id, domain, template, {D.case(*((f'domain = {D.q(k)}', D.q(v[1])) for k, v in synthesis.DOMAINS.items()), other='NULL')} AS content_type, {D.case(*((f'domain = {D.q(k)}', D.q(v[2])) for k, v in synthesis.DOMAINS.items()), other='NULL')} AS language,
  {D.case(*((f'domain = {D.q(k)}', D.q(v[3])) for k, v in synthesis.DOMAINS.items()), other='NULL')} AS difficulty, {D.case(*((f'template = {D.q(n)}', D.q(t)) for v in synthesis.DOMAINS.values() for n, t in v[4].items()), other='NULL')} AS content FROM c"""
_TASKED = {"javascript": ["function_creation", "api_integration"], "xml": ["configuration"], "html": ["page_structure"]}
GEN5 = f"""WITH a AS (SELECT i, {D.draw('i::VARCHAR', D.q(':language'))} AS u FROM (SELECT doc_id AS i FROM documents) r), b AS (SELECT *, CASE WHEN u < 0.4 THEN 'javascript' WHEN u < 0.65 THEN 'typescript' WHEN u < 0.85 THEN 'xml' WHEN u < 0.95 THEN 'html' ELSE 'mdx' END AS language FROM a),
c AS (SELECT *, CASE language {' '.join(f'WHEN {D.q(k)} THEN {_PICK(v, "task")}' for k, v in _TASKED.items())} END AS task_type FROM b),
d AS (SELECT *, {D.case(*((f'language = {D.q(k[0])} AND task_type = {D.q(k[1])}', _PICK(v, 'template')) for k, v in synthesis.TEMPLATES.items()), other='NULL')} AS t, {D.case(*((f'task_type = {D.q(k)}', _PICK(v, 'fill')) for k, v in synthesis.FILLS.items()), other='NULL')} AS f FROM c WHERE task_type IS NOT NULL)
SELECT i AS id, language, task_type, replace(t, '{{}}', f) AS instruction FROM d"""
GEN6 = f"SELECT i AS id, 'self_instruct' AS task_type, {_PICK(synthesis.SELF, 'self')} AS instruction FROM (SELECT doc_id AS i FROM documents) r UNION ALL SELECT i, 'evol_instruct', 'Write a small function ' || {_PICK(synthesis.EVOL, 'evol')} FROM (SELECT doc_id AS i FROM documents) r"


def _ids(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select(F.col("doc_id").alias("id"))


def regions(s: SparkSession, d: str) -> DataFrame:
    """A question for each nation: its region, and three others."""
    names = table(s, d, "region").agg(F.transform(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name"))), lambda x: x["r_name"]).alias("names"))  # 5 names
    options = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.get("names", ((F.col("n_regionkey") + k) % F.size("names")).cast("int")))
    rows = table(s, d, "nation").crossJoin(F.broadcast(names))
    return rows.select(F.col("n_nationkey").cast("long").alias("id"), F.lit("geography").alias("domain"), F.concat(F.lit("In which region is "), "n_name", F.lit("?")).alias("question"), options.alias("options"), F.lit(0).alias("answer"))


def _gen(df: DataFrame) -> DataFrame:
    return df.withColumn("operations", F.array_join("operations", ",")).withColumn("content", F.sha2("content", 256))


def queries() -> dict[str, Query]:
    cur, base = (lambda s, d: _metric(s, d, True, "current")), (lambda s, d: _metric(s, d, False, "baseline"))
    reqs = lambda s, d: table(s, d, "nation").select(F.col("n_regionkey").cast("string").alias("platform"), F.concat(F.lit("test_"), F.col("n_nationkey").cast("string")).alias("test"))
    by = lambda s, d: detected(s, d).groupBy("language", "found").agg(F.count("*").alias("n"))
    return {
        "agg12_consistency": lambda s, d: _rounded(validation.consistency(by(s, d)), "consistency"),
        "agg15_weighted": lambda s, d: _rounded(E.weighted_mean(table(s, d, "events").groupBy("event_type").agg(F.avg("value").alias("v"), F.count("*").alias("w")), "v", "w"), "score"),
        "agg17_humaneval_proxy": lambda s, d: contents(s, d).agg(F.round(F.coalesce(F.avg(validation.humaneval_proxy(F.col("content"))), F.lit(0.5)), 6).alias("score")),
        "agg17_codebleu_proxy": lambda s, d: contents(s, d).agg(F.round(F.coalesce(F.avg(validation.codebleu_proxy(F.col("content"))), F.lit(0.5)), 6).alias("score")),
        "agg18_pass_at_k_reference": lambda s, d: _rounded(E.pass_at_k(completions(s, d), [1, 5, 10]), "pass_at_k"),
        "agg18_pass_at_k_unbiased": lambda s, d: _rounded(E.pass_at_k_unbiased(completions(s, d), [1, 2, 3]), "pass_at_k"),
        "agg18_pass_at_1_unbiased": lambda s, d: _rounded(E.pass_at_1(completions(s, d)), "pass_at_1"),
        "agg19_pass_at_k_match": lambda s, d: _rounded(E.match_at_k(predictions(s, d), [1, 2, 3]), "pass_at_k"),
        "agg20_difficulty": lambda s, d: E.difficulty(completions(s, d)),
        "agg21_micro_macro": lambda s, d: _rounded(E.micro_macro(completions(s, d)), "micro", "macro"),
        "agg22_mcq_accuracy": lambda s, d: _rounded(E.mcq_accuracy(answers(s, d)), "accuracy", "right_length", "wrong_length"),
        "agg23_exact_match": lambda s, d: _rounded(E.exact_match(predictions(s, d), "p", "r"), "exact"),
        "agg24_micro_validity": lambda s, d: _rounded(E.validity(completions(s, d)), "validity"),
        "agg24_weighted_codebleu": lambda s, d: _rounded(E.weighted_score(pairs(s, d).select((F.col("conv_id") % 3).alias("language"), S.codebleu_lite(F.col("instruction"), F.col("output")).alias("score"))), "overall"),
        "agg29_runs": lambda s, d: _rounded(E.run_summary(runs(s, d)), *(f"{a}_{b}" for a in ("mean", "std", "min", "max") for b in ("best_metric", "duration", "best_step")), "success_rate"),
        "agg30_catalog": lambda s, d: E.version_stats(versions(s, d)),
        "agg31_gate_averages": lambda s, d: _rounded(E.metric_averages(table(s, d, "events").select(_named(GATE_METRICS, F.col("event_id")).alias("name"), "value")), "avg_generation_time", "avg_memory_usage", "avg_success_rate"),
        "dup1_minhash": lambda s, d: minhash.keep_first(table(s, d, "documents"), "doc_id", "text"),
        "dup4_keep_best": dup4,
        "flt13_successful_runs": lambda s, d: E.successful(runs(s, d)).select("run", "best_metric"),
        "gen2_evolved": lambda s, d: _gen(synthesis.evol_rows(_ids(s, d))),
        "gen3_mutated": lambda s, d: _gen(synthesis.mutation_rows(_ids(s, d))),
        "gen4_domains": lambda s, d: synthesis.domain_rows(_ids(s, d)),
        "gen5_instructions": lambda s, d: synthesis.instruction_rows(_ids(s, d)),
        "gen6_extra_instructions": lambda s, d: synthesis.extra_instructions(_ids(s, d)),
        "gen8_questions": lambda s, d: synthesis.questions(regions(s, d), 4).withColumn("options", F.array_join("options", "|")),
        "set2_all_methods": lambda s, d: synthesis.all_methods(_ids(s, d)).groupBy("generation_method", "language").agg(F.count("*").alias("n")),
        "jon1_metric_compare": lambda s, d: _rounded(E.compared(cur(s, d), base(s, d)), "difference", "percent"),
        "jon2_all_baselines": lambda s, d: _rounded(E.against_all(cur(s, d), _baselines(s, d)), "difference"),
        "jon3_distribution_outer": lambda s, d: _rounded(validation.distribution_outer(by(s, d), EXPECTED), "actual", "expected"),
        "jon5_lsh_probe": lambda s, d: minhash.probe(table(s, d, "documents"), "doc_id", "text"),
        "jon6_positional_zip": jon6,
        "jon8_platform_matrix": lambda s, d: E.platform_matrix(gates(s, d), reqs(s, d)),
        "jon10_contamination": jon10,
        "prj1_content_fallback": lambda s, d: table(s, d, "documents").select("doc_id", F.sha2(E.first_text(F.when(F.col("doc_id") % 3 == 0, F.col("text")), F.when(F.col("doc_id") % 3 == 1, F.col("source")).otherwise(""), F.col("lang")), 256).alias("content")),
        "prj4_language_compat": lambda s, d: detected(s, d).select("src", "id", L.compatible(F.col("language"), F.col("found")).alias("compatible")),
        "prj21_semver_parse": lambda s, d: E.parsed_versions(versions(s, d)),
        "prj22_commit_category": lambda s, d: table(s, d, "conversations").select("conv_id", "turn", E.commit_category(F.coalesce("text", F.lit(""))).alias("category")),
        "rpt1_validation_suite": lambda s, d: _rounded(validation.suite(examples(s, d), EXPECTED), "score"),
        "rpt2_recommendations": lambda s, d: validation.recommendations(validation.suite(examples(s, d), EXPECTED)),
        "rpt4_regressions": lambda s, d: _rounded(E.regressions(cur(s, d), base(s, d)), "degradation"),
        "rpt5_improvements": lambda s, d: E.improvements(cur(s, d), base(s, d)),
        "rpt8_gate_run": lambda s, d: E.gate_run(gates(s, d)),
        "rpt9_readiness": lambda s, d: E.readiness(gates(s, d)),
        "rpt10_grades": rpt10,
        "rpt12_instruction_report": rpt12,
        "rpt13_alerts": lambda s, d: _rounded(validation.alerts(_daily(s, d), "event_type", "d", "v"), "drop"),
        "sco41_memory": lambda s, d: E.memory_estimate(table(s, d, "part").select((F.col("p_retailprice") * 1000).alias("params")).distinct(), "params"),
        "src10_mock_source": lambda s, d: mock_rows(_ids(s, d)).drop("content"),
        "src11_template_source": lambda s, d: mock_rows(_ids(s, d)).groupBy("language").agg(F.count("*").alias("n"), F.count_distinct("content").alias("texts"), F.min("size").alias("size")),
        "srt2_top_runs": lambda s, d: E.best_runs(runs(s, d)).select("run", "best_metric"),
        "srt4_semver_order": lambda s, d: E.ordered_versions(versions(s, d)),
        "win2_running_rate": win2,
    }


def oracle_sql() -> dict[str, str]:
    r6 = lambda x: f"round(({x})::DOUBLE, 6)"
    stats = ", ".join(f"{r6(f'{fn}(CASE WHEN success THEN {c} END)')} AS {n}_{c}" for c in ("best_metric", "duration", "best_step") for n, fn in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max")))
    first = f"WITH {COMPLETIONS}, c AS (SELECT problem, count(CASE WHEN passed AND i <= 5 THEN 1 END) AS n, avg(passed::INT) AS rate, avg(valid::INT) AS v FROM p GROUP BY problem)"
    advice = [(k, False) for k in validation.WEIGHTS if k in validation.ADVICE] + [(k, True) for k in validation.LOW_ADVICE]
    arms = " UNION ALL ".join(f"SELECT {n} AS place, {D.q((validation.LOW_ADVICE if low else validation.ADVICE)[k])} AS advice FROM o WHERE test = {D.q(k)} AND {'score < 0.8' if low else 'NOT passed'}" for n, (k, low) in enumerate(advice))
    from ..sources.mock import TEMPLATES

    mock = ", ".join(f"({D.q(k)}, {D.q(x)}, {len(c)})" for k, (c, x) in TEMPLATES.items())
    methods = f"SELECT 'evol_instruct' AS generation_method, CASE WHEN starts_with(base, '<') THEN 'html' WHEN contains(base, 'interface') THEN 'typescript' ELSE 'javascript' END AS language FROM ({GEN2}) UNION ALL SELECT 'ast_mutation', language FROM ({GEN3}) UNION ALL SELECT 'domain_specific', language FROM ({GEN4})"
    hits = lambda x, ps: D.any_of(x, ps)
    return {
        "agg12_consistency": f"WITH {CONTENTS}, {_FOUND} SELECT {r6('avg(rate)')} AS consistency FROM (SELECT avg((language = found)::INT) AS rate FROM f GROUP BY language)",
        "agg15_weighted": f"SELECT {r6('sum(v * w) / sum(w)')} AS score FROM (SELECT avg(value) AS v, count(*) AS w FROM events GROUP BY event_type)",
        "agg17_humaneval_proxy": f"WITH {CONTENTS} SELECT {r6(_HUMANEVAL)} AS score FROM c",
        "agg17_codebleu_proxy": f"WITH {CONTENTS} SELECT {r6(_CODEBLEU)} AS score FROM c",
        "agg18_pass_at_k_reference": f"{first} SELECT k, {r6('avg((n >= k)::INT)')} AS pass_at_k FROM c, (VALUES (1), (5), (10)) AS v(k) GROUP BY k",
        "agg18_pass_at_k_unbiased": f"""WITH {COMPLETIONS}, c AS (SELECT problem, count(*) AS n, count(CASE WHEN passed THEN 1 END) AS c FROM p GROUP BY problem),
x AS (SELECT k, CASE WHEN c = 0 THEN 0.0::DOUBLE WHEN n - c < k THEN 1.0 ELSE 1 - list_reduce(list_prepend(1.0::DOUBLE, list_transform(range(n - c + 1, n + 1), lambda i: (1 - k::DOUBLE / i)::DOUBLE)), lambda a, b: a * b) END AS chance FROM c, (VALUES (1), (2), (3)) AS v(k) WHERE n >= k)
SELECT k, {r6('avg(chance)')} AS pass_at_k FROM x GROUP BY k""",
        "agg18_pass_at_1_unbiased": f"{first} SELECT {r6('avg(rate)')} AS pass_at_1 FROM c",
        "agg19_pass_at_k_match": f"WITH {PREDICTIONS}, h AS (SELECT k, q, max((i <= k AND lower(trim(p)) = lower(trim(r)))::INT) AS hit FROM p, (VALUES (1), (2), (3)) AS v(k) GROUP BY k, q) SELECT k, {r6('avg(hit)')} AS pass_at_k FROM h GROUP BY k",
        "agg20_difficulty": f"{first} SELECT problem, CASE WHEN rate > 0.5 THEN 'easy' WHEN rate >= 0.1 THEN 'medium' ELSE 'hard' END AS difficulty FROM c",
        "agg21_micro_macro": f"{first} SELECT (SELECT {r6('avg(passed::INT)')} FROM p) AS micro, {r6('avg(v)')} AS macro FROM c",
        "agg22_mcq_accuracy": f"WITH {ANSWERS} SELECT domain, count(*) AS n, {r6('avg(CASE WHEN picked = answer THEN 1 ELSE 0 END)')} AS accuracy, count(*) FILTER (picked IS NULL) AS unanswered, {r6('avg(length(question)) FILTER (picked = answer)')} AS right_length, {r6('avg(length(question)) FILTER (picked IS NULL OR picked <> answer)')} AS wrong_length FROM m GROUP BY domain",
        "agg23_exact_match": f"WITH {PREDICTIONS} SELECT {r6('avg((lower(trim(p)) = lower(trim(r)))::INT)')} AS exact FROM p",
        "agg24_micro_validity": f"{first} SELECT problem, {r6('v')} AS validity FROM c UNION ALL SELECT 'all', {r6('avg(valid::INT)')} FROM p",
        "agg24_weighted_codebleu": f"WITH {PAIRS} SELECT {r6('avg(' + PAIR_SCORES['sco24_codebleu_lite'][1] + ')')} AS overall, count(*) AS samples FROM q",
        "agg29_runs": f"WITH {RUNS} SELECT count(*) AS runs, count(*) FILTER (success) AS successful, {r6('avg(success::INT)')} AS success_rate, {stats} FROM r",
        "agg30_catalog": f"WITH {VERSIONS} SELECT count(*) AS n, count(DISTINCT major) AS majors, count(DISTINCT (major, minor)) AS minors, count(prerelease) AS prereleases, count(*) - count(prerelease) AS stable FROM s",
        "agg31_gate_averages": f"WITH m AS (SELECT {_names(GATE_METRICS, 'event_id')} AS name, value FROM events) SELECT {r6('avg(value) FILTER (name = ' + D.q('avg_inference_time') + ')')} AS avg_generation_time, {r6('avg(value) FILTER (name = ' + D.q('memory_usage_peak') + ')')} AS avg_memory_usage, {r6('avg(value) FILTER (name = ' + D.q('success_rate') + ')')} AS avg_success_rate FROM m",
        "dup4_keep_best": DUP4,
        "flt13_successful_runs": f"WITH {RUNS} SELECT run, best_metric FROM r WHERE success",
        "gen2_evolved": GEN2,
        "gen3_mutated": GEN3,
        "gen4_domains": GEN4,
        "gen5_instructions": GEN5,
        "gen6_extra_instructions": GEN6,
        "gen8_questions": """WITH r AS (SELECT list(r_name ORDER BY r_regionkey) AS names FROM region), t AS (SELECT range AS turn FROM range(4))
SELECT n_nationkey::BIGINT AS id, turn::INT AS turn, 'geography' AS domain, 'In which region is ' || n_name || '?' AS question,
  array_to_string(list_transform(range(4), lambda k: names[(n_regionkey + (k + turn) % 4) % len(names) + 1]), '|') AS options, ((4 - turn) % 4)::INT AS answer FROM nation, r, t""",
        "set2_all_methods": f"SELECT generation_method, language, count(*) AS n FROM ({methods}) GROUP BY 1, 2",
        "jon1_metric_compare": f"WITH {METRIC} SELECT metric, {r6('current - baseline')} AS difference, {r6('pct')} AS percent, current > baseline AS improved, abs(pct) > 5 AS significant FROM bb",
        "jon2_all_baselines": f"WITH {METRIC}, b AS (SELECT event_type AS name, metric, avg(value) AS baseline FROM m GROUP BY 1, 2) SELECT metric, name, {r6('current - b.baseline')} AS difference FROM cur JOIN b USING (metric)",
        "jon3_distribution_outer": f"WITH {CONTENTS}, {_FOUND}, e AS (SELECT * FROM f), {_EXPECTED}, {_ACTUAL} SELECT language, {r6('coalesce(actual, 0)')} AS actual, {r6('coalesce(expected, 0)')} AS expected FROM a FULL JOIN x USING (language)",
        "jon5_lsh_probe": JON5,
        "jon6_positional_zip": "WITH a AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, doc_id AS id, length(coalesce(text, '')) AS n FROM documents), b AS (SELECT row_number() OVER (ORDER BY page_id) - 1 AS place, page_id AS ref_id, length(coalesce(html, '')) AS m FROM pages) SELECT place, id, ref_id, (n - m)::INT AS difference FROM a JOIN b USING (place)",
        "jon8_platform_matrix": f"WITH {GATES}, t AS (SELECT test, min(status) AS status FROM g GROUP BY test) SELECT n_regionkey::VARCHAR AS platform, count(*) AS needed, count(*) FILTER (status = 'passed') AS passed, count(*) FILTER (status = 'passed') = count(*) AS ready FROM nation LEFT JOIN t ON test = 'test_' || n_nationkey GROUP BY n_regionkey",
        "jon10_contamination": f"WITH d AS ({_grams('documents', 'doc_id', 13)}), b AS (SELECT DISTINCT g FROM ({_grams('benchmark', 'item_id', 13)}) y) SELECT doc_id, count(*) AS runs FROM d SEMI JOIN b USING (g) GROUP BY doc_id",
        "prj1_content_fallback": "SELECT doc_id, sha256(coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN text END, ''), nullif(CASE WHEN doc_id % 3 = 1 THEN source ELSE '' END, ''), nullif(lang, ''), '')) AS content FROM documents",
        "prj4_language_compat": f"WITH {CONTENTS}, {_FOUND} SELECT src, id, {' OR '.join(f'(language, found) IN (({D.q(a)}, {D.q(b)}), ({D.q(b)}, {D.q(a)}))' for a, b in L.COMPATIBLE)} AS compatible FROM f",
        "prj21_semver_parse": f"WITH {VERSIONS} SELECT * FROM s",
        "prj22_commit_category": f"SELECT conv_id, turn, {D.case(*((hits('lower(coalesce(text, ' + D.q('') + '))', v), D.q(k)) for k, v in E.COMMITS.items()), other=D.q('improvements'))} AS category FROM conversations",
        "rpt1_validation_suite": f"{SUITE} SELECT test, {r6('score')} AS score, passed FROM o",
        "rpt2_recommendations": f"{SUITE}, x2 AS ({arms}) SELECT * FROM x2 UNION ALL SELECT 0, {D.q(validation.GOOD)} WHERE NOT EXISTS (SELECT 1 FROM x2)",
        "rpt4_regressions": f"WITH {METRIC}, h AS (SELECT *, metric IN ({', '.join(map(D.q, E.HIGHER_IS_BETTER))}) AS higher FROM bb) SELECT metric, {r6('abs(pct)')} AS degradation, CASE WHEN abs(pct) > CASE WHEN higher THEN 10 ELSE 20 END THEN 'high' ELSE 'medium' END AS severity FROM h WHERE (higher AND pct < -5) OR (NOT higher AND pct > 10)",
        "rpt5_improvements": f"WITH {METRIC} SELECT count(*) FILTER (current > baseline) AS improved, count(*) FILTER (current < baseline) AS worse FROM bb",
        "rpt8_gate_run": f"WITH {GATES} SELECT position, test, status FROM (SELECT *, coalesce(sum((required AND status = 'failed')::INT) OVER (ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM g) WHERE stopped = 0",
        "rpt9_readiness": f"WITH {GATES}, i AS (SELECT count(*) FILTER (required AND status <> 'passed') AS issues FROM g) SELECT issues, CASE issues WHEN 0 THEN 100 WHEN 1 THEN 75 ELSE 50 END AS readiness FROM i",
        "rpt10_grades": RPT10,
        "rpt12_instruction_report": f"WITH {GATED}, a AS (SELECT count(*) AS n, avg(unit::INT) AS u, avg(score) AS q FROM u) SELECT n, {r6('u')} AS unit_rate, {r6('q')} AS quality, n > 0 AS has_rows, coalesce(u >= 0.7, false) AS unit_pass, coalesce(round(q, 9) >= 0.75, false) AS quality_pass, n > 0 AND coalesce(u >= 0.7, false) AND coalesce(round(q, 9) >= 0.75, false) AS passed FROM a",
        "rpt13_alerts": f"WITH a AS (SELECT event_type, ts::DATE AS d, avg(value) AS v FROM events GROUP BY 1, 2), b AS (SELECT *, lag(v) OVER (PARTITION BY event_type ORDER BY d) AS p FROM a) SELECT event_type, d, {r6('(p - v) / p')} AS drop FROM b WHERE (p - v) / p > 0.1",
        "sco41_memory": "SELECT params, precision, params * b AS weights, params * b * 4 AS overhead, params * b * 5 AS total FROM (SELECT DISTINCT p_retailprice * 1000 AS params FROM part), (VALUES ('float32', 4.0::DOUBLE), ('float16', 2.0), ('bfloat16', 2.0), ('int8', 1.0), ('int4', 0.5)) AS v(precision, b)",
        "src10_mock_source": f"SELECT i AS id, language, 'repo_' || (i // 1000) AS source_repo, 'src/file_' || i || '.' || x AS file_path, n AS size, 'mit' AS license, sha256('code_' || i) AS sha256 FROM (SELECT doc_id AS i FROM documents) r, (VALUES {mock}) AS v(language, x, n)",
        "src11_template_source": f"SELECT language, (SELECT count(*) FROM documents) AS n, 1 AS texts, n AS size FROM (VALUES {mock}) AS v(language, x, n)",
        "srt2_top_runs": f"WITH {RUNS} SELECT run, best_metric FROM r WHERE success ORDER BY best_metric DESC, run LIMIT 5",
        "srt4_semver_order": f"WITH {VERSIONS} SELECT version, row_number() OVER (ORDER BY major, minor, patch, prerelease IS NULL, prerelease, version) AS position FROM (SELECT DISTINCT * FROM s)",
        "win2_running_rate": WIN2,
    }
