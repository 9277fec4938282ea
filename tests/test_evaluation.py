"""Cases by hand for evaluation, validation, parsers, rewrites, near duplicates and sinks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import rewrite, webdev
from textloom.operators import evaluation as E
from textloom.operators import markup, minhash, synthesis, validation
from textloom.sources import io, mock


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(("text", "want"), [("", True), ("([{}])", True), ("([)]", False), ("(", False), (")", False), (None, None)])
def test_brackets(spark, text, want):
    assert one(spark, markup.matched(F.col("t")), t=text) is want


def test_parsers_survive_anything(spark):
    texts = [None, "", "<![foo[x]]>", "<a>", "<a/>", "<!ENTITY x>", "\x00", "def f(: ", "x = 1", "[1, 2]", "<a b='1'><c><d/></c></a>", "(" * 3000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r for r in rows.select("i", markup.xml_details(F.col("t")).alias("x"), markup.html_details(F.col("t")).alias("h"), *(markup.parses_as(F.col("t"), k).alias(k) for k in ("xml", "python", "json"))).collect()}
    assert got[0].x.well_formed is None and got[0].h.valid is None and got[0].python is None
    assert got[10].x[:4] == (True, 3, 2, True) and got[4].xml and not got[3].xml and not got[5].xml
    assert not got[7].python and got[8].python and got[9].json and not got[11].python
    assert got[2].h.valid in (True, False)


def test_renamed_identifiers(spark):
    assert one(spark, rewrite.renamed(F.col("t")), t="let a = b; // x\nb += a /* c */ + é1") == "var_0 var_1 = var_2; var_2 += var_1 + é1"
    assert one(spark, rewrite.renamed(F.col("t")), t="") == "" and one(spark, rewrite.renamed(F.col("t")), t=None) is None


def test_extracted_functions():
    code = "x = 1\ndef add(a, b):\n    c = a + b\n\n    return c\nprint(add(1, 2))"
    assert rewrite.extract_function(code, "add") == "def add(a, b):\n    c = a + b\n\n    return c"
    assert rewrite.extract_function("var q; function go(x) { if (x) { y() } } z()", "go") == "function go(x) { if (x) { y() } }"
    assert rewrite.extract_function("go = function(x) { y", "go") == "go = function(x) { y"
    assert rewrite.extract_function("nothing", "go") == "nothing"


def test_special_tokens(spark):
    assert one(spark, rewrite.normalised(F.col("t"), lower=True), t="Plain  Words\n here") == "plain words here"
    assert "<js_func>" in one(spark, rewrite.special_tokens(F.col("t")), t="function f(a) { return 1; }")


def _jsx(text):
    """The rule in plain Python: tags end at the next blank, or at '>' where none follows."""
    open_tags = []
    for i, ch in enumerate(text):
        if ch != "<":
            continue
        if text[i + 1 : i + 2] == "/":
            end = text.find(">", i)
            if end >= 0 and open_tags and open_tags[-1] == text[i + 2 : end].strip():
                open_tags.pop()
        else:
            end = text.find(" ", i) if " " in text[i:] else text.find(">", i)
            name = text[i + 1 : end].strip().replace("/", "") if end >= 0 else ""
            open_tags += [name] if name else []
    return not open_tags


def test_jsx_tags(spark):
    cases = ["", "plain", "<a></a>", "<a><b></b></a>", "<a><b></a></b>", "<a >x</a >", "<div id='1'><p>x</p></div>", "a < b", "</a>", "<p>one two</p>", "<a><", "< a></a>", "<x><y></y></x> end"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r.i: r.v for r in rows.select("i", webdev.jsx_valid(F.col("t")).alias("v")).collect()}
    assert got == {i: _jsx(t.replace("'1'", "")) for i, t in enumerate(cases)}
    assert one(spark, webdev.jsx_valid(F.col("t")), t="<a><br/>") is True


def test_suite_without_rows(spark):
    empty = spark.createDataFrame([], "content string, language string, found string, quality double, instruction boolean")
    rows = validation.suite(empty, {"xml": 1.0}).collect()
    assert len(rows) == 8 and not any(r.passed for r in rows if r.score is None)


def test_recommendations(spark):
    results = spark.createDataFrame([("syntax_validity", 0.5, False), ("quality_distribution", 0.9, True)], "test string, score double, passed boolean")
    assert [r.advice for r in validation.recommendations(results).collect()] == [validation.ADVICE["syntax_validity"]]
    fine = results.withColumn("score", F.lit(0.9)).withColumn("passed", F.lit(True))
    assert [r.advice for r in validation.recommendations(fine).collect()] == [validation.GOOD]


def test_versions(spark):
    rows = spark.createDataFrame([(v,) for v in ("2.0.0", "1.10.3+b5", "1.2", "2.0.0-alpha", "2.0.0-beta")], "version string")
    assert [r.version for r in E.ordered_versions(rows).orderBy("position").collect()] == ["1.2", "1.10.3+b5", "2.0.0-alpha", "2.0.0-beta", "2.0.0"]


def test_positions_of_unequal_sides(spark):
    a = spark.createDataFrame([(k * 3, k) for k in range(50)], "id long, n int").repartition(7)
    b = spark.createDataFrame([(k * 5, k) for k in range(20)], "id long, n int").repartition(3)
    got = sorted((r.place, r.id, r.ref_id) for r in E.zipped(a, b, "id").collect())
    assert got == [(k, 3 * k, 5 * k) for k in range(20)]


def _greedy(rows, keys):
    """Keeps a text unless it shares a key with a kept one before it."""
    seen, kept = set(), []
    for i in sorted(rows):
        mine = keys.get(i, set())
        if not mine & seen:
            kept.append(i)
            seen |= mine
    return kept


def test_minhash_keeps_first(spark):
    r = random.Random(3)
    vocabulary, texts = [f"w{k}" for k in range(400)], {}
    base = [r.choices(vocabulary, k=60) for _ in range(12)]
    for i in range(120):
        x = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 6])):
            x[r.randrange(60)] = r.choice(vocabulary)
        texts[i] = " ".join(x)
    texts |= {500: "", 501: None, 502: "two words", 503: "Two  words"}
    docs = spark.createDataFrame(list(texts.items()), "id long, t string")
    keys = {}
    for k in minhash.band_keys(docs, "id", "t").collect():
        keys.setdefault(k.doc, set()).add((k.band, k.key))
    want = [i for i in _greedy(texts, keys) if i not in (501, 503)]  # equal to 500 and 502
    assert sorted(x.doc for x in minhash.keep_first(docs, "id", "t").collect()) == want
    assert minhash.keep_first(docs.limit(0), "id", "t").count() == 0


def test_minhash_recall(spark):
    r = random.Random(4)
    rows, near = [], []
    for i in range(150):  # pairs of a Jaccard of 0.8 to 0.9
        x = [f"w{r.randrange(10**6)}" for _ in range(200)]
        y = x[:185] + [f"v{r.randrange(10**6)}" for _ in range(15)]
        a, b = ({tuple(t[k : k + 5]) for k in range(196)} for t in (x, y))
        if len(a & b) >= 0.8 * len(a | b):
            near.append((2 * i, 2 * i + 1))
        rows += [(2 * i, " ".join(x)), (2 * i + 1, " ".join(y))]
    first = {x.doc: x.first for x in minhash.probe(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()}
    assert len(near) > 100 and sum(first[b] == a for a, b in near) >= 0.9 * len(near)
    assert sum(first[a] != a for a, _ in near) == 0


def test_questions_keep_the_right_option(spark):
    bank = [(1, "d", "q1", ["a", "b", "c", "d"], 2), (2, "d", "q2", ["x", "y"], 0)]
    right = {q[2]: q[3][q[4]] for q in bank}
    rows = synthesis.questions(spark.createDataFrame(bank, "id long, domain string, question string, options array<string>, answer int"), 4).collect()
    assert len(rows) == 4 * len(right) and all(r.options[r.answer] == right[r.question] for r in rows)


def test_sinks(spark, tmp_path):
    stats = spark.createDataFrame([(3, 0.5)], "rows int, share double")
    io.write_stats(stats, f"{tmp_path}/stats.json")
    assert json.loads((tmp_path / "stats.json").read_text()) == {"rows": 3, "share": 0.5}
    io.write_duplicates(spark.createDataFrame([(1, 2), (1, 3)], "rep_id long, dup_id long"), f"{tmp_path}/dups")
    assert spark.read.json(f"{tmp_path}/dups").count() == 2
    report = io.phase_report({"a": stats, "b": stats.limit(0)}, {"quality": 0.9}, io.CorpusConfig(), 1.5, "2024-01-01 00:00:00")
    assert report["processing_statistics"]["total_processed"] == 1 and report["pipeline_summary"]["phases_completed"] == 2
    assert mock.mock_rows(spark.range(2), ["css", "zig"]).count() == 4
