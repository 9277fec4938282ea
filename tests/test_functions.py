"""Hand-computed cases of functions that the fixtures hardly reach."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.functions import language as L
from textloom.functions import scores as S
from textloom.operators import dedup, generate, markup


def one(spark, column, *values):
    names = [f"c{k}" for k in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return df.select(column(*map(F.col, names)).alias("x")).first().x


@pytest.mark.parametrize(("text", "score"), [("x" * 25, 0.5), ("x" * 50, 1.0), ("x" * 4000, 0.5), ("<" + "x" * 49, 0.5), ("function" + "x" * 4992, 1.0), ("", 0.0)])
def test_length_quality(spark, text, score):
    assert one(spark, S.length_quality, text) == pytest.approx(score)


def test_structure_quality(spark):
    assert one(spark, S.structure_quality, "f(") == pytest.approx(2 / 3)
    assert one(spark, S.structure_quality, "<a function class>") == 1.0


def test_language(spark):
    detect = lambda c, m: L.detect_language(c, m)
    assert one(spark, detect, "const a = () => 1", "en") == "javascript"
    assert one(spark, detect, "plain words", "en") == "en"
    assert one(spark, detect, "plain words", None) == "unknown"
    assert one(spark, lambda a, b: L.compatible(a, b), "ts", "js") is True


def test_task_completion_and_cyclomatic(spark):
    assert one(spark, S.task_completion, "function x return") == 0.9
    assert one(spark, S.task_completion, "class {") == 0.85
    assert one(spark, S.cyclomatic, "if (a && b) { for (;;) {} }") == 1 + 1 + 2 + 1


def test_keys(spark):
    assert one(spark, dedup.aggressive_key, "let a = 12; // x\n/* y */ 'q'") == 'identifier identifier = identifier; "identifier"'
    assert one(spark, lambda c, g: dedup.light_key(c, g), "A // b\nc", "JavaScript") == "a"


def test_keep_best_ties(spark):
    df = spark.createDataFrame([("k", 2, 1.0), ("k", 1, 1.0), ("k", 3, None), ("m", 4, None)], "key string, id long, score double")
    assert sorted(dedup.keep_best(df, "score").collect()) == [(1, 1.0), (4, None)]


def test_parsers():
    assert markup.xml_detail("<a x='1'><b/><c><d/></c></a>") == (True, 4, 2, True, 0)
    assert markup.xml_detail("<a>") == (False, 0, 0, False, 0)
    assert markup.html_detail("<html><head></head><body><font>x</font></body></html>") == (True, 4, True, True, ["title"], ["font"], False)


def test_draws_are_uniform(spark):
    u = spark.range(2000).select(generate.draw(F.col("id"), "t").alias("u")).toPandas().u
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.03


def test_plateau(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": ["a"] * 6, "d": range(6), "v": [5.0, 6, 6, 6, 6, 4]}))
    rates = [r.rate for r in generate.plateau_rate(df, "k", "d", "v").orderBy("step").collect()]
    assert rates == [0.1, 0.1, 0.1, 0.1, 0.05, 0.05]


def test_repetition_equals_counting_every_run(spark):
    import random

    from textloom.operators import generate

    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "b", "aa", "c d", "e"]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts += ["one two three four five " * 3 + "x", "xone two three four fivey " * 4, "", None, "w " * 40, " ".join(f"w{k}" for k in range(300))]

    def plain(t):
        w = t.split()
        return len(w) >= 10 and any(t.count(" ".join(w[k : k + 5])) > 2 for k in range(len(w) - 5))

    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", generate.repetitive(F.col("t")).alias("x")).collect()
    assert {r.i: r.x for r in rows if texts[r.i] is not None} == {k: plain(t) for k, t in enumerate(texts) if t is not None}
    assert {True, False} <= {r.x for r in rows}
