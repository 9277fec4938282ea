"""The validation suite over examples, its recommendations, and alerts on metric drops.

One pass over the texts sums everything by metadata language and detected language; the seven tests
and the overall score come from these few rows. Without rows every score is null and no test passes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.text import balanced, count, strip

# fixed values: what the tests ask for, and their weights
LEAST = {"syntax_validity": 0.90, "semantic_coherence": 0.75, "task_completion": 0.85, "quality": 0.75, "quality_consistency": 0.8, "consistency": 0.8, "distribution": 0.7}
LENGTHS, LENGTH_STD = (100, 10_000), 5_000
BENCHMARKS = {"humaneval": 0.67, "codebleu": 0.65, "mmlu": 0.60}
WEIGHTS = {"syntax_validity": 0.3, "semantic_coherence": 0.3, "task_completion": 0.2, "language_consistency": 0.1, "quality_distribution": 0.1, "statistical_properties": 0.1, "performance_benchmarks": 0.2}
OVERALL = 0.8
# fixed values: what is recommended for a test that fails, and for low scores
ADVICE = {
    "syntax_validity": "Improve syntax validation - some examples have invalid syntax",
    "semantic_coherence": "Enhance semantic coherence - some examples lack logical flow",
    "task_completion": "Increase task completion rates - improve instruction-following quality",
    "language_consistency": "Improve language consistency - align metadata with detected languages",
    "quality_distribution": "Enhance quality distribution - increase average quality scores",
    "performance_benchmarks": "Improve performance benchmarks - enhance overall code quality",
}
LOW_ADVICE = {
    "quality_distribution": "Consider re-filtering low-quality examples to improve overall dataset quality",
    "language_consistency": "Review language detection and metadata assignment consistency",
}
GOOD = "Dataset quality is good - maintain current filtering standards"
# fixed values: declared alert thresholds
ALERTS = {"quality_drop": 0.1, "processing_failure": 0.05, "performance_degradation": 0.15}


def _one(cond: Column) -> Column:
    return cond.cast("int").cast("double")


def concepts(c: Column) -> list[Column]:
    """AGG16: whether a text has each of five concepts."""
    low = F.lower(c)
    has = lambda *parts: reduce(Column.__or__, [low.contains(p) for p in parts])
    return [has("variable", "let ", "const "), has("function"), has("class"), has("if", "for", "while"), has("array", "object", "list")]


def humaneval_proxy(c: Column) -> Column:
    """AGG17: the share of five marks, of texts with more than five line feeds; null for others."""
    marks = [c.contains("function"), c.contains("return"), c.contains("{") & c.contains("}"), F.length(c) > 50, balanced(c, "(", ")")]
    return F.when(count(c, "\n") > 5, sum((_one(m) for m in marks), F.lit(0.0)) / 5)


def codebleu_proxy(c: Column) -> Column:
    """AGG17: keyword coverage, syntax as of JavaScript and length, of texts that are not blank; null for others."""
    return F.when(strip(c) != "", (S.keyword_coverage(c) + S.validator_syntax(c, F.lit("javascript")) + F.least(F.length(c) / 1000, F.lit(1.0))) / 3)


def sums(examples: DataFrame) -> DataFrame:
    """By language and found: the sums that the suite needs. examples: content, language, found,
    quality (double), instruction (boolean)."""
    c, f = F.col("content"), F.col("found")
    n = F.length(c).cast("double")
    total = lambda x, name: F.coalesce(F.sum(x), F.lit(0.0)).alias(name)
    return examples.groupBy("language", "found").agg(
        F.count("*").alias("n"),
        total(_one(S.validator_syntax(c, f) >= 0.8), "valid"),
        total(S.validator_coherence(c), "coherence"),
        F.count(F.when(F.col("instruction"), 1)).alias("instructions"),
        total(_one(F.col("instruction") & (S.task_completion(c) >= 0.8)), "completed"),
        total(F.col("quality"), "quality"),
        total(F.col("quality") * F.col("quality"), "quality2"),
        total(n, "length"),
        total(n * n, "length2"),
        total(humaneval_proxy(c), "humaneval"),
        F.count(humaneval_proxy(c)).alias("humaneval_n"),
        total(codebleu_proxy(c), "codebleu"),
        F.count(codebleu_proxy(c)).alias("codebleu_n"),
        *(total(_one(x), f"concept{k}") for k, x in enumerate(concepts(c))),
    )


def consistency(by: DataFrame) -> DataFrame:
    """AGG12: the mean over metadata languages of the share of rows with that language detected. by: language, found, n."""
    per = by.groupBy("language").agg((F.sum(F.when(F.col("language") == F.col("found"), F.col("n")).otherwise(0)) / F.sum("n")).alias("rate"))
    return per.agg(F.coalesce(F.avg("rate"), F.lit(1.0)).alias("consistency"))


def distribution_cosine(by: DataFrame, expected: dict[str, float]) -> DataFrame:
    """AGG11, JON3: cosine of the detected languages' shares and the expected ones; languages of either side count. by: found, n."""
    shares = by.groupBy("found").agg(F.sum("n").alias("n"))
    target = F.create_map(*(x for k, v in expected.items() for x in (F.lit(k), F.lit(float(v)))))
    norm = sum(v * v for v in expected.values()) ** 0.5
    dot, size = F.sum(F.col("n") * F.coalesce(F.element_at(target, F.col("found")), F.lit(0.0))), F.sqrt(F.sum(F.col("n") * F.col("n")))
    return shares.agg(F.coalesce(F.try_divide(dot, size * norm), F.lit(0.0)).alias("cosine"))


def distribution_outer(by: DataFrame, expected: dict[str, float]) -> DataFrame:
    """JON3: actual and expected share of the languages of either side. by: found, n."""
    target = by.sparkSession.createDataFrame([(k, float(v)) for k, v in expected.items()], "language string, expected double")
    shares = by.groupBy("found").agg(F.sum("n").alias("n"))
    total = shares.agg(F.sum("n").alias("total"))
    actual = shares.join(F.broadcast(total)).select(F.col("found").alias("language"), (F.col("n") / F.col("total")).alias("actual"))  # total is one row
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return actual.join(target, "language", "full_outer").select("language", zero("actual"), zero("expected"))


def suite(examples: DataFrame, expected: dict[str, float]) -> DataFrame:
    """RPT1: test, score, passed of the seven tests, and 'overall'."""
    by = sums(examples).persist()  # a row for each two languages
    s = lambda name: F.sum(name)
    std = lambda a, b: F.sqrt(F.greatest(F.lit(0.0), s(b) / s("n") - (s(a) / s("n")) * (s(a) / s("n"))))
    share = lambda a, n, other: F.coalesce(F.try_divide(s(a), s(n)), F.lit(other))
    mmlu = sum((s(f"concept{k}") for k in range(5)), F.lit(0.0)) / (5 * s("n"))
    t = by.agg(
        (s("valid") / s("n")).alias("syntax"), (s("coherence") / s("n")).alias("coherence"), share("completed", "instructions", 1.0).alias("completion"), (s("quality") / s("n")).alias("quality"), std("quality", "quality2").alias("quality_std"),
        (s("length") / s("n")).alias("length"), std("length", "length2").alias("length_std"), share("humaneval", "humaneval_n", 0.5).alias("humaneval"), share("codebleu", "codebleu_n", 0.5).alias("codebleu"), mmlu.alias("mmlu"),
    )
    t = t.join(F.broadcast(consistency(by))).join(F.broadcast(distribution_cosine(by, expected)))  # a row each
    c = F.col
    steady = F.when(c("quality") > 0, 1 - c("quality_std") / c("quality")).otherwise(0.0)
    sized = c("length").between(*LENGTHS) & (c("length_std") <= LENGTH_STD)
    marks = [c(k) >= 0.9 * v for k, v in BENCHMARKS.items()]
    tests = {
        "syntax_validity": (c("syntax"), c("syntax") >= LEAST["syntax_validity"]),
        "semantic_coherence": (c("coherence"), c("coherence") >= LEAST["semantic_coherence"]),
        "task_completion": (c("completion"), c("completion") >= LEAST["task_completion"]),
        "language_consistency": ((c("consistency") + c("cosine")) / 2, (c("consistency") >= LEAST["consistency"]) & (c("cosine") >= LEAST["distribution"])),
        "quality_distribution": (c("quality"), (c("quality") >= LEAST["quality"]) & (steady >= LEAST["quality_consistency"])),
        "statistical_properties": (F.when(sized, 1.0).otherwise(0.5), sized),
        "performance_benchmarks": ((c("humaneval") + c("codebleu") + c("mmlu")) / 3, marks[0] & marks[1] & marks[2]),
    }
    overall = sum((tests[k][0] * w for k, w in WEIGHTS.items()), F.lit(0.0)) / sum(WEIGHTS.values())
    tests["overall"] = (overall, F.round(overall, 9) >= OVERALL)
    rows = F.array(*(F.struct(F.lit(k).alias("test"), a.alias("score"), F.coalesce(b, F.lit(False)).alias("passed")) for k, (a, b) in tests.items()))
    return t.select(F.explode(rows).alias("t")).select("t.*")


def recommendations(results: DataFrame) -> DataFrame:
    """RPT2: place and text of what the suite's results recommend. results: test, score, passed."""
    order = list(WEIGHTS)
    rules = [(k, k, False) for k in order if k in ADVICE] + [(k, k, True) for k in LOW_ADVICE]
    arms = []
    for place, (test, _, low) in enumerate(rules):
        cond = (F.col("test") == test) & ((F.coalesce("score", F.lit(0.0)) < 0.8) if low else ~F.col("passed"))
        arms.append(F.when(cond, F.struct(F.lit(place).alias("place"), F.lit((LOW_ADVICE if low else ADVICE)[test]).alias("advice"))))
    found = results.select(F.explode(F.array_compact(F.array(*arms))).alias("a")).select("a.*")
    good = found.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(0).alias("place"), F.lit(GOOD).alias("advice"))
    return found.unionByName(good)


def alerts(daily: DataFrame, key: str, order: str, value: str, threshold: float = ALERTS["quality_drop"]) -> DataFrame:
    """RPT13: steps whose value fell by more than ``threshold`` of the one before."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(order))
    rows = daily.withColumn("before", before).withColumn("drop", F.try_divide(F.col("before") - F.col(value), F.col("before")))
    return rows.where(F.col("drop") > threshold).select(key, order, "drop")
