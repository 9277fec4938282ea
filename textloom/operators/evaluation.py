"""Evaluation of completions, predictions, runs, versions and gates, as functions of DataFrames.

Every function names the columns that it takes. Empty inputs give empty results, or the rows that a
total over nothing has; a rate over nothing is null unless its docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import parts_for, written

# fixed values: metrics that are better when higher, in percent what counts as a regression, and severe
HIGHER_IS_BETTER = ["accuracy", "pass_at_1", "tokens_per_second", "syntax_validity", "codebleu_score"]
DROP, RISE, SEVERE_DROP, SEVERE_RISE = -5.0, 10.0, 10.0, 20.0
# fixed values: commit categories by keyword, in order of precedence
COMMITS = {
    "features": ["feat", "add", "implement"],
    "fixes": ["fix", "bug", "issue"],
    "improvements": ["improve", "optimize", "enhance"],
    "breaking_changes": ["break", "remove", "change"],
    "documentation": ["doc", "readme", "comment"],
    "performance": ["perf", "speed"],
}
# fixed values: bytes of a parameter
PRECISIONS = {"float32": 4.0, "float16": 2.0, "bfloat16": 2.0, "int8": 1.0, "int4": 0.5}


def rate(cond: Column) -> Column:
    """The share of rows for which ``cond`` holds."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def same(a: Column, b: Column) -> Column:
    """Equal without case and outer blanks."""
    return F.lower(F.trim(a)) == F.lower(F.trim(b))


# --- completions: problem, i (from 1), valid, passed


def pass_at_k(completions: DataFrame, ks: list[int], stored: int = 5) -> DataFrame:
    """AGG18: share of problems of which at least k of the first ``stored`` completions pass."""
    per = completions.groupBy("problem").agg(F.count(F.when(F.col("passed") & (F.col("i") <= stored), 1)).alias("n"))
    shares = per.agg(*(rate(F.col("n") >= k).alias(str(k)) for k in ks))
    return shares.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, ks)), F.array(*(F.col(str(k)) for k in ks)))).alias("k", "pass_at_k"))


def pass_at_k_unbiased(completions: DataFrame, ks: list[int]) -> DataFrame:
    """AGG18, the published estimator: the mean over problems of the chance that k of their n completions,
    c of which pass, hold one that passes: 1 - the product of (1 - k / i) for i from n - c + 1 to n;
    problems of fewer than k completions are left out."""
    per = completions.groupBy("problem").agg(F.count("*").alias("n"), F.count(F.when(F.col("passed"), 1)).alias("c"))
    each = per.withColumn("k", F.explode(F.array(*map(F.lit, ks)))).where("n >= k")
    missed = F.aggregate(F.sequence(F.col("n") - F.col("c") + 1, F.col("n")), F.lit(1.0), lambda p, i: p * (1 - F.col("k") / i))
    chance = F.when(F.col("c") == 0, 0.0).when(F.col("n") - F.col("c") < F.col("k"), 1.0).otherwise(1 - missed)
    return each.groupBy("k").agg(F.avg(chance).alias("pass_at_k"))


def pass_at_1(completions: DataFrame) -> DataFrame:
    """The unbiased estimate: the mean over problems of the share of completions that pass."""
    return completions.groupBy("problem").agg(rate(F.col("passed")).alias("rate")).agg(F.avg("rate").alias("pass_at_1"))


def difficulty(completions: DataFrame) -> DataFrame:
    """AGG20: problems by the share of completions that pass."""
    r = F.col("rate")
    per = completions.groupBy("problem").agg(rate(F.col("passed")).alias("rate"))
    return per.select("problem", F.when(r > 0.5, "easy").when(r >= 0.1, "medium").otherwise("hard").alias("difficulty"))


def micro_macro(completions: DataFrame) -> DataFrame:
    """AGG21: passing completions of all, and the mean over problems of the share of valid ones."""
    per = completions.groupBy("problem").agg(F.sum(F.col("passed").cast("long")).alias("p"), F.count("*").alias("n"), rate(F.col("valid")).alias("v"))
    return per.agg((F.sum("p") / F.sum("n")).alias("micro"), F.avg("v").alias("macro"))


def validity(completions: DataFrame) -> DataFrame:
    """AGG24: valid completions of each problem and of all."""
    return completions.rollup("problem").agg(rate(F.col("valid")).alias("validity")).withColumn("problem", F.coalesce("problem", F.lit("all")))


def weighted_score(scores: DataFrame) -> DataFrame:
    """AGG24: per-language means of a score, weighted by samples. language, score."""
    per = scores.groupBy("language").agg(F.avg("score").alias("mean"), F.count("*").alias("n"))
    return per.agg(F.coalesce(F.try_divide(F.sum(F.col("mean") * F.col("n")), F.sum("n")), F.lit(0.0)).alias("overall"), F.sum("n").alias("samples"))


# --- predictions: q, i (from 1), p, r


def match_at_k(predictions: DataFrame, ks: list[int]) -> DataFrame:
    """AGG19: share of questions of which one of the first k predictions is the reference."""
    per = predictions.groupBy("q").agg(F.min(F.when(same(F.col("p"), F.col("r")), F.col("i"))).alias("first"))
    shares = per.agg(*(rate(F.col("first") <= k).alias(str(k)) for k in ks))
    return shares.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, ks)), F.array(*(F.col(str(k)) for k in ks)))).alias("k", "pass_at_k"))


def exact_match(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """AGG23."""
    return pairs.agg(rate(same(F.col(a), F.col(b))).alias("exact"))


def zipped(predictions: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """JON6: rows of both sides at the same place in the order of ``key``. Places come from counts
    of key ranges, so no task holds a whole side."""
    return _placed(predictions, key).join(_placed(references, key).withColumnsRenamed({c: f"ref_{c}" for c in references.columns}), "place")


def _placed(df: DataFrame, *order: str | Column) -> DataFrame:
    """``place``: a row's number in the order, from 0."""
    # a table, for ranges that are cut twice may be cut at other places
    rows = written(df.repartitionByRange(parts_for(df), *order).withColumn("_part", F.spark_partition_id()), "placed")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    starts = rows.groupBy("_part").count().withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return rows.withColumn("_own", own).join(F.broadcast(starts), "_part").withColumn("place", F.col("_start") + F.col("_own")).drop("_part", "_own", "_start")


def mcq_accuracy(answers: DataFrame) -> DataFrame:
    """AGG22: domain, question, picked (null: none), answer."""
    right = F.col("picked") == F.col("answer")
    n = F.length("question")
    return answers.groupBy("domain").agg(
        F.count("*").alias("n"), rate(right).alias("accuracy"), F.count(F.when(F.col("picked").isNull(), 1)).alias("unanswered"), F.avg(F.when(right, n)).alias("right_length"), F.avg(F.when(~F.coalesce(right, F.lit(False)), n)).alias("wrong_length")
    )


# --- metrics: metric, current and metric, baseline


def _percent() -> Column:
    return F.when(F.col("baseline") == 0, 0.0).otherwise(100.0 * (F.col("current") - F.col("baseline")) / F.col("baseline"))


def compared(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """JON1, RPT3: metrics of both sides, with difference, percent, improvement and significance."""
    both = current.join(baseline, "metric").withColumn("percent", _percent())
    return both.select("metric", (F.col("current") - F.col("baseline")).alias("difference"), "percent", (F.col("current") > F.col("baseline")).alias("improved"), (F.abs("percent") > 5).alias("significant"))


def against_all(current: DataFrame, baselines: DataFrame) -> DataFrame:
    """JON2: every metric against every named baseline that has it. baselines: name, metric, baseline."""
    return current.join(baselines, "metric").select("metric", "name", (F.col("current") - F.col("baseline")).alias("difference"))


def regressions(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """RPT4: metrics that got worse; those outside the list are better when lower."""
    higher, p = F.col("metric").isin(HIGHER_IS_BETTER), F.col("percent")
    worse = current.join(baseline, "metric").withColumn("percent", _percent()).where((higher & (p < DROP)) | (~higher & (p > RISE)))
    severe = F.abs(p) > F.when(higher, SEVERE_DROP).otherwise(SEVERE_RISE)
    return worse.select("metric", F.abs(p).alias("degradation"), F.when(severe, "high").otherwise("medium").alias("severity"))


def improvements(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """RPT5: how many metrics rose, and fell."""
    both = current.join(baseline, "metric")
    return both.agg(F.count(F.when(F.col("current") > F.col("baseline"), 1)).alias("improved"), F.count(F.when(F.col("current") < F.col("baseline"), 1)).alias("worse"))


def weighted_mean(scores: DataFrame, score: str, weight: str) -> DataFrame:
    """AGG15."""
    return scores.agg((F.sum(F.col(score) * F.col(weight)) / F.sum(weight)).alias("score"))


# --- runs: run, success, best_metric, best_step, duration


def successful(runs: DataFrame) -> DataFrame:
    """FLT13."""
    return runs.where("success")


def best_runs(runs: DataFrame, n: int = 5, shortest: bool = False) -> DataFrame:
    """SRT2: the n successful runs of the largest metric, or of the shortest time."""
    return successful(runs).orderBy(F.asc("duration") if shortest else F.desc("best_metric"), "run").limit(n)


def run_summary(runs: DataFrame) -> DataFrame:
    """AGG29: success rate, and of successful runs mean, std, min and max of three figures."""
    ok = lambda c: F.when(F.col("success"), F.col(c))
    figures = [f(ok(c)).alias(f"{name}_{c}") for c in ("best_metric", "duration", "best_step") for name, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))]
    return runs.agg(F.count("*").alias("runs"), F.count(F.when(F.col("success"), 1)).alias("successful"), rate(F.col("success")).alias("success_rate"), *figures)


# --- versions


def semver(version: Column) -> dict[str, Column]:
    """PRJ21: major.minor[.patch][-prerelease][+build]."""
    plain = F.split_part(version, F.lit("+"), F.lit(1))
    core = F.split_part(plain, F.lit("-"), F.lit(1))
    part = lambda k: F.split_part(core, F.lit("."), F.lit(k))
    return {
        "major": part(1).cast("int"),
        "minor": part(2).cast("int"),
        "patch": F.coalesce(F.nullif(part(3), F.lit("")), F.lit("0")).cast("int"),
        "prerelease": F.when(plain.contains("-"), F.regexp_extract(plain, "^[^-]*-(.*)$", 1)),
        "build": F.when(version.contains("+"), F.regexp_extract(version, "^[^+]*[+](.*)$", 1)),
    }


def parsed_versions(df: DataFrame, version: str = "version") -> DataFrame:
    return df.select(version, *(v.alias(k) for k, v in semver(F.col(version)).items()))


def ordered_versions(df: DataFrame, version: str = "version") -> DataFrame:
    """SRT4: distinct versions and their places; one without prerelease follows those with one."""
    rows = parsed_versions(df.select(version).distinct(), version)
    placed = _placed(rows, "major", "minor", "patch", F.col("prerelease").isNull(), "prerelease", version)
    return placed.select(version, (F.col("place") + 1).cast("int").alias("position"))


def version_stats(df: DataFrame, version: str = "version") -> DataFrame:
    """AGG30."""
    pre = F.count("prerelease")
    return parsed_versions(df, version).agg(F.count("*").alias("n"), F.count_distinct("major").alias("majors"), F.count_distinct("major", "minor").alias("minors"), pre.alias("prereleases"), (F.count("*") - pre).alias("stable"))


# --- gates: position, test, required, status, score


def gate_run(gates: DataFrame) -> DataFrame:
    """RPT8: the tests that run, in order; a required one that fails ends the run."""
    failed = F.min(F.when(F.col("required") & (F.col("status") == "failed"), F.col("position")))
    stop = gates.agg(failed.alias("stop"))  # one row; null: none failed
    return gates.join(F.broadcast(stop), F.coalesce(F.col("position") <= F.col("stop"), F.lit(True))).select("position", "test", "status")


def readiness(gates: DataFrame) -> DataFrame:
    """RPT9: required tests that do not pass, and what that leaves of 100."""
    issues = F.count(F.when(F.col("required") & (F.col("status") != "passed"), 1))
    return gates.agg(issues.alias("issues")).withColumn("readiness", F.when(F.col("issues") == 0, 100).when(F.col("issues") == 1, 75).otherwise(50))


def platform_matrix(gates: DataFrame, requirements: DataFrame) -> DataFrame:
    """JON8: of each platform the required tests, how many pass, and whether all do. requirements: platform, test."""
    passed = F.count(F.when(F.col("status") == "passed", 1))
    states = gates.groupBy("test").agg(F.min("status").alias("status"))  # failed before passed
    return requirements.join(states, "test", "left").groupBy("platform").agg(F.count("*").alias("needed"), passed.alias("passed"), (passed == F.count("*")).alias("ready"))


def metric_averages(metrics: DataFrame) -> DataFrame:
    """AGG31: averages of gate metrics by name: inference time, memory usage, success rate; null without any. name, value."""
    n, v = F.col("name"), F.col("value")
    return metrics.agg(
        F.avg(F.when(n == "avg_inference_time", v)).alias("avg_generation_time"),
        F.avg(F.when(n.contains("memory") & n.contains("usage") & (n != "avg_inference_time"), v)).alias("avg_memory_usage"),
        F.avg(F.when(n == "success_rate", v)).alias("avg_success_rate"),
    )


# --- columns


def first_text(*columns: Column) -> Column:
    """PRJ1: the first that is not empty, else the empty text."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit(""))


def commit_category(message: Column) -> Column:
    """PRJ22: the first category with a keyword in the message, else improvements."""
    low, out = F.lower(message), None
    for name, parts in COMMITS.items():
        hit = F.lit(False)
        for p in parts:
            hit |= low.contains(p)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("improvements")


def memory_estimate(models: DataFrame, params: str) -> DataFrame:
    """SCO41: weights, four times as much overhead and their sum for each precision."""
    kinds = F.array(*(F.struct(F.lit(k).alias("precision"), F.lit(v).alias("bytes")) for k, v in PRECISIONS.items()))
    each = models.withColumn("p", F.explode(kinds))
    w = F.col(params) * F.col("p.bytes")
    return each.select(params, "p.precision", w.alias("weights"), (w * 4).alias("overhead"), (w * 5).alias("total"))


def speed_grade(tokens_per_second: Column) -> Column:
    """RPT10: A above 50, B above 30, else C."""
    return F.when(tokens_per_second > 50, "A").when(tokens_per_second > 30, "B").otherwise("C")


def benchmark_grades(tokens_per_second: Column, size_mb: Column) -> dict[str, Column]:
    """RPT10: overall score of speed and size, performance and memory grades; a missing figure scores 0."""
    speed = F.coalesce(F.least(F.lit(100.0), tokens_per_second / 10 * 50), F.lit(0.0))
    memory = F.coalesce(F.greatest(F.lit(0.0), 100 - size_mb / 3000 * 50), F.lit(0.0))
    score = (speed + memory) / 2
    grade = F.when(score >= 80, "Excellent").when(score >= 60, "Good").when(score >= 40, "Fair").otherwise("Poor")
    return {"score": score, "performance": grade, "memory": F.when(memory >= 60, "Good").otherwise("Fair"), "accelerate": speed < 40, "quantise": memory < 40}
