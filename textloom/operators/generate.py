"""Row generators with deterministic draws, prompts, cleaning and small folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bind, strip, words

# fixed values: what is removed from code, and the two rewrites of comments
REMOVED = [r"//\s*TODO[^\n]*", r"/\*.*TODO.*\*/", r"console\.log[^\n]*", r"alert\([^\)]*\)", "debugger;"]
REWRITTEN = [(r"/\*\s*\*\s*([^}]+)\s*\*/", "/** $1 */"), (r"//\s*([^/]+)//", "// $1")]


def draw(key: Column, salt: str) -> Column:
    """A uniform number from 0 to 1 that depends on the key and the salt alone."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{salt}"))), 1, 8), 16, 10).cast("double") / 4294967296.0


def weighted(u: Column, shares: dict[str, float]) -> Column:
    """SRT8: the choice whose cumulative share ``u`` falls into."""
    out, at, last = None, 0.0, list(shares)[-1]
    for name, share in list(shares.items())[:-1]:
        at += share
        out = F.when(u < round(at, 9), name) if out is None else out.when(u < round(at, 9), name)
    return out.otherwise(last)


def templated(rows: DataFrame) -> DataFrame:
    """GEN1: for each id a drawn difficulty and language, and an instruction made of them."""
    rows = rows.select("id").withColumn("difficulty", weighted(draw(F.col("id"), "difficulty"), {"beginner": 0.3, "intermediate": 0.5, "advanced": 0.2}))
    rows = rows.withColumn("language", weighted(draw(F.col("id"), "language"), {"javascript": 0.6, "typescript": 0.3, "css": 0.1}))
    return rows.withColumn("instruction", F.concat(F.lit("Write a "), "difficulty", F.lit(" "), "language", F.lit(" sample number "), F.col("id").cast("string")))


def cat_clean(c: Column) -> Column:
    """PRJ8."""
    for p in REMOVED:
        c = F.regexp_replace(c, p, "")
    for p, r in REWRITTEN:
        c = F.regexp_replace(c, p, r)
    return strip(c)


def truncated(text: Column, most: int) -> dict[str, Column]:
    """PRJ15: the first ``most`` words, padded, and the attention mask."""
    w = F.slice(words(text), 1, most)
    pad = F.lit(most) - F.size(w)
    return {"tokens": F.array_join(F.concat(w, F.array_repeat(F.lit("<pad>"), pad)), " "), "mask": F.array_join(F.concat(F.transform(w, lambda x: F.lit("1")), F.array_repeat(F.lit("0"), pad)), "")}


def mcq_prompt(question: Column, choices: Column) -> Column:
    """PRJ16."""
    rows = F.transform(choices, lambda x, i: F.concat(F.lit("("), F.char(i + 65), F.lit(") "), x))
    return F.concat(question, F.lit("\n"), F.array_join(rows, "\n"), F.lit("\nAnswer:"))


def answer_letter(text: Column) -> Column:
    """PRJ17: the first of a to d, in either case."""
    return F.nullif(F.upper(F.regexp_extract(text, "[A-Da-d]", 0)), F.lit(""))


def repetitive(text: Column) -> Column:
    """SCO28: some run of five words occurs more than twice as a substring.

    The three words in the middle of such a run then stand three times in the text, so the text is
    searched only for runs whose middle does (counted by hash, sorted within the text)."""

    def often(w: Column) -> Column:
        middles = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        thrice = lambda s: F.array_distinct(F.filter(s, lambda x, k: (k > 1) & (F.get(s, k - 2) == x)))

        def found(s: Column) -> Column:
            return F.floor((F.length(text) - F.length(F.replace(text, s, F.lit("")))) / F.length(s)) > 2

        def any_run(m: Column, many: Column) -> Column:
            runs = F.filter(F.sequence(F.lit(1), F.size(w) - 5), lambda i: F.array_contains(many, F.get(m, i)))
            return F.exists(runs, lambda i: found(F.array_join(F.slice(w, i, 5), " ")))

        return bind(middles, lambda m: bind(bind(F.array_sort(m), thrice), lambda many: F.when(F.size(many) == 0, False).otherwise(any_run(m, many))))

    return bind(words(text), lambda w: F.when(F.size(w) < 10, False).otherwise(often(w)))


def unit_gate(score: Column, key: Column) -> Column:
    """FLT9: a score above 0.8 passes, of the others three in four by a draw of their key."""
    return (score > 0.8) | (draw(key, "unit") < 0.75)


def plateau_rate(df: DataFrame, key: str, order: str, value: str, patience: int = 3, factor: float = 0.5, start: float = 0.1) -> DataFrame:
    """WIN7: the rate that is cut by ``factor`` after more than ``patience`` steps without a new
    least value, the count starting anew with each cut. Steps since the least value so far tell when
    a cut is due, so it is windows over a key's steps, and no fold."""
    steps = Window.partitionBy(key).orderBy(order)
    before = steps.rowsBetween(Window.unboundedPreceding, -1)
    least = F.min(value).over(before)
    new = (least.isNull() | (F.col(value) < least)).cast("long")
    rows = df.select(key, order, F.row_number().over(steps).cast("long").alias("step"), new.alias("new"))
    rows = rows.withColumn("run", F.sum("new").over(steps))
    bad = F.row_number().over(Window.partitionBy(key, "run").orderBy(order)) - 1
    rows = rows.withColumn("cut", ((bad > 0) & (bad % (patience + 1) == 0)).cast("long"))
    return rows.select(key, "step", (F.lit(start) * F.pow(F.lit(factor), F.sum("cut").over(steps))).alias("rate"))
