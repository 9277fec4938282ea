"""Exact quantiles of groups of any size, by selecting ranks.

No task holds a group's values. A quantile lies between two values of known rank. For each rank an
open interval of values is kept that holds it, with the number of values inside. In a pass, an
approximate summary of every interval gives ``GRID`` splitters, the two around the rank are taken
as new ends, and the values below, at, between and above them are counted (partial sums); so the
rank falls on an end, which answers it, or into an interval about ``GRID`` / 3 times smaller. Ends
are left out of what follows, so equal values, however many, cannot stop a pass from narrowing.
Intervals of ``most`` values or fewer are then ranked by a window.

Cases: nulls are left out; a group of nulls alone, and no rows at all, have null quantiles and a
count of 0 (without groups one row). A null group is a group. NaN is the largest value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

GRID, ACCURACY = 512, 4096
#: Values that a task ranks at most.
MOST = 1 << 20


def _inside(v: Column, low: Column, high: Column) -> Column:
    """low < v < high; a null end is none."""
    return F.coalesce(v > low, F.lit(True)) & F.coalesce(v < high, F.lit(True))


def _within(rows: DataFrame, intervals: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of each interval (few to a group, and one row each)."""
    i = intervals.withColumnsRenamed({k: f"of_{k}" for k in keys})
    on = _inside(rows["v"], i["low"], i["high"])
    for k in keys:
        on &= rows[k].eqNullSafe(i[f"of_{k}"])
    return rows.join(i, on).drop(*(f"of_{k}" for k in keys))


def _narrowed(rows: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """A pass: the same ranks in smaller intervals, or answered."""
    span = [*keys, "low", "high"]
    grid = F.percentile_approx("v", F.array(*(F.lit(k / GRID) for k in range(GRID + 1))), ACCURACY)
    marks = _within(rows, ranks.select(*span).distinct(), keys).groupBy(*span).agg(grid.alias("grid"))
    own = [F.col(f"r.{c}") for c in ranks.columns]
    at = F.col("r.rank") * GRID / F.col("r.n")
    end = lambda k: F.get(F.col("m.grid"), F.greatest(F.lit(0), F.least(F.lit(GRID), k)).cast("int"))
    r, m = ranks.alias("r"), marks.alias("m")
    cut = r.join(m, _all_same("r", "m", span)).select(*own, end(F.floor(at) - 1).alias("a"), end(F.ceil(at) + 1).alias("b"))
    cut = written(cut.withColumn("id", F.monotonically_increasing_id()), "cuts")
    v, a, b = F.col("v"), F.col("a"), F.col("b")
    some = lambda x: F.sum(x.cast("long"))
    per = _within(rows, cut, keys).groupBy("id").agg(some(v < a).alias("under"), some(v == a).alias("at_a"), some((v > a) & (v < b)).alias("between"), some((v == b) & (b > a)).alias("at_b"))
    x = cut.join(per, "id")
    rank, u, ua, uab, all_ = F.col("rank"), F.col("under"), F.col("under") + F.col("at_a"), F.col("under") + F.col("at_a") + F.col("between"), F.col("under") + F.col("at_a") + F.col("between") + F.col("at_b")
    low, high = F.col("low"), F.col("high")

    def pick(under, on_a, between, on_b, above) -> Column:
        return F.when(rank < u, under).when(rank < ua, on_a).when(rank < uab, between).when(rank < all_, on_b).otherwise(above)

    null = F.lit(None).cast("double")
    return x.select(
        *keys, "k",
        pick(rank, rank, rank - ua, rank, rank - all_).alias("rank"),
        pick(u, u, F.col("between"), u, F.col("n") - all_).alias("n"),
        pick(low, low, a, low, b).alias("low"),
        pick(a, high, b, high, high).alias("high"),
        pick(null, a, null, b, null).alias("answer"),
    )


def _all_same(a: str, b: str, names: list[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out &= F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}"))
    return out


def _ranked(rows: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """The answers of ranks whose intervals a task can sort."""
    spans = written(ranks.select(*keys, "low", "high").distinct().withColumn("span", F.monotonically_increasing_id()), "spans")
    place = F.row_number().over(Window.partitionBy("span").orderBy("v")) - 1
    placed = _within(rows, spans, keys).select("span", "v", place.cast("long").alias("rank"))
    asked = ranks.alias("r").join(spans.alias("s"), _all_same("r", "s", [*keys, "low", "high"])).select(*(F.col(f"r.{c}") for c in (*keys, "k", "rank")), "s.span")
    return asked.join(placed, ["span", "rank"]).select(*keys, "k", F.col("v").alias("answer"))


def order_statistics(rows: DataFrame, ranks: DataFrame, keys: list[str], most: int = MOST) -> DataFrame:
    """keys, k, answer: the value of rank k (from 0) of each group. rows: keys, v; ranks: keys, k, n
    (the group's number of values)."""
    none = F.lit(None).cast("double")
    left = written(ranks.select(*keys, "k", F.col("k").alias("rank"), "n", none.alias("low"), none.alias("high"), none.alias("answer")), "ranks")
    told = None
    while True:
        ready, large = left.where((F.col("n") <= most) & F.col("answer").isNull()), left.where((F.col("n") > most) & F.col("answer").isNull())
        done = left.where("answer IS NOT NULL").select(*keys, "k", "answer").unionByName(_ranked(rows, ready, keys))
        told = done if told is None else told.unionByName(done)
        if not large.head(1):
            return told
        left = written(_narrowed(rows, large, keys), "ranks")


def quantiles(df: DataFrame, by: Iterable[str], value: str | Column, ps: Iterable[float], most: int = MOST) -> DataFrame:
    """The columns of ``by``, n (values) and for each p a column p<100 p>, interpolated between the two
    values next to p (n - 1)."""
    by, ps = list(by), list(ps)
    keys = [f"g{k}" for k in range(len(by))] or ["g0"]
    group = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)] if by else [F.lit(0).alias("g0")]
    rows = df.select(*group, (F.col(value) if isinstance(value, str) else value).cast("double").alias("v"))
    sizes = written(rows.groupBy(*keys).agg(F.count("v").alias("n")) if by else rows.agg(F.count("v").alias("n")).select(F.lit(0).alias("g0"), "n"), "sizes")
    wanted = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(F.lit(p) * (F.col("n") - 1)), F.ceil(F.lit(p) * (F.col("n") - 1))) for p in ps))))
    ranks = sizes.where("n > 0").select(*keys, "n", F.explode(wanted.cast("array<long>")).alias("k"))
    found = order_statistics(rows.where("v IS NOT NULL"), ranks, keys, most).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("k", "answer"))).alias("x"))
    s, f = sizes.alias("s"), found.alias("f")
    both = s.join(f, _all_same("s", "f", keys), "left").select("s.*", "f.x")

    def at(p: float) -> Column:
        pos = F.lit(p) * (F.col("n") - 1)
        a, b = F.col("x")[F.floor(pos).cast("long")], F.col("x")[F.ceil(pos).cast("long")]
        return a + (b - a) * (pos - F.floor(pos))

    return both.select(*(F.col(k).alias(c) for k, c in zip(keys, by, strict=False)), "n", *(at(p).alias(f"p{round(p * 100)}") for p in ps))
