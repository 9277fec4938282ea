"""Statistics of a numeric column, by group or of all rows, with exact quantiles of groups of any size.

Nulls are left out. Without rows the statistics of all rows are null and their counts 0.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import MOST, quantiles


def described(df: DataFrame, by: Iterable[str], value: str, ps: Iterable[float] = (0.5,), most: int = MOST) -> DataFrame:
    """by, n, mean, std (population), std_samp, least, most, and a column p<100 p> for each p."""
    by, ps = list(by), list(ps)
    v = F.col(value).cast("double")
    sums = df.groupBy(*by).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.stddev_samp(v).alias("std_samp"), F.min(v).alias("least"), F.max(v).alias("most")).alias("s")
    q = quantiles(df, by, value, ps, most).alias("q")
    same = F.lit(True)
    for c in by:
        same &= F.col(f"s.{c}").eqNullSafe(F.col(f"q.{c}"))
    return sums.join(q, same).select(*(F.col(f"s.{c}") for c in by), "n", "mean", "std", "std_samp", "least", "most", *(f"p{round(p * 100)}" for p in ps))


def outliers(df: DataFrame, value: str, times: float = 1.5) -> DataFrame:
    """AGG8: bounds of ``times`` interquartile ranges beyond the quartiles, and how many values lie outside."""
    q = quantiles(df, [], value, [0.25, 0.75]).select((F.col("p75") - F.col("p25")).alias("iqr"), "p25", "p75")
    b = q.select((F.col("p25") - times * F.col("iqr")).alias("lower_bound"), (F.col("p75") + times * F.col("iqr")).alias("upper_bound"), "iqr")
    v = F.col(value).cast("double")
    outside = F.when((v < F.col("lower_bound")) | (v > F.col("upper_bound")), 1.0).otherwise(0.0)
    found = df.crossJoin(F.broadcast(b)).agg(F.sum(outside).cast("long").alias("outliers"), F.avg(outside).alias("share"))  # b is one row
    return b.crossJoin(found).select("lower_bound", "upper_bound", "iqr", F.coalesce("outliers", F.lit(0)).alias("outliers"), "share")


def shape(df: DataFrame, value: str) -> DataFrame:
    """AGG9: (mean - median) / std, what that says, and std / mean."""
    d = described(df, [], value)
    skew = F.when(F.col("std") > 0, (F.col("mean") - F.col("p50")) / F.col("std")).otherwise(0.0)
    label = F.when(F.abs(skew) < 0.5, "approximately_normal").when(skew > 0.5, "right_skewed").otherwise("left_skewed")
    return d.select(skew.alias("skewness"), label.alias("shape"), F.when(F.col("mean") > 0, F.col("std") / F.col("mean")).otherwise(0.0).alias("variation"))


def rounded(df: DataFrame, *plain: str, digits: int = 6) -> DataFrame:
    """All doubles but ``plain`` ones, rounded."""
    def one(c: str, kind: str) -> Column:
        return F.round(c, digits).alias(c) if kind == "double" and c not in plain else F.col(c)

    return df.select(*(one(c, kind) for c, kind in df.dtypes))
