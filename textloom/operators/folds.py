"""Ordered folds over long series, in chunks: patience with a threshold, and falls in a row.

A series (one group of rows in an order) is cut into ranges of the order, each range's part of a
series is folded by itself into a small function of the state before it, these functions are
composed in order (a row a range and series), and every range is then folded again from the state
that it is reached with. So no task reads a whole series, however hot its group; composing reads a
series' functions, which are short but where values fall all the time (a running minimum each).

* ``patience``: the best value so far, and the rows since. With a threshold a value must beat the best
  by more than that, so what a chunk does depends on the best before it: the first of its values
  below that best less the threshold, which is one of its running minima. The function is a table
  over these: from each, the best and the rows since at the chunk's end.
* ``in_a_row``: how many rows before and with this one were each worse than the one before by more
  than a share. A chunk's function needs its first and last value, and its trailing run.

Cases: null values are left out. Rows of one place in the order come in the order of the further
columns given. A null group is a group. An empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Rows of a range.
CHUNK = 1 << 18


def running(values: list[float], delta: float, best: float = np.inf, bad: int = -1) -> Iterator[tuple[float, int]]:
    """best and rows since of each value, one after the other."""
    for v in values:
        best, bad = (v, 0) if v < best - delta else (best, bad + 1)
        yield best, bad


def patience_function(values: list[float], delta: float) -> tuple[list[float], list[float], list[int]]:
    """The chunk's running minima, and from each the best and the rows since at the end."""
    n, ends, stack, starts = len(values), [None] * len(values), [], []  # stack: ever smaller values to the right
    for i in range(n - 1, -1, -1):
        v = values[i]
        while stack and values[stack[-1]] >= v:
            stack.pop()
        # the nearest value to the right below v - delta: the stack falls from its top to its bottom
        low = bisect_right(stack, v - delta, key=lambda j: values[j])
        at = low - 1
        while at >= 0 and not values[stack[at]] < v - delta:
            at -= 1
        ends[i] = ends[stack[at]] if at >= 0 else (v, n - 1 - i)
        stack.append(i)
    least = np.inf
    for i, v in enumerate(values):
        if v < least:
            least = v
            starts.append(i)
    return [values[i] for i in starts], [float(ends[i][0]) for i in starts], [int(ends[i][1]) for i in starts]


def patience_after(function: tuple[list[float], list[float], list[int]], n: int, delta: float, best: float, bad: int) -> tuple[float, int]:
    """The state after a chunk of n values."""
    minima, bests, since = function
    at = next((k for k in range(bisect_right([-m for m in minima], -(best - delta)), len(minima)) if minima[k] < best - delta), None)
    return (best, bad + n) if at is None else (bests[at], since[at])


def worse(before: float, now: float, share: float, falling: bool) -> bool:
    """By more than ``share`` of the value before; falling: smaller is worse."""
    return bool(before) and ((before - now) if falling else (now - before)) / before > share


def _ranges(df: DataFrame, by: str, order: list[str], value: str, sign: float, chunk: int) -> DataFrame:
    """The rows as g, their own columns in one, v, and part: a range of group and order."""
    rows = df.where(F.col(value).isNotNull()).select(F.col(by).alias("g"), *(F.col(c).alias(f"o{k}") for k, c in enumerate(order)), F.struct("*").alias("own"), (F.col(value).cast("double") * sign).alias("v"))
    parts = max(1, -(-rows.count() // chunk))
    # written, for ranges that are cut twice may be cut at other places
    return written(rows.repartitionByRange(parts, "g", *(f"o{k}" for k in range(len(order)))).withColumn("part", F.spark_partition_id()), "ranges")


def _folded(rows: DataFrame, summary: Callable, after: Callable, again: Callable, first: tuple, columns: str) -> DataFrame:
    """summary: values to a chunk's function; after: function, values in it, state to the next state;
    again: values, state to the columns of each row; first: the state before all."""
    kind, key = rows.schema["g"].dataType.simpleString(), F.col("g").isNull()
    rows = rows.withColumn("none", key)
    names, place = [c.split()[0] for c in columns.split(", ")], [c for c in rows.columns if c[0] == "o" and c != "own"]

    def shorten(chunk: pd.DataFrame) -> pd.DataFrame:
        values = chunk.sort_values(place)["v"].tolist()
        return pd.DataFrame({"g": [chunk["g"].iloc[0]], "none": [bool(chunk["none"].iloc[0])], "part": [int(chunk["part"].iloc[0])], "n": [len(values)], "function": [pickle.dumps(summary(values))]})

    def carry(functions: pd.DataFrame) -> pd.DataFrame:
        state, out = first, []
        for r in functions.sort_values("part").itertuples():
            out.append((r.g, r.none, r.part, pickle.dumps(state)))
            state = after(pickle.loads(r.function), r.n, *state)
        return pd.DataFrame(out, columns=["g", "none", "part", "state"])

    def resolve(chunk: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values(place)
        told = list(again(chunk["v"].tolist(), *pickle.loads(states["state"].iloc[0])))
        out = pd.DataFrame(told, columns=names)
        out["own"] = chunk["own"].tolist()
        return out

    narrow = rows.select("g", "none", "part", *place, "v")
    functions = written(narrow.groupBy("part", "g", "none").applyInPandas(shorten, f"g {kind}, none boolean, part int, n long, function binary"), "functions")
    states = functions.groupBy("g", "none").applyInPandas(carry, f"g {kind}, none boolean, part int, state binary")
    same = ["part", "g", "none"]
    own = rows.schema["own"].dataType.simpleString()
    return rows.groupBy(*same).cogroup(states.groupBy(*same)).applyInPandas(resolve, f"{columns}, own {own}")


def patience(df: DataFrame, by: str, order: list[str], value: str, delta: float = 0.0, falling: bool = False, chunk: int = CHUNK) -> DataFrame:
    """WIN4: own (the row's columns), best (of its group so far) and bad (rows since). A value is better
    that is lower by more than ``delta``; falling: higher."""
    sign = -1.0 if falling else 1.0
    out = _folded(
        _ranges(df, by, order, value, sign, chunk),
        lambda values: patience_function(values, delta), lambda f, n, best, bad: patience_after(f, n, delta, best, bad), lambda values, best, bad: running(values, delta, best, bad),
        (np.inf, -1), "best double, bad long",
    )
    return out.withColumn("best", F.col("best") * sign)


def in_a_row(df: DataFrame, by: str, order: list[str], value: str, share: float = 0.0, falling: bool = True, chunk: int = CHUNK) -> DataFrame:
    """WIN5: own (the row's columns) and bad, the rows up to this one that were each worse than the one
    before by more than ``share`` of it."""
    is_worse = lambda a, b: a is not None and worse(a, b, share, falling)

    def runs(values: list[float], last: float | None, bad: int) -> Iterator[tuple[int]]:
        for v in values:
            bad = bad + 1 if is_worse(last, v) else 0
            last = v
            yield (bad,)

    def summary(values: list[float]) -> tuple:
        trailing = 0
        while trailing < len(values) - 1 and is_worse(values[-2 - trailing], values[-1 - trailing]):
            trailing += 1
        return values[0], values[-1], trailing

    def after(function: tuple, n: int, last: float | None, bad: int) -> tuple:
        first, end, trailing = function
        return end, (trailing if trailing < n - 1 else n - 1 + (bad + 1 if is_worse(last, first) else 0))

    return _folded(_ranges(df, by, order, value, 1.0, chunk), summary, after, runs, (None, 0), "bad long")
